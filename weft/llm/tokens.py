"""Encode whole texts with a public byte-level BPE vocabulary, by a backtracking encoder.

A word (a piece of the vocabulary's splitting pattern) is covered by the longest tokens that an Aho-Corasick automaton finds in it,
from left to right. A token may follow another only if merging in the order of the vocabulary could never have joined across their
border; where it may not, the encoder takes the next shorter token or steps back. The result equals merging pair by pair, in time
linear in the length of the word.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the public pattern that splits a text into the words within which tokens are merged.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_VOCABULARY = os.environ.get("WEFT_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"


class Encoder:
    """Encoder and decoder of one vocabulary file (a line for each token: its bytes in base 64, its id; ids in order of merging)."""

    def __init__(self, path: str, remembered: int = 200_000) -> None:
        with open(path, "rb") as lines:
            entries = [line.split() for line in lines if line.strip()]
        size = max(int(i) for _, i in entries) + 1
        self.tokens = [b""] * size
        for token, i in entries:
            self.tokens[int(i)] = base64.b64decode(token)
        self.ids = {token.decode("latin-1"): i for i, token in enumerate(self.tokens) if token}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self._split_tokens()
        self.words = regex.compile(PATTERN)
        self.remembered = remembered
        self.memory: dict[str, list[int]] = {}
        # decoding: token i is bytes[offsets[i]:offsets[i + 1]]
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(t) for t in self.tokens], out=self.offsets[1:])
        self.bytes = b"".join(self.tokens)

    def _split_tokens(self) -> None:
        """Of each token its longest proper prefix that is a token, and the pair of tokens whose merge makes it (itself twice for a byte)."""
        size = len(self.tokens)
        self.shorter = [-1] * size
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[tuple[int, int], int] = {}
        for text, i in sorted(self.ids.items(), key=lambda entry: entry[1]):
            for end in range(len(text) - 1, 0, -1):
                prefix = self.ids.get(text[:end])
                if prefix is None:
                    continue
                if self.shorter[i] < 0:
                    self.shorter[i] = prefix
                rest = self.ids.get(text[end:])
                if rest is not None and prefix < i and rest < i and self.may_follow(prefix, rest):
                    self.left[i], self.right[i] = prefix, rest
                    self.merged[prefix, rest] = i
                    break

    def may_follow(self, first: int, second: int) -> bool:
        """Whether the two tokens can stand side by side in an encoding.

        The later made of the two is taken apart at the border again and again; whenever the parts at the border would have merged
        before what kept them apart was made, the pair can't occur.
        """
        before = 1 << 60
        while True:
            joined = self.merged.get((first, second))
            if joined is not None and joined < before:
                return False
            if first > second:
                before, first = first, self.right[first]
                if first == before:
                    before, second = second + 1, self.left[second]
                    if second + 1 == before:
                        return True
            else:
                before, second = second + 1, self.left[second]
                if second + 1 == before:
                    before, first = first, self.right[first]
                    if first == before:
                        return True

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word given as bytes in the form of a latin-1 string."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        length = len(word)
        longest = [-1] * length
        for end, token in self.automaton.iter(word):
            start = end + 1 - len(self.tokens[token])
            if longest[start] < 0 or len(self.tokens[token]) > len(self.tokens[longest[start]]):
                longest[start] = token
        out: list[int] = []
        dead = bytearray(length + 1)
        at, token = 0, longest[0]
        while token >= 0:
            last = out[-1] if out else -1
            while True:
                end = at + len(self.tokens[token])
                if not dead[end] and (last < 0 or self.may_follow(last, token)):
                    out.append(token)
                    at = end
                    token = longest[end] if end < length else -1
                    break
                if self.shorter[token] >= 0:
                    token = self.shorter[token]
                    continue
                dead[at] = 1
                token = out.pop()
                at -= len(self.tokens[token])
                last = out[-1] if out else -1
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; of null and of the empty text the empty list."""
        out: list[int] = []
        if not text:
            return out
        memory = self.memory
        for word in self.words.findall(text):
            ids = memory.get(word)
            if ids is None:
                ids = self.encode_word(word.encode("utf-8", "surrogatepass").decode("latin-1"))
                if len(memory) >= self.remembered:
                    memory.clear()
                if len(word) <= 64:
                    memory[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of some ids, by their offsets into one run of bytes."""
        picked = np.asarray(ids, dtype=np.int64)
        return b"".join(self.bytes[a:b] for a, b in zip(self.offsets[picked], self.offsets[picked + 1], strict=True)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str = DEFAULT_VOCABULARY) -> Encoder:
    """The encoder of a vocabulary file, made once in a process."""
    return Encoder(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows in as many even parts as there are cores, if the input is a scan of less than half as many (a few files leave most cores idle).

    Other inputs, whose number of parts is known only when they run, are returned as they are.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    parts = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(parts) if 2 * df.rdd.getNumPartitions() <= parts else df


def encode_corpus(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """key and ids, the token ids of the whole text, one row for each row.

    Null and empty texts give an empty list; blank text is encoded as it is; special tokens are never made. Very long texts are
    encoded whole, in linear time. Equal rows give equal rows. Other columns are dropped. The vocabulary file must be at the same
    path on every executor.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(vocabulary)
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "ids": [tool.encode(t) for t in frame[text]]})

    kind = documents.schema[key].dataType.simpleString()
    return spread(documents.select(key, text)).mapInPandas(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """key and n_tokens of every row, by the same encoder; 0 for null and empty texts."""
    return encode_corpus(documents, key, text, vocabulary).select(key, F.size("ids").cast("long").alias("n_tokens"))


def decode_corpus(encoded: DataFrame, key: str = "doc_id", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """key and text of encoded rows; an empty or null list gives the empty text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(vocabulary)
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "text": [tool.decode(list(ids)) if ids is not None else "" for ids in frame["ids"]]})

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInPandas(run, f"`{key}` {kind}, text string")
