"""Find and repair text that was decoded with a wrong character encoding, by a hidden Markov model.

The states are the clean one, one for each pair of encodings (the text was written in one and read as the other, once or twice) and
one for characters that were replaced and lost. What the model sees are the stretches of non-ASCII characters of a text with what
stands before and after each. The clean state draws characters as the corpus does; a pair's state draws characters as the corpus
does and passes them through the pair, so a stretch is as likely in it as its inverse transform is in clean text. The emissions are
trained on all documents by Viterbi training: each round labels the corpus and counts the characters of what was labelled clean.
Equal stretches are measured once, and equal sequences of stretches labelled once, however many documents hold them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.tokens import spread
from weft.session import cut

#: Encodings as which UTF-8 is read by mistake; then, for other encodings, those as which each is read.
UTF8_READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "iso8859-2", "iso8859-15", "cp437", "cp850", "cp852", "cp866", "mac_roman", "koi8-r", "mac_cyrillic", "cp932", "gbk", "big5", "cp949")
OTHERS_READ_AS = {
    "cp1252": ("cp437", "cp850", "mac_roman", "cp1250", "cp1251", "cp866", "koi8-r"),
    "cp850": ("cp1252", "latin-1"),
    "cp437": ("cp1252", "latin-1"),
    "mac_roman": ("cp1252", "latin-1"),
    "cp1250": ("cp1252", "latin-1", "cp437", "cp852", "mac_roman", "cp1251"),
    "iso8859-2": ("cp1252", "latin-1", "cp1250"),
    "cp852": ("cp1252", "cp1250"),
    "cp1251": ("cp1252", "latin-1", "cp437", "cp850", "cp866", "koi8-r", "mac_roman", "mac_cyrillic", "cp1250"),
    "koi8-r": ("cp1252", "latin-1", "cp1251", "cp866"),
    "cp866": ("cp1252", "latin-1", "cp1251", "cp437", "koi8-r"),
}
TWICE = tuple((a, b) for a in ("cp1252", "latin-1", "cp1251", "cp1250", "mac_roman", "cp437") for b in ("cp1252", "latin-1", "cp1251", "cp1250", "mac_roman", "cp437") if a == b or {a, b} == {"cp1252", "latin-1"})
WIDE = ("cp932", "gbk", "big5", "cp949")
LOST = "lost"
RUNS = re.compile(r"[^\x00-\x7f]+")
SWAP = str.maketrans("lukK", "ulKk")
MISFIT, CUT_SHORT, ASCII, REPLACED = math.log(1e-6), math.log(1e-3), math.log(0.03), math.log(1e-2)

#: A state's key: the transforms to undo, the last first: (read as, written in).
State = tuple[tuple[str, str], ...]


def states() -> list[State]:
    """All garbled states, without the one for lost characters."""
    once = [((w, "utf-8"),) for w in UTF8_READ_AS] + [((w, r),) for r, many in OTHERS_READ_AS.items() for w in many]
    return once + [((a, "utf-8"), (b, "utf-8")) for a, b in TWICE]


@lru_cache(maxsize=64)
def byte_of(encoding: str) -> dict[str, int]:
    """The byte of each character of a one-byte encoding; bytes without a character stand for the control of their number."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


@lru_cache(maxsize=64)
def char_of(encoding: str) -> dict[int, str]:
    return {b: c for c, b in byte_of(encoding).items()}


def _bytes(text: str, encoding: str) -> list[bytes | None]:
    """Of each character its bytes in an encoding, None where it has none."""
    if encoding not in WIDE:
        table = byte_of(encoding)
        return [bytes([ord(c)]) if c < "\x80" else bytes([table[c]]) if c in table else None for c in text]
    out: list[bytes | None] = []
    for c in text:
        try:
            out.append(c.encode(encoding))
        except UnicodeEncodeError:
            out.append(bytes([ord(c)]) if ord(c) < 256 else None)
    return out


def undo(text: str, read_as: str, written_in: str) -> tuple[str, int, int]:
    """The text with one wrong reading undone; how many characters don't fit, and how many were cut short. Misfits stay as they are."""
    parts = _bytes(text, read_as)
    out: list[str] = []
    misfits = short = 0
    if written_in != "utf-8":
        table = char_of(written_in)
        for c, raw in zip(text, parts, strict=True):
            if raw is not None and len(raw) == 1:
                out.append(table[raw[0]] if raw[0] > 127 else chr(raw[0]))
            else:
                misfits += 1
                out.append(c)
        return "".join(out), misfits, short
    flat: list[tuple[int, int]] = [(b, i) if raw is not None else (-1, i) for i, raw in enumerate(parts) for b in (raw if raw is not None else b"\x00")]
    at = 0
    while at < len(flat):
        b, i = flat[at]
        need = 1 if 0 <= b < 128 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
        if need == 1:
            out.append(chr(b))
            at += 1
            continue
        tail = flat[at + 1 : at + need]
        if need and len(tail) == need - 1 and all(0x80 <= x < 0xC0 for x, _ in tail):
            try:
                out.append(bytes([b, *(x for x, _ in tail)]).decode("utf-8"))
                at += need
                continue
            except UnicodeDecodeError:
                pass
        # a lead byte at the end of a stretch may have lost the rest, as a stray rest may its lead
        if need and at + 1 + sum(0x80 <= x < 0xC0 for x, _ in tail) >= len(flat):
            short += 1
        else:
            misfits += 1
        out.append(text[i])
        at += 1
        while at < len(flat) and flat[at][1] == i:
            at += 1
    return "".join(out), misfits, short


def kind(c: str) -> str:
    """What sort of character a neighbour is: s blank or edge, l or u Latin letter, k or K other letter, d digit, p other ASCII, x other."""
    if c == "" or c.isspace():
        return "s"
    if c.isalpha():
        if c < "ɐ":
            return "u" if c.isupper() else "l"
        return "K" if c.isupper() else "k"
    return "d" if c.isdigit() else "p" if c < "\x80" else "x"


def surroundings(before: str, run: str, after: str) -> Iterator[tuple[str, str]]:
    """Each non-ASCII character of a stretch, letters in lower case, with the kinds of its neighbours; an ASCII one with ''.

    A neighbour that is the same character is r. A letter's neighbours are l or k if they are letters of its own case and u or K if of the other, so that text in capitals is as likely as
    other text.
    """
    kinds = [before, *map(kind, run), after]
    for i, c in enumerate(run):
        left = "r" if i and run[i - 1] == c else kinds[i]
        right = "r" if run[i + 1 : i + 2] == c else kinds[i + 2]
        if c < "\x80":
            yield c, ""
        elif kinds[i + 1] in "uK":
            low = c.lower()
            yield low if len(low) == 1 else c, left.translate(SWAP) + right.translate(SWAP)
        else:
            yield c, left + right


def sort_of(text: str) -> str:
    """a: a text of which at least three quarters are ASCII; o: another."""
    return "a" if 4 * len(text.encode("ascii", "ignore")) >= 3 * len(text) else "o"


#: A stretch as the model sees it: the sort of the text, what stands before, the stretch, what stands after.
Seen = tuple[str, str, str, str]


def stretches(text: str) -> list[tuple[int, int, Seen]]:
    """The non-ASCII stretches of a text, with their places."""
    sort = sort_of(text)
    return [(a, b, (sort, kind(text[a - 1 : a]), text[a:b], kind(text[b : b + 1]))) for a, b in (m.span() for m in RUNS.finditer(text))]


STATES = states()
NUMBERS = {state: i for i, state in enumerate(STATES)}


def inverses(run: str) -> list[tuple[int, str, int, int]]:
    """Of each garbled state that fits a stretch: its number, the stretch with the state undone, how many characters don't fit, and how many were cut short."""
    out = []
    for number, state in enumerate(STATES):
        text, misfits, short = run, 0, 0
        for step, (read_as, written_in) in enumerate(state):
            text, bad, cut_off = undo(text, read_as, written_in)
            misfits, short = misfits + bad, short + cut_off
            if text == run or (step == 0 and bad and len(state) > 1) or 2 * bad > len(run):
                break
        else:
            out.append((number, text, misfits, short))
    return out


@dataclass
class Model:
    """counts: of each sort of text, character and neighbourhood in clean text; totals: characters of each sort of text.

    known: the gains of all different stretches of the corpus, if they are few enough to be sent along. enter, leave: log odds of changes of state. unsure: what is added to enter for pairs of one-byte encodings, where, unlike in
    UTF-8, any text has an inverse.
    """

    counts: dict[tuple[str, str, str], int]
    totals: dict[str, int]
    enter: float
    leave: float
    unsure: float
    known: dict | None = field(default=None, repr=False)
    memory: dict = field(default_factory=dict, repr=False)
    alone: dict = field(default_factory=dict, repr=False)
    anywhere: dict = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if not self.alone:
            for (sort, c, around), n in self.counts.items():
                self.alone[sort, c] = self.alone.get((sort, c), 0) + n
                self.anywhere[c, around] = self.anywhere.get((c, around), 0) + n

    def __getstate__(self) -> dict:
        return {"counts": self.counts, "totals": self.totals, "enter": self.enter, "leave": self.leave, "unsure": self.unsure, "known": self.known, "memory": {}, "alone": {}, "anywhere": {}}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def likely(self, sort: str, before: str, run: str, after: str) -> float:
        """Log likelihood of a stretch as clean text."""
        whole = 0.0
        for c, around in surroundings(before, run, after):
            if not around:
                whole += ASCII
            elif c == "�":
                whole += MISFIT * 2
            else:
                # a neighbourhood that a frequent character never had tells against it, so it counts as half a character at most
                unseen = min(0.5, 0.1 * self.alone.get((sort, c), 0) / 36)
                n = self.counts.get((sort, c, around), 0) + unseen + 0.01 * self.anywhere.get((c, around), 0)
                whole += math.log((n + 0.002) / (self.totals.get(sort, 0) + 1))
        return whole

    def gains(self, seen: Seen) -> dict[State | str, float]:
        """By garbled state, how much likelier than clean a stretch is, where that is more than -30."""
        found = self.memory.get(seen) if self.known is None else self.known.get(seen)
        if found is None:
            found = self.measure(seen, inverses(seen[2]))
            if len(self.memory) > 200_000:
                self.memory.clear()
            if len(seen[2]) < 100:
                self.memory[seen] = found
        return found

    def suspect(self, seen: Seen) -> bool:
        """Whether a stretch, taken by itself, is likelier garbled than clean."""
        return any(gain > 0 for gain in self.gains(seen).values())

    def measure(self, seen: Seen, undone: Iterable[tuple[int, str, int, int]]) -> dict[State | str, float]:
        """The gains of a stretch, given its inverses."""
        sort, before, run, after = seen
        clean = self.likely(sort, before, run, after)
        found: dict[State | str, float] = {}
        for number, text, misfits, short in undone:
            gain = self.likely(sort, before, text, after) + MISFIT * misfits + CUT_SHORT * short - clean
            if gain > -30:
                found[STATES[number]] = gain
        if "\ufffd" in run:
            found[LOST] = sum(REPLACED if c == "\ufffd" else self.likely(sort, "l", c, "l") for c in run) - clean
        return found

    def label(self, text: str | None, runs: list[tuple[int, int, Seen]] | None = None) -> list[tuple[int, int, State | str]]:
        """The stretches of a text whose most likely state isn't the clean one, with that state, from Viterbi's path."""
        if not text or text.isascii():
            return []
        found = stretches(text) if runs is None else runs
        if not any(self.suspect(seen) for _, _, seen in found):
            return []
        path = self.path([self.gains(seen) for _, _, seen in found])
        return [(a, b, state) for (a, b, _), state in zip(found, path, strict=True) if state is not None]

    def path(self, gains: list[dict[State | str, float]]) -> list[State | str | None]:
        """The most likely state of each stretch of a text, None for the clean one, from the gains of all in order: Viterbi's path."""
        # a state that no stretch of the text is likelier in than in the clean one can't be on the best path
        able = {state for more in gains for state, gain in more.items() if gain > 0}
        if not able:
            return [None] * len(gains)
        # relative to the clean state, whose likelihood is 0 at every step
        best: dict[State | str | None, float] = {None: 0.0}
        back: list[dict[State | str | None, State | str | None]] = []
        for more in gains:
            leader, top = max(((s, v + (self.leave if s is not None else 0.0)) for s, v in best.items()), key=lambda x: x[1])
            new: dict[State | str | None, float] = {None: top}
            source: dict[State | str | None, State | str | None] = {None: leader}
            for state, gain in more.items():
                if state not in able:
                    continue
                stay, come = best.get(state, -math.inf), best[None] + self.enter + (0.0 if state == LOST or state[0][1] == "utf-8" else self.unsure)
                new[state], source[state] = (stay + gain, state) if stay >= come else (come + gain, None)
            best = new
            back.append(source)
        state = max(best, key=lambda s: best[s] + (self.leave if s is not None else 0.0))
        out = []
        for source in reversed(back):
            out.append(state)
            state = source[state]
        return out[::-1]

    def repair(self, text: str | None) -> tuple[str, bool] | None:
        """The text with each labelled stretch put through its state's inverse, and whether nothing of it was lost; None if none is labelled."""
        labelled = self.label(text)
        if not labelled:
            return None
        out, at, whole = [], 0, True
        for a, b, state in labelled:
            new = text[a:b]
            if state == LOST:
                whole = False
            else:
                for read_as, written_in in state:
                    new, misfits, short = undo(new, read_as, written_in)
                    whole = whole and not misfits and not short
            out += [text[at:a], new]
            at = b
        return "".join([*out, text[at:]]), whole


def collect_stretches(documents: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """What training looks at, from one pass over all texts.

    First id, sort, before, run, after and n of all different stretches; then ids and n of all different sequences of stretches of a
    text, in order; then the number of characters of each sort of text.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequences: Counter[tuple[Seen, ...]] = Counter()
            totals: Counter[str] = Counter()
            for value in frame.iloc[:, 0]:
                if value:
                    totals[sort_of(value)] += len(value)
                    if not value.isascii():
                        sequences[tuple(seen for _, _, seen in stretches(value))] += 1
            met: Counter[Seen] = Counter()
            rows = []
            for sequence, n in sequences.items():
                for seen in sequence:
                    met[seen] += n
                rows.append((None, None, None, None, [_identify(seen) for seen in sequence], n))
            rows += [(*seen, [_identify(seen)], n) for seen, n in met.items()]
            rows += [(sort, "", "", "", [], n) for sort, n in totals.items()]
            if rows:
                yield pd.DataFrame(rows, columns=["sort", "before", "run", "after", "ids", "n"])

    kinds = "sort string, before string, run string, after string, ids array<bigint>, n bigint"
    rows = cut(spread(documents.select(text)).mapInPandas(run, kinds).groupBy("sort", "before", "run", "after", "ids").agg(F.sum("n").alias("n")))
    totals = {r.sort: r.n for r in rows.where("run = ''").collect()}
    seen = rows.where("run <> ''").select(F.col("ids")[0].alias("id"), "sort", "before", "run", "after", "n")
    return seen, spread(cut(rows.where("run is null").select("ids", "n"))), totals


def _undone(stretches_: DataFrame) -> DataFrame:
    """The stretches with their inverses, which are the same in every round."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [list(zip(*inverses(t), strict=True)) or [()] * 4 for t in frame["run"]]
            yield frame.assign(**{name: [list(f[i]) for f in found] for i, name in enumerate(("states", "texts", "misfits", "short"))})

    kinds = "id long, sort string, before string, run string, after string, n long, states array<int>, texts array<string>, misfits array<int>, short array<int>"
    return cut(spread(stretches_).mapInPandas(run, kinds))


def _identify(seen: Seen) -> int:
    return xxhash.xxh64_intdigest("\x00".join(seen)) - (1 << 63)


#: How many different stretches may be sent to every task; with more of them each task measures what it meets, to the same result.
FEW = 100_000


def _measured(stretches_: DataFrame, model: Model) -> dict[Seen, dict[State | str, float]] | None:
    """The gains of all different stretches; None if they are more than FEW."""
    if stretches_.limit(FEW + 1).count() > FEW:
        return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for *seen, states_, texts, misfits, short in frame[["sort", "before", "run", "after", "states", "texts", "misfits", "short"]].itertuples(index=False, name=None):
                gains = model.measure(tuple(seen), zip(states_.tolist(), texts, misfits.tolist(), short.tolist(), strict=True))
                rows.append((*seen, [-1 if s == LOST else NUMBERS[s] for s in gains], list(gains.values())))
            if rows:
                yield pd.DataFrame(rows, columns=["sort", "before", "run", "after", "states", "gains"])

    rows = stretches_.mapInPandas(run, "sort string, before string, run string, after string, states array<int>, gains array<double>").collect()
    return {(r.sort, r.before, r.run, r.after): {LOST if s < 0 else STATES[s]: g for s, g in zip(r.states, r.gains, strict=True)} for r in rows}


def _labelled(sequences: DataFrame, stretches_: DataFrame, model: Model) -> DataFrame:
    """id and m, how often each stretch is labelled with a garbled state."""
    if model.known is None:
        # too many for every task: the stretches of each sequence come to it
        listed = sequences.select(F.monotonically_increasing_id().alias("s"), "n", F.posexplode("ids").alias("pos", "id"))
        seen = F.struct("pos", "id", "sort", "before", "run", "after")
        texts = listed.join(stretches_.select("id", "sort", "before", "run", "after"), "id").groupBy("s").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(seen)).alias("l"))
    else:
        texts = sequences.withColumn("l", F.lit(None).cast("array<struct<pos:int,id:bigint,sort:string,before:string,run:string,after:string>>"))
    gains = {_identify(seen): more for seen, more in (model.known or {}).items()}
    wanted = np.array([i for i, more in gains.items() if any(g > 0 for g in more.values())], dtype=np.int64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: Counter[int] = Counter()
            if model.known is None:
                rows = [([x["id"] for x in items], [model.gains((x["sort"], x["before"], x["run"], x["after"])) for x in items], n) for items, n in zip(frame["l"], frame["n"], strict=True)]
            else:
                sizes = frame["ids"].map(len).to_numpy()
                hit = np.isin(np.concatenate([*frame["ids"], np.zeros(0, dtype=np.int64)]), wanted)
                some = np.add.reduceat(np.append(hit, False).astype(int), np.cumsum(sizes) - sizes) > 0 if len(sizes) else []
                chosen = frame[some]
                rows = [(ids, [gains.get(i, {}) for i in ids.tolist()], n) for ids, n in zip(chosen["ids"], chosen["n"], strict=True)]
            for ids, more, n in rows:
                for i, state in zip(ids, model.path(more), strict=True):
                    if state is not None:
                        out[int(i)] += n
            if out:
                yield pd.DataFrame({"id": list(out), "m": list(out.values())})

    return texts.select("n", "l", *([] if model.known is None else ["ids"])).mapInPandas(run, "id long, m long").groupBy("id").agg(F.sum("m").alias("m"))


def _count(stretches_: DataFrame) -> dict[tuple[str, str, str], int]:
    """How often each character occurs in each neighbourhood and sort of text, from stretches and how often (n) each occurs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: Counter[tuple[str, str, str]] = Counter()
            for sort, before, text, after, n in frame.itertuples(index=False, name=None):
                for c, around in surroundings(before, text, after):
                    counts[sort, c, around] += n
            if counts:
                yield pd.DataFrame([(*key, n) for key, n in counts.items()], columns=["sort", "c", "around", "n"])

    rows = stretches_.select("sort", "before", "run", "after", "n").mapInPandas(run, "sort string, c string, around string, n long").groupBy("sort", "c", "around").agg(F.sum("n").alias("n"))
    return {(row.sort, row.c, row.around): row.n for row in rows.collect()}


def train(documents: DataFrame, text: str = "text", rounds: int = 3, first: tuple[float, ...] = (-3.0, -1.0, -3.0), last: tuple[float, ...] = (-6.0, -2.0, -3.0)) -> Model:
    """Fit the emissions on all documents, which are read once: every round works on the different stretches and their sequences.

    rounds: labelings of the corpus from which clean text is counted anew. first, last: enter, leave and unsure of the model while
    counts still hold garbled text, and at the end. The counts that reach the driver have at most 162 rows for each code point of
    Unicode, the gains of different stretches at most FEW. An empty table gives a model that finds everything clean.
    """
    seen, sequences, totals = collect_stretches(documents, text)
    seen = _undone(seen)
    counts = _count(seen)
    for _ in range(rounds):
        model = Model(counts, totals, *first)
        model.known = _measured(seen, model)
        left = seen.join(_labelled(sequences, seen, model), "id", "left").withColumn("n", F.col("n") - F.coalesce("m", F.lit(0)))
        counts = _count(left.where("n > 0"))
    model = Model(counts, totals, *last)
    model.known = _measured(seen, model)
    return model


def find_garbled(documents: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """key, repaired and restored of every document with a garbled stretch.

    repaired: the text with each such stretch put through its inverse transform; restored: whether every character came back. Null,
    empty and ASCII texts are never found; texts of any length are labelled whole; repeated rows give repeated rows. Columns other
    than the two are not read. model: one that was trained on these documents.
    """
    model = model or train(documents, text)
    kind_of_key = documents.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(k, *fixed) for k, t in zip(frame[key], frame[text], strict=True) if (fixed := model.repair(t))]
            if found:
                yield pd.DataFrame(found, columns=[key, "repaired", "restored"])

    return spread(documents.select(key, text)).mapInPandas(run, f"`{key}` {kind_of_key}, repaired string, restored boolean")
