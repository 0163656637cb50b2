"""Suffix blocking of names: the index of the suffixes of their words, and what typed names look up in it.

A word is taken by its sounds. Its suffixes from SUFFIXES[0] sounds on are keys of their own. A suffix that more than `common` reference
names share is left out of the index, but only after it was refined by other fields of the name: the trade; the beginning of another
word (or, for names of one word and for slips within a word, its own beginning), longer and longer, and the beginnings of both words. Words cut short have no suffix left, so beginnings of two words are keys too, refined by the trade or a longer beginning.
"""

from __future__ import annotations

from itertools import chain, islice

import numpy as np

from weft.llm import names

#: Lengths of suffixes in sounds: alone, and with the beginning of a word.
SUFFIXES, REFINED = (6, 8), (3, 5, 7)
#: Sounds of a beginning: of a word that refines, and alone.
START, LONG_START = 4, 7
#: With how many other words of a name, the longest, a suffix is refined.
OTHERS = 3
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(*parts: np.ndarray) -> np.ndarray:
    """One number for several."""
    out = np.zeros(len(parts[0]), dtype=np.uint64)
    for part in parts:
        out ^= part.astype(np.uint64)
        out *= _MIX
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out


def _spelt(core: list[str], typed: bool) -> list[str]:
    """The words of a core, and of a typed one neighbours joined, as a word may have been written as two."""
    words = list(core)
    if typed and len(core) > 1:
        words += [a + b for a, b in zip(core, core[1:], strict=False)]
        if len(core) == 2:
            words.append(core[1] + core[0])
    return words


#: The kinds of keys that no other kind is wider than, of those that are left out where they are common. Names that share
#: a longer or refined suffix, or beginnings with a trade, share one of these too.
WIDEST = (1, 3, 5, 10 + SUFFIXES[0], 20 + REFINED[0])


def keys(texts: list[str], typed: bool, widest: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each name text its keys: the text's place, the key, and whether the index keeps the key however common it is.

    widest: only the keys of the kinds in WIDEST.
    """
    parts = [t.split("|") for t in texts]
    spelt = [_spelt(p[0].split(), typed) for p in parts]
    sounds = iter(names.sounds(list(chain.from_iterable(spelt))))
    lists = []
    for words in spelt:
        heard = dict.fromkeys(islice(sounds, len(words)))
        if typed:
            heard |= dict.fromkeys(full for w in list(heard) for full in sorted(names.PETS.get(w, ())))
        lists.append(list(heard))
    counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat = [w.encode() for w in chain.from_iterable(lists)]
    n = len(flat)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    node = np.repeat(np.arange(len(lists)), counts)
    length = np.fromiter(map(len, flat), dtype=np.int64, count=n)
    head = np.array(flat, dtype="S8").view(">u8").astype(np.uint64)
    tail = np.array([w[-8:].rjust(8, b"\0") for w in flat], dtype="S8")
    tail = np.frombuffer(tail.tobytes(), dtype=">u8").astype(np.uint64)
    trade = np.array([p[1][:3].encode() for p in parts], dtype="S16").astype("S8").view(">u8").astype(np.uint64)[node]

    def end(k: int) -> np.ndarray:
        return tail & np.uint64((1 << 8 * k) - 1)

    def start(k: int) -> np.ndarray:
        return head >> np.uint64(8 * (8 - k))

    out: list[tuple[np.ndarray, np.ndarray, bool]] = []

    def add(mask: np.ndarray, kind: int, at: np.ndarray, *parts: np.ndarray, kept: bool = False) -> None:
        if not widest or kind in WIDEST:
            out.append((at[mask], _mix(np.full(int(mask.sum()), kind), *(p[mask] for p in parts)), kept))

    for k in SUFFIXES:
        add(length >= k, 10 + k, node, end(k))
    add((length > SUFFIXES[0]) & (trade > 0), 6, node, end(SUFFIXES[0]), trade)
    add(length >= LONG_START, 1, node, start(LONG_START))
    # each word with each of the longest others of its name, and with itself
    order = np.lexsort((np.arange(n), -length, node))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    low = np.minimum(counts, OTHERS + 1)
    begins = np.cumsum(counts) - counts
    t = np.repeat(np.arange(n), low[node])
    x = order[np.repeat(begins[node], low[node]) + np.arange(len(t)) - np.repeat(np.cumsum(low[node]) - low[node], low[node])]
    itself = t == x
    alone = np.repeat(rank > OTHERS, low[node]) & (np.arange(len(t)) - np.repeat(np.cumsum(low[node]) - low[node], low[node]) == 0)
    t, x = np.concatenate([t, t[alone]]), np.concatenate([x, t[alone]])
    itself = t == x
    at = node[t]
    for k in REFINED[:-1]:
        add((length[t] >= k) & (length[t] + length[x] > 6), 20 + k, at, end(k)[t], start(START)[x])
    # the longest one with another word tells so much that it stays however many share it
    add((length[t] >= REFINED[-1]) & ~itself, 2, at, end(REFINED[-1])[t], start(START)[x], kept=True)
    add((length[t] >= REFINED[-1]) & itself, 7, at, end(REFINED[-1])[t], start(START)[t])
    # where that is common, the suffix with the beginnings of both words
    add((length[t] >= 6) & ~itself, 5, at, end(REFINED[0])[t], start(3)[t], start(3)[x])
    pair = (t < x) & ~itself
    a, b = np.minimum(start(START)[t], start(START)[x]), np.maximum(start(START)[t], start(START)[x])
    both = pair & (length[t] >= 3) & (length[x] >= 3)
    add(both, 3, at, a, b)
    add(both & (trade[t] > 0), 4, at, a, b, trade[t], kept=True)
    # the longer one of the telling word, which comes first in a reference name
    longer = ~itself & (length[t] > START) & (length[x] >= 3)
    if not typed:
        longer &= t == begins[at]
    add(longer, 8, at, start(START + 1)[t], start(3)[x], kept=True)
    places, made, kept = (np.concatenate(parts) for parts in ([p for p, _, _ in out], [k for _, k, _ in out], [np.full(len(p), keep) for p, _, keep in out]))
    return places, made, kept
