"""Similarities of texts as column expressions. Characters count as bytes of UTF-8."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def as_bytes(text: Column) -> Column:
    """A text in which each character stands for a byte of the other's UTF-8."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 less the byte edit distance over the longer length in characters; 1 for two empty texts."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(as_bytes(a), as_bytes(b)) / longer)


def set_jaccard(a: Column, b: Column) -> Column:
    """Common over all different items of two arrays; 1 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def _byte_sets(texts: pd.Series) -> np.ndarray:
    """Of each text which bytes it has."""
    encoded = [(t or "").encode() for t in texts]
    out = np.zeros((len(encoded), 256), dtype=bool)
    out[np.repeat(np.arange(len(encoded)), [len(t) for t in encoded]), np.frombuffer(b"".join(encoded), dtype=np.uint8)] = True
    return out


@F.pandas_udf(StructType([StructField("first", DoubleType()), StructField("second", DoubleType())]))
def byte_jaccards(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
    """Jaccard of the sets of bytes of a and b, and of c and d; 0 if either text is empty. Null counts as empty."""
    found = []
    for x, y in ((a, b), (c, d)):
        left, right = _byte_sets(x), _byte_sets(y)
        union = (left | right).sum(axis=1)
        empty = ~(left.any(axis=1) & right.any(axis=1))
        found.append(np.where(empty, 0.0, (left & right).sum(axis=1) / np.maximum(union, 1)))
    return pd.DataFrame({"first": found[0], "second": found[1]})


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def _matrix(texts: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(texts), width), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    rows, columns = _places(sizes)
    out[rows, columns] = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return out


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each item of lists of these sizes."""
    return np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _matched(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which characters of each text find one of the other's: each of a in turn the first free equal one within the window."""
    place = np.arange(b.shape[1])
    free = place[None, :] < lb[:, None]
    in_a = np.zeros(a.shape, dtype=bool)
    rows = np.arange(len(a))
    for i in range(a.shape[1]):
        near = free & (b == a[:, i, None]) & (np.abs(place - i)[None, :] <= window[:, None]) & (i < la)[:, None]
        hit = near.any(axis=1)
        in_a[:, i] = hit
        free[rows[hit], near.argmax(axis=1)[hit]] = False
    return in_a, ~free & (place[None, :] < lb[:, None])


#: The bits of the places within a window of a place: by place, then by window.
_REACH = np.array([[sum(1 << j for j in range(max(0, i - w), min(64, i + w + 1))) for w in range(64)] for i in range(64)], dtype=np.uint64)


def _matched_by_bits(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for texts of up to 64 bytes, whose places are the bits of one number."""
    n, one = len(a), np.uint64(1)
    codes = np.zeros(256, dtype=np.int64)
    seen = np.nonzero(np.bincount(b.ravel(), minlength=256))[0]
    codes[seen] = np.arange(len(seen)) + 1
    # places beyond a text of b have the last code, which a doesn't ask for; what b never has, and places beyond a text of a, are 0
    width = len(seen) + 2
    starts = np.arange(n) * width
    ca = np.ascontiguousarray(np.where(np.arange(a.shape[1])[None, :] < la[:, None], codes[a], 0).T)
    cb = np.ascontiguousarray(np.where(np.arange(b.shape[1])[None, :] < lb[:, None], codes[b], width - 1).T)
    where = np.zeros(n * width, dtype=np.uint64)
    for j in range(b.shape[1]):
        where[starts + cb[j]] |= one << np.uint64(j)
    used = np.zeros(n, dtype=np.uint64)
    in_a = np.zeros((a.shape[1], n), dtype=bool)
    for i in range(a.shape[1]):
        near = where[starts + ca[i]] & _REACH[i][window] & ~used
        used |= near & (~near + one)
        in_a[i] = near != 0
    return in_a.T, ((used[:, None] >> np.arange(b.shape[1]).astype(np.uint64)) & one).astype(bool)


def jaro_winkler_arrays(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Jaro-Winkler similarity of pairs of byte strings, all pairs at once.

    The window is half the longer length less one; a common prefix of up to 4 adds a tenth each of what is missing where Jaro is
    above 0.7. 0 if either side is empty.
    """
    n = len(left)
    long = np.array([max(len(x), len(y)) > 64 for x, y in zip(left, right, strict=True)], dtype=bool)
    if long.any() and not long.all():
        out = np.zeros(n)
        for part in (np.nonzero(long)[0], np.nonzero(~long)[0]):
            out[part] = jaro_winkler_arrays([left[i] for i in part], [right[i] for i in part])
        return out
    la, lb = np.array([len(t) for t in left], dtype=np.int64), np.array([len(t) for t in right], dtype=np.int64)
    if not n or not max(la.max(), lb.max()):
        return np.zeros(n)
    a, b = _matrix(left, max(1, la.max())), _matrix(right, max(1, lb.max()))
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    in_a, in_b = (_matched if long.any() else _matched_by_bits)(a, b, la, lb, window)
    m = in_a.sum(axis=1)
    most = max(1, m.max())
    first, second = np.zeros((n, most), dtype=np.uint8), np.zeros((n, most), dtype=np.uint8)
    for mask, source, to in ((in_a, a, first), (in_b, b, second)):
        to[_places(m)] = source[mask]
    swapped = (first != second).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - swapped) / m) / 3, 0.0)
    width = min(4, a.shape[1], b.shape[1])
    same = (a[:, :width] == b[:, :width]) & (np.arange(width)[None, :] < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)


@F.pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.zeros(len(a))
    left, right = [(t or "").encode() for t in a], [(t or "").encode() for t in b]
    # pairs of like lengths together, so that one long text doesn't widen all
    order = np.argsort([max(len(x), len(y)) for x, y in zip(left, right, strict=True)], kind="stable")
    for start in range(0, len(order), 2048):
        part = order[start : start + 2048]
        out[part] = jaro_winkler_arrays([left[i] for i in part], [right[i] for i in part])
    return pd.Series(out)


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler similarity of two texts, in Arrow batches; null counts as empty."""
    return _jaro_winkler(a, b)
