"""Fill fixed-capacity containers with items, none split unless it alone exceeds the capacity: variable-capacity best fit.

Packing looks only at how many items there are of each size, which is a table of at most capacity + 1 rows whatever the corpus. It
is packed on the driver into patterns (a container's sizes, and how many containers are alike), and every item finds its place from
its size and its rank among the items of that size, so items are never gathered.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.tokens import DEFAULT_VOCABULARY, count_tokens
from weft.session import cut, partitions


@dataclass(frozen=True)
class Slot:
    """Items of one size with ranks from `base` on: `each` in every one of `times` containers from `first` on, from position `start`."""

    size: int
    base: int
    each: int
    times: int
    first: int
    start: int
    capacity: int


@dataclass
class _Open:
    """`count` open containers from `first` on that hold the same: `room` is left of `length`."""

    first: int
    count: int
    length: int
    room: int


def _placed(group: _Open, size: int, n: int) -> list[tuple[_Open, int]]:
    """The group cut up as n items of a size go into it, container by container, with how many each container of a part gets."""
    each = group.room // size
    full = min(group.count, n // each)
    parts, rest = [], min(each, n - full * each) if full < group.count else 0
    at = group.first
    for count, k in ((full, each), (1 if rest else 0, rest), (group.count - full - (1 if rest else 0), 0)):
        if count:
            parts.append((_Open(at, count, group.length, group.room - k * size), k))
            at += count
    return parts


def pack_histogram(histogram: dict[int, int], lengths: tuple[int, ...], costs: tuple[float, ...] | None = None) -> tuple[list[Slot], int]:
    """Pack items given by size and number into containers of the permitted lengths. Returns the slots and the number of containers.

    Best fit, the largest size first: items go into the open containers with the least room that holds one; where there is none, the
    length of the least cost is opened for each token that it may come to hold, of equal ones the longest. At last each container is
    downsized to the shortest permitted length that holds its contents. costs: of each length, by default the length itself. Alike
    containers are handled as one, so the work depends on the number of sizes only. Sizes of 0 take no room and are left out; an
    empty histogram has no container.
    """
    left = {size: n for size, n in histogram.items() if size > 0 and n > 0}
    kinds = sorted(zip(lengths, costs or lengths, strict=True))
    if left and max(left) > kinds[-1][0]:
        raise ValueError("an item exceeds the largest permitted length")
    smaller = sum(size * n for size, n in left.items())
    rooms: dict[int, list[_Open]] = {}
    slots: list[Slot] = []
    containers = 0
    for size in sorted(left, reverse=True):
        n, used = left[size], 0
        smaller -= size * n

        def put(parts: list[tuple[_Open, int]], size: int = size) -> int:
            placed = 0
            for part, k in parts:
                if k:
                    slots.append(Slot(size, used + placed, k, part.count, part.first, part.length - part.room - k * size, part.length))
                    placed += k * part.count
                rooms.setdefault(part.room, []).append(part)
            return placed

        for room in sorted(r for r in rooms if r >= size):
            if used == n:
                break
            for group in rooms.pop(room):
                if used == n:
                    rooms.setdefault(room, []).append(group)
                else:
                    used += put(_placed(group, size, n - used))
        while used < n:
            fitting = [(cost / min(length, min(length // size, n - used) * size + smaller), -length) for length, cost in kinds if length >= size]
            length = -min(fitting)[1]
            count = -(-(n - used) // (length // size))
            used += put(_placed(_Open(containers, count, length, length), size, n - used))
            containers += count
    final = {}
    for groups in rooms.values():
        for group in groups:
            final[group.first] = (group.first + group.count, next(length for length, _ in kinds if length >= group.length - group.room))
    # a slot's containers may have been told apart by later sizes; it is cut where their final lengths differ
    starts = sorted(final)
    out = []
    for slot in slots:
        first, end, base = slot.first, slot.first + slot.times, slot.base
        while first < end:
            group = starts[bisect_right(starts, first) - 1]
            times = min(end, final[group][0]) - first
            out.append(Slot(slot.size, base, slot.each, times, first, slot.start, final[group][1]))
            first, base = first + times, base + slot.each * times
    return out, containers


def pack_items(items: DataFrame, lengths: tuple[int, ...], key: str = "doc_id", costs: tuple[float, ...] | None = None) -> DataFrame:
    """Place items (key, piece, first_token, n_tokens), n_tokens at most the largest length, into containers.

    Result: container_id, capacity, key, piece, first_token, n_tokens, start (the place of the item's first token in its container).
    Items of 0 tokens are spread over the containers by their key. Ranks of equal sizes are taken in hashed sub-groups, so a
    size that a third of all items have is no hot spot; the same input always gives the same containers.
    """
    salts = 4 * partitions(items.sparkSession)
    items = items.withColumn("salt", F.pmod(F.xxhash64(key, "piece"), F.lit(salts)))
    grouped = items.groupBy("n_tokens", "salt").agg(F.count("*").alias("n"))
    histogram = {row.n_tokens: row.n for row in grouped.groupBy("n_tokens").agg(F.sum("n").alias("n")).collect()}
    slots, containers = pack_histogram(histogram, lengths, costs)
    slots = sorted(slots, key=lambda s: (s.size, s.base))
    # one number orders the slots by size and rank; ranks stay under 2 ** 44
    at = np.array([s.size << 44 | s.base for s in slots], dtype=np.int64)
    columns = {name: np.array([getattr(s, name) for s in slots], dtype=np.int64) for name in ("size", "base", "each", "first", "start", "capacity")}
    before = Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = grouped.select("n_tokens", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("n_tokens", "salt").orderBy(key, "piece")) - 1
    ranked = items.withColumn("rank", within).join(offsets, ["n_tokens", "salt"]).select(key, "piece", "first_token", "n_tokens", (F.col("rank") + F.col("offset")).alias("rank"), F.pmod(F.xxhash64(key), F.lit(max(1, containers))).alias("any"))
    largest = max(lengths)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            size, rank = frame["n_tokens"].to_numpy(), frame["rank"].to_numpy()
            out = frame[[key, "piece", "first_token", "n_tokens"]].copy()
            if len(at):
                slot = np.clip(np.searchsorted(at, size << 44 | rank, side="right") - 1, 0, None)
                index, each = rank - columns["base"][slot], columns["each"][slot]
                out["container_id"] = np.where(size > 0, columns["first"][slot] + index // each, frame["any"])
                out["capacity"] = np.where(size > 0, columns["capacity"][slot], largest)
                out["start"] = np.where(size > 0, columns["start"][slot] + index % each * size, 0)
            else:
                out["container_id"], out["capacity"], out["start"] = frame["any"], largest, 0
            yield out[["container_id", "capacity", key, "piece", "first_token", "n_tokens", "start"]]

    kind = items.schema[key].dataType.simpleString()
    return ranked.mapInPandas(place, f"container_id long, capacity int, `{key}` {kind}, piece int, first_token long, n_tokens long, start int")


def pack_documents(documents: DataFrame, lengths: tuple[int, ...] = (1024,), key: str = "doc_id", text: str = "text", vocabulary: str = DEFAULT_VOCABULARY, costs: tuple[float, ...] | None = None) -> DataFrame:
    """Place every document into containers of the permitted lengths; sizes are in tokens of the vocabulary. costs: see pack_histogram.

    A document longer than the largest length is cut into pieces of that length and a rest; others stay whole. Null and empty texts
    have 0 tokens and are placed too. The key must be unique for a stable result; repeated rows of one key are each placed. An
    empty table gives an empty result; other columns are not read.
    """
    largest = max(lengths)
    sizes = cut(count_tokens(documents, key, text, vocabulary))
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / largest).cast("int") - 1)
    pieces = sizes.select(key, "n_tokens", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    first = (F.col("piece") * largest).cast("long")
    return pack_items(pieces.select(key, "piece", first.alias("first_token"), F.least(F.lit(largest).cast("long"), F.col("n_tokens") - first).alias("n_tokens")), lengths, key, costs)
