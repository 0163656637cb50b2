"""Candidates by hashed postings: what blocking.raw_candidates gives over blocking.weighted_index, with less to exchange.

Words are taken as 64-bit hashes of country, kind and word; pairs and triples of them are made for whole Arrow batches. Words, shapes,
pairs and triples of targets are exchanged only if a query may have them, by filters of the queries' keys. That loses nothing: how many targets have a pair or a triple
depends on no other key, and a query that has a triple has its pairs.

Queries are worked off in chunks, so that the hits of a chunk alone are on disk: a chunk has the queries of some countries, or a share of those of a large one, and
reads the targets of its countries. Records are known by numbers in the order of their ids. Keys and hits go through one exchange each, as packed
arrays, and are counted, joined, summed up and ranked where they arrive.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.config import KIND_WEIGHTS, PAIR_WEIGHT, LinkConfig
from weft.operators.signatures import _keys, _shapes, _with_words, longest_words, single_signatures
from weft.session import cut, lent, partitions, scope

#: Bits of the filter of the queries' keys: 8 MB at any size. Beyond some fifty million keys it lets more through, which costs time only.
FILTER_BITS = 1 << 26
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(*words: np.ndarray) -> np.ndarray:
    """One number for two or three, by their order."""
    out = np.full(len(words[0]), len(words), dtype=np.uint64)
    for word in words:
        out = (out ^ word) * _MIX
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def _known(keys: DataFrame) -> np.ndarray:
    """A bit for each key. At most FILTER_BITS / 64 numbers reach the driver."""
    word, bit = F.expr(f"cast(shiftright(key & {FILTER_BITS - 1}L, 6) as int)"), F.expr("shiftleft(1L, cast(key & 63L as int))")
    words = keys.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _passing(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(FILTER_BITS - 1)
    return (known[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sizes of the lists of a column, and their numbers one after the other."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def _table(sizes: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(sizes), width), dtype=np.uint64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _among(sought: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which numbers are among the known ones, which are in order."""
    if not len(known):
        return np.zeros(len(sought), dtype=bool)
    return known[np.minimum(np.searchsorted(known, sought), len(known) - 1)] == sought


def _combined(sizes: np.ndarray, values: np.ndarray, n: int, hot: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and keys of the pairs (n = 2) or triples (n = 3) of the words of lists.

    hot: says of rows and keys of their pairs which are refined; triples are made only of words two of which are such a pair.
    """
    width = int(sizes.max(initial=0))
    table = _table(sizes, values, width)
    every = np.arange(len(sizes))
    refined = {}
    for i, j in combinations(range(width), 2):
        at = every[sizes > j]
        made = _mixed(table[at, i], table[at, j])
        if n == 2:
            yield at, made
        else:
            refined[i, j] = np.zeros(len(sizes), dtype=bool)
            refined[i, j][at] = hot(at, made)
    if n == 3:
        for a, b, c in combinations(range(width), 3):
            at = every[(sizes > c) & (refined[a, b] | refined[a, c] | refined[b, c])]
            if len(at):
                yield at, _mixed(*(table[at, i] for i in (a, b, c)))


def hashed_words(records: DataFrame, longest: int = LinkConfig.longest_tokens) -> DataFrame:
    """entity_id, target_source where there is one, and words: the hashes of the longest words with their country, in order."""
    made = longest_words(records, longest)
    return made.select(*[c for c in made.columns if c not in ("country", "items")], F.transform("items", lambda w: F.xxhash64("country", w)).alias("words"))


def keys_of(words: DataFrame, n: int, known: object | None = None) -> DataFrame:
    """The key of each pair (n = 2) or triple (n = 3) of the words of each row, with the row's other columns; known: a broadcast filter.

    Triples are made only of words two of which have a key in the row's column `hot`.
    """
    kept = [f for f in words.schema.fields if f.name not in ("words", "hot")]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, values = _lists(batch.column("words"))
            if not len(values):
                continue
            hot = None
            if n == 3:
                counts, given = _lists(batch.column("hot"))
                # a row's number goes into the key, so that one row's pairs aren't taken for another's
                marks = np.sort(_mixed(np.repeat(np.arange(len(counts)), counts).astype(np.uint64), given))
                hot = lambda place, made, marks=marks: _among(_mixed(place.astype(np.uint64), made), marks)
            rows, keys = [], []
            for at, made in _combined(sizes, values, n, hot):
                if known is not None:
                    held = _passing(made, known.value)
                    at, made = at[held], made[held]
                rows.append(at)
                keys.append(made)
            if not rows:
                continue
            at, made = np.concatenate(rows), np.concatenate(keys)
            for start in range(0, len(at), 1 << 16):
                part = slice(start, start + (1 << 16))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at[part])) for c in names), pa.array(made[part].view(np.int64))], [*names, "key"])

    return words.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "key long"]))


def _counted(postings: DataFrame) -> DataFrame:
    """The postings, exchanged by key, with n: how many the key has in its source."""
    return postings.repartition("key").withColumn("n", F.count("*").over(Window.partitionBy("key", "target_source")))


def _single_keys(records: DataFrame) -> DataFrame:
    made = single_signatures(records)
    return made.select(*[c for c in made.columns if c != "signature"], F.xxhash64("country", "kind", "signature").alias("key"))


def _sought(keyed: DataFrame, known: object) -> DataFrame:
    """The rows whose key passes a broadcast filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = _passing(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64), known.value)
            if held.any():
                yield batch.filter(pa.array(held))

    return keyed.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema.fields))


def _rare_singles(targets: DataFrame, config: LinkConfig, known: object) -> DataFrame:
    """key, target_source, target_id, weight_micro and is_shape of the words and shapes that are rare enough and that a query may have.

    known: a broadcast filter of the queries' keys.
    """
    per_country = targets.groupBy("target_source", "country").agg(F.count("*").alias("country_count"))
    shape = F.col("kind").isin("ns", "as")
    rare = _counted(_sought(_single_keys(targets), known)).where(F.col("n") <= F.when(shape, config.max_shape_frequency).otherwise(config.max_token_frequency))
    kind: Column = F.create_map(*[F.lit(x) for pair in KIND_WEIGHTS.items() for x in pair])[F.col("kind")]
    weight = F.ln((F.col("country_count") + 1.0) / (F.col("n") + 0.5)) * kind
    return rare.join(F.broadcast(per_country), ["target_source", "country"]).select(
        "key", "target_source", F.col("entity_id").alias("target_id"), F.round(weight * 1e6).cast("long").alias("weight_micro"), shape.cast("int").alias("is_shape")
    )


#: Codes of the kinds of single keys, which are their two lowest bits.
_KINDS = ("ne", "ae", "ns", "as")
_SHAPE, _PAIR = 2, int(PAIR_WEIGHT * 1e6)
_BUCKETS = 64
#: Queries of a chunk at least; large inputs take as many as make CHUNKS, so that targets aren't read more often the more there are. HITS: rows that a step makes at once.
LEAST, CHUNKS, HITS = 1 << 17, 8, 1 << 20
#: Chunks are finished in so many shares, as texts take more room than numbers.
SHARES = 2
#: The sides of what is exchanged: single keys and pairs (or triples) of queries and of targets.
_ASKED, _HELD, _ASKED_PAIRS, _HELD_PAIRS = range(4)


def _numbered(records: DataFrame) -> DataFrame:
    """A written table of the different ids with number, in the order of source and id."""
    by = [c for c in ("target_source", "entity_id") if c in records.columns]
    placed = records.select(*by).distinct().repartitionByRange(partitions(records.sparkSession), *by).sortWithinPartitions(*by)
    written = cut(placed.withColumn("place", F.monotonically_increasing_id()))
    # the upper bits are the partition, the lower 33 the row in it
    row = F.col("place").bitwiseAND((1 << 33) - 1)
    high, most = written.agg(F.max(F.shiftright("place", 33)), F.max(row)).first()
    width = (most or 0) + 1
    if ((high or 0) + 1) * width >= 1 << 32:
        raise ValueError("more records than numbers of 32 bits")
    return written.withColumn("number", F.shiftright("place", 33) * width + row).drop("place")


def _signed(records: DataFrame, numbers: DataFrame, config: LinkConfig) -> DataFrame:
    """A written table of the records with number, own (not the row of the empty country besides another), bucket (of the country), singles and
    shapes: the keys, of which the first longest_tokens of singles are paired."""
    by, texts = [c for c in numbers.columns if c != "number"], ["name_norm", "address_norm"]
    # joined before anything is made of the texts, as keys can't be compressed
    placed = records.hint("merge").join(numbers.hint("merge"), by)
    made = placed.withColumn("own", F.lit(True))
    if config.blank_country and len(by) == 1:
        both = F.array_distinct(F.array(F.struct("country", F.lit(True).alias("own")), F.struct(F.lit("").alias("country"), (F.col("country") == "").alias("own"))))
        made = placed.select("*", F.explode(both).alias("c")).withColumns({"country": F.col("c.country"), "own": F.col("c.own")}).drop("c")

    def key(kind: Column, text: Column) -> Column:
        code = F.lit(3)
        for at, known in enumerate(_KINDS[:3]):
            code = F.when(kind == known, at).otherwise(code)
        return F.xxhash64("country", kind, text).bitwiseAND(F.lit(-4).cast("long")).bitwiseOR(code.cast("long"))

    words = F.array_sort(F.transform("words", lambda w: F.struct((-F.length(w["token"])).alias("l"), w["kind"].alias("kind"), w["token"].alias("token"))))
    keyed = _with_words(made, ["number", "own", *texts]).select(
        *by, "number", "own", "country", *texts, F.pmod(F.xxhash64("country"), F.lit(_BUCKETS)).cast("int").alias("bucket"),
        F.transform(words, lambda w: key(w["kind"], w["token"])).alias("singles"), F.transform(_shapes(), lambda s: key(s["kind"], s["signature"])).alias("shapes"),
    )
    if len(by) == 2:
        keyed = keyed.join(F.broadcast(records.groupBy("target_source", "country").agg(F.count("*").alias("country_count"))), ["target_source", "country"])
    return cut(keyed)


def _part(numbers: np.ndarray, parts: int) -> np.ndarray:
    return ((_mixed(numbers.astype(np.uint64)) >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)


def _packed(side: int, part: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The rows of arrays, as one row for each part: part, side, n and their compressed bytes, column by column."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    ends = np.r_[starts[1:], len(part)]
    columns = [c[order] for c in columns]
    codec = pa.Codec("zstd", compression_level=1)
    blobs = [codec.compress(b"".join(c[a:b].tobytes() for c in columns), asbytes=True) for a, b in zip(starts, ends, strict=True)]
    made = [pa.array(part[starts]), pa.array(np.full(len(starts), side, dtype=np.int32)), pa.array((ends - starts).astype(np.int32)), pa.array(blobs, pa.binary())]
    yield pa.RecordBatch.from_arrays(made, ["part", "side", "n", "rows"])


_PACKED = "part int, side int, n int, rows binary"
_KEYED, _HIT = (np.uint64, np.uint32, np.uint32), (np.uint32, np.uint32, np.uint32)


def _unpacked(batches: Iterator[pa.RecordBatch], kinds: tuple[type, ...]) -> dict[int, list[np.ndarray]]:
    """The arrays of each side."""
    found: dict[int, list[list[np.ndarray]]] = {}
    width, codec = sum(np.dtype(k).itemsize for k in kinds), pa.Codec("zstd")
    for batch in batches:
        for side, n, blob in zip(*(batch.column(c).to_pylist() for c in ("side", "n", "rows")), strict=True):
            whole, at, columns = codec.decompress(blob, n * width, asbytes=True), 0, []
            for kind in kinds:
                columns.append(np.frombuffer(whole, dtype=kind, count=n, offset=at))
                at += n * np.dtype(kind).itemsize
            found.setdefault(side, []).append(columns)
    return {side: [np.concatenate(c) for c in zip(*lists, strict=True)] for side, lists in found.items()}


def _made(batch: pa.RecordBatch, config: LinkConfig, hot: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and single keys, rows and pairs; with hot no single keys, and triples."""
    sizes, values = _lists(batch.column("singles"))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    paired = place < config.longest_tokens
    groups = list(_combined(np.minimum(sizes, config.longest_tokens), values[paired], 3 if hot else 2, hot))
    at, keys = (np.concatenate([g[i] for g in groups]) if groups else np.zeros(0, dtype=kind) for i, kind in enumerate((np.int64, np.uint64)))
    if hot:
        return rows[:0], values[:0], at, keys
    counts, shapes = _lists(batch.column("shapes"))
    return np.concatenate([rows, np.repeat(np.arange(len(counts)), counts)]), np.concatenate([values, shapes]), at, keys


def _hot_in(hot: object | None, sources: np.ndarray | None) -> Callable[[np.ndarray, np.ndarray], np.ndarray] | None:
    """Says of rows and pairs which are hot in the row's source; without sources, in any. hot: broadcast keys in order, by source."""
    if hot is None:
        return None
    if sources is None:
        every = np.unique(np.concatenate([*hot.value, np.zeros(0, dtype=np.uint64)]))
        return lambda _, keys: _among(keys, every)

    def found(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), dtype=bool)
        for at, known in enumerate(hot.value):
            own = sources[rows] == at
            out[own] = _among(keys[own], known)
        return out

    return found


def _filter(asked: DataFrame, config: LinkConfig, hot: object | None = None) -> np.ndarray:
    """The filter of all keys of the queries; each task sends its own, compressed."""
    size = FILTER_BITS // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, one = np.zeros(FILTER_BITS // 64, dtype=np.uint64), np.uint64(1)
        told = _hot_in(hot, None)
        for batch in batches:
            for keys in _made(batch, config, told)[1::2]:
                at = np.unique(keys & np.uint64(FILTER_BITS - 1))
                np.bitwise_or.at(bits, at >> np.uint64(6), one << (at & np.uint64(63)))
        yield pa.RecordBatch.from_arrays([pa.array([pa.Codec("zstd").compress(bits.tobytes(), asbytes=True)], pa.binary())], ["bits"])

    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    for row in asked.select("singles", "shapes").mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(pa.Codec("zstd").decompress(bytes(row.bits), size, asbytes=True), dtype=np.uint64)
    return out


def _sent(records: DataFrame, config: LinkConfig, parts: int, target: bool, known: object, starts: np.ndarray, hot: object | None = None) -> DataFrame:
    """The keys of records, packed by part of the key; of targets those that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("number").to_numpy(zero_copy_only=False).astype(np.uint32)
            counts = batch.column("country_count").to_numpy(zero_copy_only=False).astype(np.uint32) if target else np.zeros(len(numbers), dtype=np.uint32)
            told = _hot_in(hot, np.searchsorted(starts, numbers, "right") - 1 if target else None)
            single_rows, singles, rows, keys = _made(batch, config, told)
            for side, at, made in ((_ASKED, single_rows, singles), (_ASKED_PAIRS, rows, keys)):
                if target:
                    held = _passing(made, known.value)
                    at, made = at[held], made[held]
                yield from _packed(side + target, _part(made, parts), [made, numbers[at], counts[at] if side == _ASKED else np.zeros(len(at), dtype=np.uint32)])

    columns = ["number", "singles", "shapes", *(["country_count"] if target else [])]
    return records.select(*columns).mapInArrow(run, _PACKED)


def _hits(asked: tuple[np.ndarray, np.ndarray], keys: np.ndarray, numbers: np.ndarray, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query, target and weight of all that share a key; keys are in order."""
    order = np.argsort(asked[0])
    sought, queries = asked[0][order], asked[1][order]
    low, high = np.searchsorted(keys, sought, "left"), np.searchsorted(keys, sought, "right")
    some = high > low
    low, queries, n = low[some], queries[some], (high - low)[some]
    ends, start, before = np.cumsum(n), 0, 0
    while start < len(n):
        stop = max(start + 1, int(np.searchsorted(ends, before + HITS, "right")))
        own = n[start:stop]
        at = np.arange(own.sum()) + np.repeat(low[start:stop] - (np.cumsum(own) - own), own)
        yield np.repeat(queries[start:stop], own), numbers[at], weights[at]
        start, before = stop, int(ends[stop - 1])


def _joined(sent: DataFrame, config: LinkConfig, parts: int, starts: np.ndarray, again: bool) -> DataFrame:
    """The hits of exchanged keys, packed by part of the query, as side 0; and the keys of common pairs with the place of their source, as side 1.

    again: pairs are triples, of which an id has each but once and the common ones are left out.
    """
    kind = np.array([KIND_WEIGHTS[k] for k in _KINDS])
    limits = np.array([config.max_token_frequency] * 2 + [config.max_shape_frequency] * 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, empty = _unpacked(batches, _KEYED), [np.zeros(0, dtype=k) for k in _KEYED]
        for single, side in ((True, _ASKED), (False, _ASKED_PAIRS)):
            asked, (keys, numbers, counts) = found.pop(side, empty)[:2], found.pop(side + 1, empty)
            if not len(asked[0]) or not len(keys):
                continue
            order = np.lexsort((numbers, keys))
            keys, numbers, counts = keys[order], numbers[order], counts[order]
            if again:
                new = np.r_[True, (keys[1:] != keys[:-1]) | (numbers[1:] != numbers[:-1])]
                keys, numbers, counts = keys[new], numbers[new], counts[new]
                once = np.unique(_mixed(asked[0], asked[1].astype(np.uint64)), return_index=True)[1]
                asked = [c[once] for c in asked]
            source = np.searchsorted(starts, numbers, "right") - 1
            begin = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (source[1:] != source[:-1])])
            size = np.diff(np.r_[begin, len(keys)])
            n = np.repeat(size, size)
            if single:
                code = (keys & np.uint64(3)).astype(np.int64)
                rare = n <= limits[code]
                weights = np.floor(np.log((counts + 1.0) / (n + 0.5)) * kind[code] * 1e6 + 0.5).astype(np.uint32) | np.where(code >= _SHAPE, np.uint32(1 << 31), np.uint32(0))
            else:
                rare = np.ones(len(n), dtype=bool) if config.max_pair_frequency is None else n <= config.max_pair_frequency
                weights = np.full(len(n), _PAIR, dtype=np.uint32)
                if not again and not rare.all():
                    # of the common pairs those that a query has
                    first = begin[~rare[begin]]
                    first = first[_among(keys[first], np.sort(asked[0]))]
                    yield from _packed(1, np.zeros(len(first), dtype=np.int32), [keys[first], source[first].astype(np.uint32), np.zeros(len(first), dtype=np.uint32)])
            for queries, targets, weight in _hits(asked, keys[rare], numbers[rare], weights[rare]):
                order = np.argsort(queries, kind="stable")
                yield from _packed(0, _part(queries[order], parts), [queries[order], targets[order], weight[order]])

    return sent.repartitionById(parts, "part").mapInArrow(run, _PACKED)


def _summed(hits: DataFrame, parts: int, starts: np.ndarray, best: tuple[int, int, int] | None) -> DataFrame:
    """query, target (numbers), score_micro, exact_hits, shape_hits and contends, true of all but for best.

    best: how many of a query and source are kept, how many are final, and what likeness can add: see blocking.contenders.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _unpacked(batches, _HIT).get(0)
        if found is None:
            return
        both = found[0].astype(np.uint64) << np.uint64(32) | found[1]
        order = np.argsort(both)
        both, weight = both[order], found[2][order]
        begin = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
        score = np.add.reduceat((weight & np.uint32((1 << 31) - 1)).astype(np.int64), begin)
        shape = np.add.reduceat((weight >> np.uint32(31)).astype(np.int64), begin)
        exact = np.diff(np.r_[begin, len(both)]) - shape
        query, target = (both[begin] >> np.uint64(32)).astype(np.int64), (both[begin] & np.uint64((1 << 32) - 1)).astype(np.int64)
        contends = np.ones(len(query), dtype=bool)
        if best:
            kept, final, most = best
            source = np.searchsorted(starts, target, "right") - 1
            order = np.lexsort((target, -exact, -score, source, query))
            query, target, score, exact, shape, source = (c[order] for c in (query, target, score, exact, shape, source))
            first = np.flatnonzero(np.r_[True, (query[1:] != query[:-1]) | (source[1:] != source[:-1])])
            size = np.diff(np.r_[first, len(query)])
            last = np.where(np.minimum(size, kept) >= final, score[np.minimum(first + final - 1, len(score) - 1)], np.iinfo(np.int64).min)
            near = np.arange(len(query)) - np.repeat(first, size) < kept
            contends = score + most >= np.repeat(last, size)
            query, target, score, exact, shape, contends = (c[near] for c in (query, target, score, exact, shape, contends))
        columns = [query, target, score, exact.astype(np.int32), shape.astype(np.int32), contends]
        for at in range(0, len(query), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)]) for c in columns], ["query", "target", "score_micro", "exact_hits", "shape_hits", "contends"])

    return hits.repartitionById(parts, "part").mapInArrow(run, "query long, target long, score_micro long, exact_hits int, shape_hits int, contends boolean")


def _chunks(asked: DataFrame) -> list[tuple[list[int], int, int, int]]:
    """Buckets of countries, a share (of how many, which) of their queries, and about how many these are."""
    sizes = {r["bucket"]: r["n"] for r in asked.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    room = max(LEAST, sum(sizes.values()) // CHUNKS)
    made, small = [], Counter()
    for bucket, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        shares = -(-n // room)
        if shares > 1:
            made += [([bucket], shares, k, n // shares) for k in range(shares)]
        elif sum(small.values()) + n > room:
            made.append((list(small), 1, 0, sum(small.values())))
            small = Counter({bucket: n})
        else:
            small[bucket] = n
    return [*made, (list(small), 1, 0, sum(small.values()))] if small or not made else made


def by_chunks(queries: DataFrame, targets: DataFrame, config: LinkConfig, best: tuple[int, int, int] | None = None, finish: Callable[[DataFrame, DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The candidates of normalised queries among normalised targets, written chunk by chunk.

    finish: makes what is written of what `_summed` gives and of the signed queries and targets of the chunk; by default the ids are put in.
    """
    spark, results = targets.sparkSession, []
    with scope(spark):
        ids = _numbered(queries), _numbered(targets)
        asked, held = _signed(queries, ids[0], config), _signed(targets, ids[1], config)
        starts = np.sort(np.array([r["n"] for r in ids[1].groupBy("target_source").agg(F.min("number").alias("n")).collect()], dtype=np.int64))
        counts = {r["bucket"]: r["n"] for r in held.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        cores = spark.sparkContext.defaultParallelism
        for buckets, shares, share, n in _chunks(asked):
            own = F.col("bucket").isin(buckets) & (F.pmod(F.xxhash64("number"), F.lit(shares)) == share)
            part, among = asked.where(own), held.where(F.col("bucket").isin(buckets))
            parts = max(1, min(cores, n // 64), -(-(n + sum(counts.get(b, 0) for b in buckets) // 8) // 3000))
            with scope(spark):
                with scope(spark):
                    found = [cut(_keys_joined(part, among, config, parts, starts))]
                    if config.max_pair_frequency is not None:
                        common = _unpacked(found[0].where("side = 1").select("side", "n", "rows").toArrow().to_batches(), _KEYED).get(1)
                        if common is not None:
                            hot = lent(spark, [np.sort(common[0][common[1] == s]) for s in range(len(starts))])
                            found.append(cut(_keys_joined(part, among, config, parts, starts, hot)))
                    hits = found[0].where("side = 0")
                    for more in found[1:]:
                        hits = hits.unionByName(more)
                    made = cut(_summed(hits, parts, starts, best), keep=1)
                for k in range(SHARES if n > LEAST // SHARES else 1):
                    some = made.where(F.col("query") % SHARES == k) if n > LEAST // SHARES else made
                    results.append(cut(finish(some, part, among) if finish else _identified(some, *ids), keep=2))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _keys_joined(part: DataFrame, among: DataFrame, config: LinkConfig, parts: int, starts: np.ndarray, hot: object | None = None) -> DataFrame:
    known = lent(part.sparkSession, _filter(part, config, hot))
    sent = _sent(part, config, parts, False, known, starts, hot).unionByName(_sent(among, config, parts, True, known, starts, hot))
    return _joined(sent, config, parts, starts, hot is not None)


def _identified(found: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The ids in place of the numbers: query_id, target_source, target_id, score_micro, exact_hits, shape_hits. queries, targets: the numbers of ids."""
    q = queries.select(F.col("number").alias("query"), F.col("entity_id").alias("query_id"))
    t = targets.select(F.col("number").alias("target"), "target_source", F.col("entity_id").alias("target_id"))
    both = found.hint("merge").join(t.hint("merge"), "target").join(q.hint("merge"), "query")
    return both.select("query_id", "target_source", "target_id", "score_micro", "exact_hits", "shape_hits")


def retrieve_raw(queries: DataFrame, targets: DataFrame, config: LinkConfig = LinkConfig()) -> DataFrame:
    """query_id, target_source, target_id, score_micro, exact_hits, shape_hits of all pairs of normalised records that share a posting."""
    return by_chunks(queries, targets, config)
