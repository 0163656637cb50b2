"""Link names, and link addresses, of a reference source and typed ones: candidates by shared keys, then a comparison of each pair.

Rows with one reading (the same parts of a name, or levels of an address) are handled as one node, so copies, however many, are
compared once; links between nodes are joined with their members at the end. Keys and pairs are shuffled as 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm import addresses, likeness, names, suffixes
from weft.llm.tokens import spread
from weft.session import cut, lent, scope


def read_names(records: DataFrame, reference: bool = False) -> DataFrame:
    """entity_id and node, the parts of business_name as text, of records whose name has a core; distinct rows. Null ids are left out.

    reference: keep the words as they are; those of typed names are brought to fewer readings.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parsed = [names.parse(v) for v in frame["business_name"]]
            yield pd.DataFrame({"entity_id": frame["entity_id"], "node": [(n.text() if reference else n.node()) if n.core else None for n in parsed]})

    return spread(records.select("entity_id", "business_name")).mapInPandas(run, "entity_id string, node string").where("node is not null and entity_id is not null").distinct()


def telling_first(read: DataFrame) -> DataFrame:
    """The same names with the words of each core in order of how few distinct names have them, the rarest (then the longest) first."""
    nodes = read.select("node").distinct().withColumn("part", F.split("node", "\\|"))
    words = nodes.select("node", F.explode(F.array_distinct(F.split(F.col("part")[0], " "))).alias("word"))
    rarity = words.groupBy("word").agg(F.count("*").alias("n"))
    ordered = words.join(rarity, "word").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", (-F.length("word")).alias("l"), "word"))).alias("core"))
    part = F.split("node", "\\|")
    text = F.concat_ws("|", F.concat_ws(" ", F.col("core.word")), part[1], part[2])
    return read.join(ordered.select("node", text.alias("ordered")), "node").select("entity_id", F.col("ordered").alias("node"))


#: Bits of the filter of reference keys: 8 MB, whatever the corpus. Beyond some fifty million keys it lets more through, which costs time only.
FILTER_BITS = 1 << 26
#: Strengths that differ by no more are equal: two organisations fit equally well.
CLOSE = 0.02
#: How many names may share a suffix before it counts as common.
COMMON = 4


def _filter_of(keys: DataFrame) -> bytes:
    """A bit for each hash of a key, compressed. At most FILTER_BITS / 64 numbers reach the driver."""
    word, bit = F.expr(f"cast(shiftright(key & {FILTER_BITS - 1}L, 6) as int)"), F.expr("shiftleft(1L, cast(key & 63L as int))")
    words = keys.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return zlib.compress(out.tobytes(), 1)


def _filter_from(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype=np.uint64)


def _passing(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(FILTER_BITS - 1)
    return (known[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _once(at: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Where each different key of each text is met first."""
    order = np.lexsort((made, at))
    a, k = at[order], made[order]
    return order[np.concatenate([[True], (a[1:] != a[:-1]) | (k[1:] != k[:-1])])] if len(order) else order


#: What makes the keys of a batch of texts: places of the texts, keys, and whether a key stays in the index however common it is.
Keys = Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def key_index(nodes: DataFrame, keys: Keys, common: int | None = COMMON, mark: bool = False) -> DataFrame:
    """id and key of every key of every node (columns id, node), without those that more than `common` rows share, unless they are kept; written once.

    common: None leaves out no key. mark: keys that were left out have one row, without an id.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at, made, kept = keys(list(frame["node"]))
            once = _once(at, made)
            yield pd.DataFrame({"id": frame["id"].to_numpy()[at[once]], "key": made[once].view(np.int64), "kept": kept[once]})

    every = nodes.select("id", "node").mapInPandas(run, "id long, key long, kept boolean")
    if common is None:
        return cut(every.select("id", "key"))
    # counted within the one exchange of the keys
    same = Window.partitionBy("key")
    counted = every.repartition("key").withColumn("stays", (F.count("*").over(same) <= common) | F.max("kept").over(same))
    if not mark:
        return cut(counted.where("stays").select("id", "key"))
    marked = counted.withColumn("nth", F.row_number().over(same.orderBy("id"))).where("stays or nth = 1")
    return cut(marked.select(F.when(F.col("stays"), F.col("id")).alias("id"), "key"))


def key_candidates(index: DataFrame, typed: DataFrame, keys: Keys, distinct: bool = True) -> DataFrame:
    """a, b: the ids of all distinct pairs of an indexed node and a typed one (columns id, node) that share a key of the index.

    Keys of typed nodes that the index hasn't are left out before they are shuffled. a is null where a key was left out as common.
    distinct: False leaves a pair as often as it shares keys.
    """
    known = lent(typed.sparkSession, _filter_of(index))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_by_index = _filter_from(known.value)
        for frame in frames:
            at, made, _ = keys(list(frame["node"]))
            held = _passing(made, held_by_index)
            at, made = at[held], made[held]
            once = _once(at, made)
            if len(once):
                yield pd.DataFrame({"b": frame["id"].to_numpy()[at[once]], "key": made[once].view(np.int64)})

    sought = typed.select("id", "node").mapInPandas(run, "b long, key long")
    pairs = index.withColumnRenamed("id", "a").join(sought, "key").select("a", "b")
    return pairs.distinct() if distinct else pairs


def _telling(frame: pd.DataFrame, keys: Keys) -> pd.DataFrame:
    """id, key and text, the words of its core, of every key of every node."""
    at, made, _ = keys(list(frame["node"]))
    once = _once(at, made)
    text = frame["node"].str.partition("|")[0].to_numpy()
    return pd.DataFrame({"id": frame["id"].to_numpy()[at[once]], "key": made[once].view(np.int64), "text": text[at[once]]})


def _fitting(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """a, b of indexed and typed rows (typed, id, key, text; in order of key, indexed ones first) of one key whose telling words fit."""
    key, ids, texts = None, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=object)
    for frame in frames:
        typed, every, at, text = (frame[c].to_numpy() for c in ("typed", "id", "key", "text"))
        bounds = np.concatenate([[0], np.nonzero(at[1:] != at[:-1])[0] + 1, [len(at)]])
        # indexed rows of a key that began in the frame before come first
        if len(at) and at[0] != key:
            ids, texts = ids[:0], texts[:0]
        before = len(texts)
        ids, texts = np.concatenate([ids, every[~typed]]), np.concatenate([texts, text[~typed]])
        place = np.concatenate([[0], np.cumsum(~typed)])
        begins, ends = np.where(bounds[:-1] == 0, 0, before + place[bounds[:-1]]), before + place[bounds[1:]]
        number: dict[str, int] = {}
        told = [t.partition(" ")[0] for t in texts]
        words = np.fromiter((number.setdefault(w, len(number)) for w in told), dtype=np.int64, count=len(told))
        starts = np.fromiter((sum({1 << (ord(w[0]) & 63) for w in t.split()}) if " " in t else 0 for t in texts), dtype=np.uint64, count=len(texts))
        # neighbours that are longer by more stand for no telling word of the key
        sizes = np.fromiter(map(len, told), dtype=np.int64, count=len(told))
        longest = np.array([sizes[i:j].max() + 2 if j > i else 0 for i, j in zip(begins, ends, strict=True)], dtype=np.int64)
        asking = np.cumsum(np.concatenate([[0], typed]))
        flat: list[int] = []
        counts: list[int] = []
        for t, most in zip(text[typed], np.repeat(longest, asking[bounds[1:]] - asking[bounds[:-1]]).tolist(), strict=True):
            core = tuple(t.split()) if most else ()
            if len(core) == 2 and len(t) - 1 > most:
                made = [2 * number.setdefault(o, len(number)) + 1 for o in core]
            else:
                made = [2 * number.setdefault(o, len(number)) + (i == j) for o, i, j in names.options(core) if i == j or len(o) <= most]
            flat += made
            counts.append(len(made))
        options, held = np.array(flat, dtype=np.int64), np.array(counts, dtype=np.int64)
        where = np.concatenate([[0], np.cumsum(held)])
        table = likeness.Telling(list(number))
        found, waiting = [], 0

        def judged() -> pd.DataFrame:
            told_, asked_, glued, places, rows_ = (np.concatenate(part) for part in zip(*((p, q, g, i, r) for p, q, g, i, r, _, _, _ in found), strict=True))
            good = table.fit(told_, asked_, glued)
            out, start = [], 0
            for p, _, _, _, _, begin, order, row in found:
                fit = good[start : start + len(p)]
                a, b = places[start : start + len(p)][fit], rows_[start : start + len(p)][fit]
                start += len(p)
                n = begin[b + 1] - begin[b]
                out.append(np.stack([np.repeat(a, n), row[order[np.repeat(begin[b] - (np.cumsum(n) - n), n) + np.arange(n.sum())]]]))
            a, b = np.concatenate(out, axis=1)
            return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

        for low, high, begin, end in zip(bounds, bounds[1:], begins, ends, strict=False):
            first, last = asking[low], asking[high]
            if first == last or begin == end:
                continue
            row = np.repeat(every[high - (last - first) : high], held[first:last])
            # each different option once
            asked, back = np.unique(options[where[first] : where[last]], return_inverse=True)
            a, b, glued = table.may_fit(words[begin:end], starts[begin:end], asked >> 1, (asked & 1) > 0)
            order = np.argsort(back, kind="stable")
            found.append((words[begin:end][a], asked[b] >> 1, glued, ids[begin:end][a], b, np.searchsorted(back[order], np.arange(len(asked) + 1)), order, row))
            waiting += len(a)
            if waiting > 1 << 19:
                yield judged()
                found, waiting = [], 0
        if found:
            yield judged()
        if len(at):
            key, ids, texts = at[-1], ids[begins[-1] :], texts[begins[-1] :]


def common_candidates(a: DataFrame, b: DataFrame, common: int = COMMON) -> DataFrame:
    """a, b: the ids of all pairs of a reference node and a typed one that share a key which the index leaves out as common, if they can match.

    A pair is given once a key or oftener. All pairs of such a key are compared by their telling words, so that leaving it out loses none. Keys that imply a wider one aren't asked.
    """
    indexed = a.select("id", "node").mapInPandas(lambda frames: (_telling(f, lambda t: suffixes.keys(t, False, widest=True)) for f in frames), "id long, key long, text string")
    counted = indexed.repartition("key").withColumn("n", F.count("*").over(Window.partitionBy("key"))).where(F.col("n") > common)
    hot = cut(counted.select(F.lit(False).alias("typed"), "id", "key", "text"))
    known = lent(a.sparkSession, _filter_of(hot))

    def seek(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = _filter_from(known.value)
        for frame in frames:
            made = _telling(frame, lambda t: suffixes.keys(t, True, widest=True))
            yield made[_passing(made["key"].to_numpy().view(np.uint64), held)]

    sought = b.select("id", "node").mapInPandas(seek, "id long, key long, text string").select(F.lit(True).alias("typed"), "id", "key", "text")
    return hot.unionByName(sought).repartition("key").sortWithinPartitions("key", "typed").mapInPandas(_fitting, "a long, b long")


def _nodes(read: DataFrame) -> DataFrame:
    return read.select("node").distinct().select(F.xxhash64("node").alias("id"), "node")


def _core(node: str) -> Column:
    """The core's words in alphabetical order; null for a core of one word."""
    core = F.split(F.split(node, "\\|")[0], " ")
    return F.when(F.size(core) > 1, F.array_join(F.array_sort(core), " "))


def name_candidates(reference: DataFrame, typed: DataFrame) -> DataFrame:
    """a, b (hashes of the nodes), node (of the reference), typed_node and n_a, n_b, the rows that have them, of pairs of name nodes that may mean one organisation.

    A typed name of two or more words that are those of a reference name is paired with the names of these words: its likeness to
    them is the highest there is. All other typed names are sought by their suffixes, by the common ones too.
    """
    # small numbers in place of hashes, which don't compress, while pairs are sought
    number = F.monotonically_increasing_id().alias("id")
    a = cut(reference.groupBy("node").agg(F.count("*").alias("n_a")).select(number, "node", "n_a"))
    cores = a.select("node", "n_a", _core("node").alias("core"))
    sought = typed.groupBy(F.col("node").alias("typed_node")).agg(F.count("*").alias("n_b")).withColumn("core", _core("typed_node"))
    looked = cut(sought.join(cores.where("core is not null"), "core", "left").select(number, "node", "n_a", "typed_node", "n_b"))
    rest = looked.where("node is null").select("id", F.col("typed_node").alias("node"))
    with scope(reference.sparkSession):
        with scope(reference.sparkSession):
            rare = cut(key_candidates(key_index(a, reference_keys), rest, typed_keys, distinct=False), keep=True)
        with scope(reference.sparkSession):
            common = cut(common_candidates(a, rest), keep=True)
        pairs = cut(rare.unionByName(common).distinct(), keep=True)
    found = pairs.join(a.withColumnRenamed("id", "a"), "a").join(looked.where("node is null").select(F.col("id").alias("b"), "typed_node", "n_b"), "b")
    columns = ["node", "typed_node", "n_a", "n_b"]
    both = looked.where("node is not null").select(*columns).unionByName(found.select(*columns))
    return both.select(F.xxhash64("node").alias("a"), F.xxhash64("typed_node").alias("b"), *columns)


def reference_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return suffixes.keys(texts, typed=False)


def typed_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return suffixes.keys(texts, typed=True)


def score_names(pairs: DataFrame) -> DataFrame:
    """The columns of the pairs but node and typed_node, with main, second, trade, unused, alike (names.matches) and strength."""
    kept = [f for f in pairs.schema.fields if f.name not in ("node", "typed_node")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scores = likeness.compare_names(list(frame["node"]), list(frame["typed_node"]))
            made = dict(zip(("main", "second", "trade", "unused"), scores.T, strict=True))
            yield frame[[f.name for f in kept]].assign(**made, alike=likeness.matching(scores), strength=likeness.strengths(scores))

    return pairs.mapInPandas(run, f"{schema}, main double, second double, trade double, unused double, alike boolean, strength double")


def same_names(source: DataFrame, typed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of name nodes (a, b: their hashes) that mean one organisation, and the members of both sides (entity_id, node).

    A typed name that fits several organisations is linked to the one it fits best; where two fit equally well it stays unlinked,
    for it doesn't tell which. Nodes that hold the same words in one order are one organisation.
    """
    a, b = cut(telling_first(cut(read_names(source, reference=True)))), cut(read_names(typed))
    pairs = name_candidates(a, b).drop("n_a", "n_b").withColumn("organisation", F.xxhash64(F.split("node", "\\|")[0]))
    scored = score_names(pairs).where("alike").select("a", "b", "strength", "organisation")
    by_typed = Window.partitionBy("b")
    best = scored.withColumn("best", F.max("strength").over(by_typed)).where(f"strength >= best - {CLOSE}")
    told = best.withColumn("other", F.max("organisation").over(by_typed) != F.min("organisation").over(by_typed)).where("not other")
    return told.select("a", "b"), a, b


def link_names(source: DataFrame, typed: DataFrame) -> DataFrame:
    """All pairs (source1_entity_id, typed_entity_id) of records whose names mean one organisation; distinct rows.

    Null, blank and purely legal names are in no pair; repeated rows give no repeated pair; an empty side gives an empty result;
    columns other than entity_id and business_name aren't read.
    """
    links, a, b = same_names(source, typed)
    left = links.join(a.select(F.xxhash64("node").alias("a"), F.col("entity_id").alias("source1_entity_id")), "a")
    return left.join(b.select(F.xxhash64("node").alias("b"), F.col("entity_id").alias("typed_entity_id")), "b").select("source1_entity_id", "typed_entity_id").distinct()


def read_places(records: DataFrame) -> DataFrame:
    """entity_id and node, the place that business_address tells, of records whose address tells one; distinct rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            places = [addresses.read_place(v) for v in frame["business_address"]]
            yield pd.DataFrame({"entity_id": frame["entity_id"], "node": [p.text() if p else None for p in places]})

    return spread(records.select("entity_id", "business_address")).mapInPandas(run, "entity_id string, node string").where("node is not null and entity_id is not null").distinct()


def read_addresses(records: DataFrame) -> DataFrame:
    """entity_id and node, the levels of business_address as typed, of records whose address can tell a building; distinct rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            read = [addresses.read_address(v) for v in frame["business_address"]]
            yield pd.DataFrame({"entity_id": frame["entity_id"], "node": [a.text() if addresses.tells_building(a) else None for a in read]})

    return spread(records.select("entity_id", "business_address")).mapInPandas(run, "entity_id string, node string").where("node is not null and entity_id is not null").distinct()


def hashed(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of keys the place of each key's list, its hash, and that it is kept."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    made = np.fromiter((xxhash.xxh64_intdigest(k) for row in lists for k in row), dtype=np.uint64, count=int(sizes.sum()))
    return np.repeat(np.arange(len(lists)), sizes), made, np.ones(len(made), dtype=bool)


def place_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, made, kept = hashed([sorted(addresses.place_keys(addresses.place_from(t))) for t in texts])
    return at, made, ~kept


def typed_address_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return hashed([sorted(addresses.typed_keys(addresses.address_from(t))) for t in texts])


def refined_place_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return hashed([sorted(addresses.refined_place_keys(addresses.place_from(t))) for t in texts])


def refined_typed_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return hashed([sorted(addresses.refined_typed_keys(addresses.address_from(t))) for t in texts])


#: How many places may share a number with a part of a street, or with a code, before such a key counts as common.
COMMON_PLACES = 48


def address_candidates(places: DataFrame, typed: DataFrame, common: int = COMMON_PLACES, whole: bool = False) -> DataFrame:
    """a, b, node and typed_node of pairs of address nodes that share a key.

    A key of a number and a street alone may be that of many towns. The typed addresses that have such a common key are sought by the
    number and the street within the code or the locality. whole: all pairs of a common key are compared too, so a slip in the
    locality loses none; of those only the ones that are the same building are given.
    """
    a, b = _nodes(places), _nodes(typed)
    index = key_index(a, place_keys, common, mark=True)
    found = cut(key_candidates(index, b, typed_address_keys))
    crowded = cut(found.where("a is null").select(F.col("b").alias("id")))
    pairs = found.where("a is not null")
    if not crowded.isEmpty():
        sought = cut(b.join(crowded, "id"))
        refined = key_candidates(key_index(a, refined_place_keys), sought, refined_typed_keys)
        pairs = pairs.unionByName(refined)
        if whole:
            hot = cut(key_index(a, place_keys, common=None).join(index.where("id is null").select("key"), "key", "left_semi").select("id", "key"))
            pairs = pairs.unionByName(link_levels(with_nodes(key_candidates(hot, sought, typed_address_keys), a, sought)).select("a", "b"))
        pairs = pairs.distinct()
    return with_nodes(pairs, a, b)


def with_nodes(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of ids with node and typed_node, the texts of the two sides (columns id, node)."""
    return pairs.join(a.withColumnRenamed("id", "a"), "a").join(b.select(F.col("id").alias("b"), F.col("node").alias("typed_node")), "b")


def link_levels(pairs: DataFrame) -> DataFrame:
    """a, b, building and the five levels, from the region down, of the pairs of nodes that are the same building."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for a, b, node, typed in zip(frame["a"], frame["b"], frame["node"], frame["typed_node"], strict=True):
                place = addresses.place_from(node)
                address = addresses.address_from(typed)
                levels = addresses.link_levels(place, address)
                if addresses.same_building(levels):
                    out.append((a, b, f"{place.region}|{place.locality}|{place.street}|{place.number}", addresses.region_level(place, address), *levels))
            if out:
                yield pd.DataFrame(out, columns=["a", "b", "building", "region", "locality", "code", "street", "number"])

    return pairs.mapInPandas(run, "a long, b long, building string, region int, locality int, code int, street int, number int")


def same_places(source: DataFrame, typed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of place nodes and typed address nodes (a, b: their hashes) with their levels and n_places, and the members of both sides.

    n_places is the number of different buildings that fit a typed address best; more than one: it is ambiguous.
    """
    a, b = cut(read_places(source)), cut(read_addresses(typed))
    linked = link_levels(address_candidates(a, b, whole=True))
    fit = F.col("street") * 1000 + F.col("code") * 100 + F.col("locality") * 10 + F.col("region")
    by_typed = Window.partitionBy("b")
    best = linked.withColumn("fit", fit).withColumn("best", F.max("fit").over(by_typed)).where("fit = best")
    return best.withColumn("n_places", F.size(F.collect_set("building").over(by_typed))).drop("fit", "best", "building"), a, b


def link_addresses(source: DataFrame, typed: DataFrame) -> DataFrame:
    """All pairs of records whose addresses denote one building: source1_entity_id, typed_entity_id, the levels and n_places; distinct rows.

    Null addresses and those that don't tell a building are in no pair. An ambiguous address is paired with each building that fits
    it best, and n_places says so. Repeated rows give no repeated pair; an empty side gives an empty result; columns other than
    entity_id and business_address aren't read.
    """
    links, a, b = same_places(source, typed)
    left = links.join(a.select(F.xxhash64("node").alias("a"), F.col("entity_id").alias("source1_entity_id")), "a")
    right = b.select(F.xxhash64("node").alias("b"), F.col("entity_id").alias("typed_entity_id"))
    return left.join(right, "b").select("source1_entity_id", "typed_entity_id", "region", "locality", "code", "street", "number", "n_places").distinct()
