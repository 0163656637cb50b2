"""Candidate retrieval: an inverted index over signatures, weighted by rarity within country and source, and two-stage top-k.

Targets of all sources go through one plan; target_source is part of every key, so frequencies stay per source. Weights are whole
millionths, so sums don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.config import KIND_WEIGHTS, PAIR_WEIGHT, LinkConfig
from weft.functions.similarity import jaro_winkler
from weft.operators import postings
from weft.operators.signatures import all_signatures, pair_signatures, single_signatures, triple_signatures

INDEX_KEY = ["target_source", "country", "kind", "signature"]


def document_frequencies(signatures: DataFrame) -> DataFrame:
    """target_source, country, kind, signature and document_frequency of signatures."""
    return signatures.groupBy(*INDEX_KEY).agg(F.count("*").cast("int").alias("document_frequency"))


def _kind_weight() -> Column:
    weight = F.when(F.lit(False), F.lit(0.0))
    for kind, value in KIND_WEIGHTS.items():
        weight = weight.when(F.col("kind") == kind, F.lit(value))
    return weight


def hot_pairs(targets: DataFrame, config: LinkConfig = LinkConfig()) -> DataFrame:
    """target_source, country, signature of the composite signatures that more targets have than config.max_pair_frequency."""
    often = pair_signatures(targets, config.longest_tokens).groupBy("target_source", "country", "signature").agg(F.count("*").alias("n"))
    return often.where(F.col("n") > config.max_pair_frequency).drop("n") if config.max_pair_frequency is not None else often.drop("n").limit(0)


def weighted_index(targets: DataFrame, config: LinkConfig = LinkConfig(), hot: DataFrame | None = None) -> DataFrame:
    """Postings that are rare enough, with document_frequency (1 for composite ones) and weight_micro.

    targets: normalised records with target_source. hot: composite signatures that are refined by third words, by default those of
    the config.
    """
    per_country = targets.groupBy("target_source", "country").agg(F.count("*").alias("country_count"))
    single = single_signatures(targets)
    frequencies = document_frequencies(single)
    rare = frequencies.where(
        (F.col("kind").isin("ne", "ae") & (F.col("document_frequency") <= config.max_token_frequency))
        | (F.col("kind").isin("ns", "as") & (F.col("document_frequency") <= config.max_shape_frequency))
    ).join(per_country, ["target_source", "country"])
    weight = F.ln((F.col("country_count") + 1.0) / (F.col("document_frequency") + 0.5)) * _kind_weight()
    weights = rare.select(*INDEX_KEY, "document_frequency", F.round(weight * 1e6).cast("long").alias("weight_micro"))
    columns = ["target_source", "entity_id", "country", "kind", "signature", "document_frequency", "weight_micro"]
    singles = single.join(weights, INDEX_KEY)
    fixed = {"document_frequency": F.lit(1), "weight_micro": F.lit(int(PAIR_WEIGHT * 1e6)).cast("long")}
    pairs = pair_signatures(targets, config.longest_tokens)
    if config.max_pair_frequency is None:
        return singles.select(*columns).unionByName(pairs.withColumns(fixed).select(*columns))
    hot = hot_pairs(targets, config) if hot is None else hot
    pairs = pairs.join(hot, ["target_source", "country", "signature"], "left_anti")
    triples = triple_signatures(targets, hot, config.longest_tokens)
    common = triples.groupBy("target_source", "country", "signature").agg(F.count("*").alias("n")).where(F.col("n") > config.max_pair_frequency).drop("n")
    triples = triples.join(common, ["target_source", "country", "signature"], "left_anti")
    return singles.select(*columns).unionByName(pairs.unionByName(triples).withColumns(fixed).select(*columns))


def query_signatures(queries: DataFrame, hot: DataFrame, config: LinkConfig = LinkConfig()) -> DataFrame:
    """All signatures of the queries; those of pairs that are hot in a source of targets with third words too. With blank_country under '' as well."""
    if config.blank_country:
        queries = queries.withColumn("country", F.explode(F.array_distinct(F.array("country", F.lit("")))))
    return all_signatures(queries, config.longest_tokens).unionByName(triple_signatures(queries, hot, config.longest_tokens))


def raw_candidates(query_signatures: DataFrame, index: DataFrame) -> DataFrame:
    """query_id, target_source, target_id, score_micro, exact_hits, shape_hits of all pairs that share a posting.

    The index is joined on 64-bit hashes of its key; among n different keys about n * n / 2 ** 65 pairs of keys have one hash, which
    adds a wrong hit. The join is left to adaptive execution, which splits hot signatures.
    """
    key = F.xxhash64("country", "kind", "signature").alias("key")
    kind = F.col("kind").isin("ns", "as").cast("int").alias("is_shape")
    left = query_signatures.select(F.col("entity_id").alias("query_id"), key)
    right = index.select("target_source", F.col("entity_id").alias("target_id"), "weight_micro", kind, key)
    return left.join(right, "key").groupBy("query_id", "target_source", "target_id").agg(
        F.sum("weight_micro").alias("score_micro"),
        F.sum(1 - F.col("is_shape")).cast("int").alias("exact_hits"),
        F.sum("is_shape").cast("int").alias("shape_hits"),
    )


def retrieve_raw(queries: DataFrame, targets: DataFrame, config: LinkConfig = LinkConfig()) -> DataFrame:
    """The raw candidates of normalised queries among normalised targets with target_source: `raw_candidates` over `weighted_index`, by hashed postings."""
    return postings.retrieve_raw(queries, targets, config)


def retrieve(queries: DataFrame, targets: DataFrame, config: LinkConfig = LinkConfig(), texts: bool = False) -> DataFrame:
    """The final candidates. Both sides should be written tables, as they are read several times. texts: keep what features are made of."""

    def finish(found: DataFrame, asked: DataFrame, held: DataFrame) -> DataFrame:
        scored = _compared(_with_texts(found.where("contends").drop("contends"), asked, held))
        return final_candidates(scored, config, texts, "query")

    best = (config.prefilter_candidates, config.max_candidates_per_source, MOST_LIKENESS)
    return postings.by_chunks(queries, targets, config, best, finish)


def retrieve_shortlist(queries: DataFrame, targets: DataFrame, config: LinkConfig = LinkConfig()) -> DataFrame:
    """The shortlist of normalised queries among normalised targets, of each chunk of queries for itself."""
    return postings.by_chunks(queries, targets, config, (config.prefilter_candidates, config.max_candidates_per_source, MOST_LIKENESS))


def shortlist(raw: DataFrame, config: LinkConfig = LinkConfig()) -> DataFrame:
    """The best pairs of each query and source by score, exact hits and target id."""
    return contenders(raw, config).drop("contends")


#: Fixed value: more than likeness can add to the score of a pair in `final_candidates` (11, and what rounding may add), in millionths.
MOST_LIKENESS = 11_001_000


def contenders(raw: DataFrame, config: LinkConfig = LinkConfig()) -> DataFrame:
    """The shortlist with contends: whether a pair can be among the final ones, whatever its likeness.

    It can't if even full likeness leaves it behind the pair that is last of the final ones by score alone, as likeness takes nothing away.
    """
    order = Window.partitionBy("query_id", "target_source").orderBy(F.desc("score_micro"), F.desc("exact_hits"), "target_id")
    short = raw.withColumn("pre_rank", F.row_number().over(order)).where(F.col("pre_rank") <= config.prefilter_candidates).drop("pre_rank")
    last = F.nth_value("score_micro", config.max_candidates_per_source).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return short.withColumn("contends", F.coalesce(F.col("score_micro") + MOST_LIKENESS >= last, F.lit(True)))


#: What the features are made of, so that candidates need no second join with their records.
TEXTS = ["country", "q_name", "q_address", "t_name", "t_address"]


def rescored(short: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The shortlist with name_jaro, address_jaro (0 if either address is empty) and the texts they come from.

    Queries are joined last, so the ranking that follows finds the rows of a query together.
    """
    q = queries.select(F.col("entity_id").alias("query_id"), "country", F.col("name_norm").alias("q_name"), F.col("address_norm").alias("q_address"))
    t = targets.select("target_source", F.col("entity_id").alias("target_id"), F.col("name_norm").alias("t_name"), F.col("address_norm").alias("t_address"))
    return _compared(short.join(t.hint("merge"), ["target_source", "target_id"]).join(q.hint("merge"), "query_id"))


def _with_texts(found: DataFrame, asked: DataFrame, held: DataFrame) -> DataFrame:
    """The ids and texts of pairs that are known by numbers; the number of the query stays."""
    q = asked.where("own").select(F.col("number").alias("query"), F.col("entity_id").alias("query_id"), "country", F.col("name_norm").alias("q_name"), F.col("address_norm").alias("q_address"))
    t = held.select(F.col("number").alias("target"), "target_source", F.col("entity_id").alias("target_id"), F.col("name_norm").alias("t_name"), F.col("address_norm").alias("t_address"))
    return found.hint("merge").join(t.hint("merge"), "target").join(q.hint("merge"), "query")


def _compared(both: DataFrame) -> DataFrame:
    address = F.when((F.col("q_address") == "") | (F.col("t_address") == ""), 0.0).otherwise(jaro_winkler(F.col("q_address"), F.col("t_address")))
    return both.withColumns({"name_jaro": jaro_winkler(F.col("q_name"), F.col("t_name")), "address_jaro": address})


def final_candidates(scored: DataFrame, config: LinkConfig = LinkConfig(), texts: bool = False, query: str = "query_id") -> DataFrame:
    """The best pairs of each query and source by block score and likeness, with block_score and candidate_rank; with their texts if wanted. query: what queries are told apart by."""
    block = F.col("score_micro") / 1e6
    rank_score = F.round(block + 7.0 * F.greatest("name_jaro", "address_jaro") + 2.0 * (F.col("name_jaro") + F.col("address_jaro")), 6)
    order = Window.partitionBy(query, "target_source").orderBy(F.desc("rank_score"), F.desc("exact_hits"), "target_id")
    ranked = scored.withColumn("rank_score", rank_score).withColumn("candidate_rank", F.row_number().over(order))
    columns = ["query_id", "target_source", "target_id", block.alias("block_score"), "exact_hits", "shape_hits", "candidate_rank", "name_jaro", "address_jaro"]
    return ranked.where(F.col("candidate_rank") <= config.max_candidates_per_source).select(*columns, *(TEXTS if texts else []))


def blocking_stats(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: queries, candidates, queries_with_candidates, average_candidates (0 without queries)."""
    asked = queries.select(F.lit(1).alias("q"), F.lit(None).cast("string").alias("query_id"))
    both = asked.unionByName(candidates.select(F.lit(0).alias("q"), "query_id"))
    counted = both.agg(F.count(F.when(F.col("q") == 1, 1)).alias("queries"), F.count(F.when(F.col("q") == 0, 1)).alias("candidates"), F.countDistinct("query_id").alias("queries_with_candidates"))
    average = F.when(F.col("queries") == 0, 0.0).otherwise(F.col("candidates") / F.col("queries"))
    return counted.withColumn("average_candidates", average)
