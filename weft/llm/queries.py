"""The queries of this subpackage's operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import linkage, lookalike, matching, mojibake, packing, tokens, topn
from weft.operators.parsing import valid_source1, valid_source2
from weft.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _matches(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["entity_id", "business_name", "business_address"]
    source = valid_source1(table(spark, folder, "train_source1")).select(*columns)
    targets = valid_source2(table(spark, folder, "train_source2")).select(*columns).unionByName(table(spark, folder, "train_source3").select(*columns))
    return matching.match(source, targets)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    labelled = table(spark, folder, "train_matches").select(F.trim("source1_entity_id").alias("entity_id"))
    found = _matches(spark, folder).where("matched").join(labelled, "entity_id", "left_anti")
    return found.select(F.col("entity_id").alias("source1_entity_id"), F.col("target_id").alias("target_entity_id")).distinct()


def p1_confidence(spark: SparkSession, folder: str) -> DataFrame:
    return _matches(spark, folder).where("matched").select(F.col("entity_id").alias("source1_entity_id"), F.col("target_id").alias("target_entity_id"), "posterior").distinct()


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    best = topn.best_candidates(table(spark, folder, "candidate_pairs"), table(spark, folder, "test_predictions"))
    return best.select("query_rid", "target_entity_id")


def p2_ranked(spark: SparkSession, folder: str) -> DataFrame:
    best = topn.best_candidates(table(spark, folder, "candidate_pairs"), table(spark, folder, "test_predictions"))
    return best.select("query_rid", "target_entity_id", "score", F.col("rank_in_group").cast("long").alias("rank_in_group"))


def _plain_forms(spark: SparkSession, folder: str) -> DataFrame:
    names = (table(spark, folder, "train_source1"), "business_name", "train_source1")
    addresses = (table(spark, folder, "train_source2"), "business_address", "train_source2")
    return lookalike.plain_forms([names, addresses])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_forms(spark, folder).where("not looks_typed").select("entity_id").distinct()


def p4_forms(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_forms(spark, folder).select("source", "entity_id", "plain_form").distinct()


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    source, typed = valid_source1(table(spark, folder, "train_source1")), valid_source2(table(spark, folder, "train_source2"))
    pairs = linkage.link_addresses(source, typed).where("n_places = 1")
    return pairs.select("source1_entity_id", F.col("typed_entity_id").alias("source2_entity_id")).distinct()


def p5_levels(spark: SparkSession, folder: str) -> DataFrame:
    source, typed = valid_source1(table(spark, folder, "train_source1")), valid_source2(table(spark, folder, "train_source2"))
    return linkage.link_addresses(source, typed).withColumnRenamed("typed_entity_id", "source2_entity_id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    source, typed = valid_source1(table(spark, folder, "train_source1")), table(spark, folder, "train_source3")
    return linkage.link_names(source, typed).withColumnRenamed("typed_entity_id", "source3_entity_id")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, folder, "documents"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Containers of 1,024: every length costs the same, so the longest is opened; capacity says to what the ones with room are downsized."""
    return packing.pack_documents(table(spark, folder, "documents"), lengths=(256, 512, 1024), costs=(1, 1, 1))


def p9_variable_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), lengths=(256, 512, 1024))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return mojibake.find_garbled(table(spark, folder, "documents")).select("doc_id").distinct()


def p10_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return mojibake.find_garbled(table(spark, folder, "documents")).select("doc_id", "repaired", "restored")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_confidence, p2_found, p2_ranked, p4_found, p4_forms, p5_found, p5_levels, p6_found, p8_ids, p9_containers, p9_variable_lengths, p10_found, p10_repaired)}


BEST = """
with items as (
  select try_cast(regexp_extract(source1_entity_id, '([0-9]+)\\s*$', 1) as bigint) query_rid, trim(x, ' ') target_entity_id
  from (select source1_entity_id, unnest(string_split(candidate_entity_ids, ',')) x from candidate_pairs)),
cands as (select distinct query_rid, target_entity_id from items where target_entity_id <> '' and query_rid is not null),
scores as (select query_rid, target_entity_id, max(probability) score from test_predictions
  where probability >= 0 and probability <= 1 and not isnan(probability) group by all),
ranked as (select query_rid, target_entity_id, score,
  row_number() over (partition by query_rid order by score desc, target_entity_id) rank_in_group
  from scores join cands using (query_rid, target_entity_id))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": BEST + "select query_rid, target_entity_id from ranked where rank_in_group <= 5",
        "p2_ranked": BEST + "select query_rid, target_entity_id, score, rank_in_group from ranked where rank_in_group <= 5",
    }
