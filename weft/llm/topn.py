"""The N best items of every group, however large a group is: two-stage salted ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: str, score: str, item: str, n: int, salts: int = 64) -> DataFrame:
    """The n rows of each group with the highest score, of equal scores the smaller item first; a column rank_in_group is added.

    Each group is hashed into `salts` subgroups by item; n are kept in each, then the survivors, at most n * salts of a group, are
    ranked. Groups with fewer than n rows are kept whole. A null score ranks last, a null item last among equals; a null group is a
    group. Rows that are equal in group, score and item count each; make them distinct first if that isn't wanted. An empty table
    gives an empty result. All columns are kept; columns named __salt or rank_in_group in the input are replaced.
    """

    def ranked(*by: str) -> Column:
        return F.row_number().over(Window.partitionBy(*by).orderBy(F.col(score).desc_nulls_last(), F.col(item).asc_nulls_last()))

    salted = df.withColumn("__salt", F.pmod(F.xxhash64(F.col(item)), F.lit(salts)))
    survivors = salted.withColumn("rank_in_group", ranked(group, "__salt")).where(F.col("rank_in_group") <= n).drop("__salt", "rank_in_group")
    return survivors.withColumn("rank_in_group", ranked(group)).where(F.col("rank_in_group") <= n)


def candidate_set(pairs: DataFrame) -> DataFrame:
    """query_rid, target_entity_id: the distinct candidates of each query, from comma-separated lists over one or several rows.

    Blanks around ids, empty items and repetitions are ignored; an empty or null list has no candidate; a query id that ends in
    no number gives none.
    """
    rid = F.expr("try_cast(regexp_extract(source1_entity_id, '([0-9]+)\\\\s*$', 1) as bigint)")
    items = pairs.select(rid.alias("query_rid"), F.explode(F.split(F.col("candidate_entity_ids"), ",")).alias("x"))
    ids = items.select("query_rid", F.regexp_replace("x", r"^\s+|\s+$", "").alias("target_entity_id"))
    return ids.where("query_rid is not null and target_entity_id <> ''").distinct()


def best_scores(predictions: DataFrame) -> DataFrame:
    """query_rid, target_entity_id, score: the highest score from 0 to 1 of each scored pair; nulls, NaN and other numbers are no scores."""
    valid = predictions.where("probability between 0 and 1 and not isnan(probability)")
    return valid.groupBy("query_rid", "target_entity_id").agg(F.max("probability").alias("score"))


def best_candidates(pairs: DataFrame, predictions: DataFrame, n: int = 5) -> DataFrame:
    """query_rid, target_entity_id, score, rank_in_group of the n best-scored candidates of each query.

    Both sides are reduced to one row for each pair and joined on the whole pair, so a query with a tenth of all rows is spread like
    any other; ranking is salted.
    """
    scored = best_scores(predictions).join(candidate_set(pairs), ["query_rid", "target_entity_id"])
    return top_n(scored, "query_rid", "score", "target_entity_id", n)
