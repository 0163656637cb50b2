"""How many true pairs share what a blocking scheme could find them by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.operators.signatures import exact_signatures, pair_signatures

CAPS = (6, 8, 10, 12)


def char_ngrams(text: Column, n: int = 5) -> Column:
    """The different n-grams of a text; none of a shorter one."""
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(F.length(text) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def _sets(records: DataFrame, side: str) -> DataFrame:
    words = exact_signatures(records).groupBy("entity_id").agg(F.collect_set("signature").alias("words"))
    out = records.select("entity_id", (F.col("address_norm") == "").alias("no_address"), char_ngrams(F.concat_ws(" ", "name_norm", "address_norm")).alias("grams")).join(words, "entity_id", "left")
    for cap in CAPS:
        pairs = pair_signatures(records, cap).groupBy("entity_id").agg(F.collect_set("signature").alias(f"pairs_{cap}"))
        out = out.join(pairs, "entity_id", "left")
    return out.select(*[F.col(c).alias(f"{side}_{c}") for c in out.columns])


def blocking_survival(queries: DataFrame, targets: DataFrame, pairs: DataFrame) -> DataFrame:
    """By number of shared words of true pairs: pairs, missing_address, shared_ngram and hit_6 to hit_12, pairs that share a composite.

    Only records of true pairs are signed. A pair whose record isn't there is left out.
    """
    q = queries.join(pairs.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_semi")
    t = targets.join(pairs.select(F.col("target_id").alias("entity_id")), "entity_id", "left_semi")
    both = pairs.join(_sets(q, "q"), F.col("source1_entity_id") == F.col("q_entity_id")).join(_sets(t, "t"), F.col("target_id") == F.col("t_entity_id"))

    def shared(name: str) -> Column:
        empty = F.array().cast("array<string>")
        return F.size(F.array_intersect(F.coalesce(f"q_{name}", empty), F.coalesce(f"t_{name}", empty)))

    def count(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    return both.groupBy(shared("words").alias("shared_words")).agg(
        F.count("*").alias("pairs"), count(F.col("t_no_address"), "missing_address"), count(shared("grams") > 0, "shared_ngram"), *[count(shared(f"pairs_{cap}") > 0, f"hit_{cap}") for cap in CAPS]
    )
