"""The features of candidate pairs, and their labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.config import FEATURES
from weft.functions import similarity as sim
from weft.functions import text


def pair_features(candidates: DataFrame) -> DataFrame:
    """query_id, target_source, target_id, country and all features, in order, of candidate pairs with their texts (blocking.TEXTS).

    Words and forms are made again from the normalised texts, which costs less than a join. Empty names give 0 where a ratio has no value.
    """
    both = candidates
    for side in "qt":
        name, address = F.col(f"{side}_name"), F.col(f"{side}_address")
        both = both.withColumns({
            f"{side}_name_norm": name, f"{side}_address_norm": address, f"{side}_core_name": text.without_legal(name), f"{side}_name_tokens": text.tokens(name),
            f"{side}_address_tokens": text.tokens(address), f"{side}_digit_tokens": text.digits(F.concat_ws(" ", name, address)),
        })
    both = both.withColumn("jaccard", sim.byte_jaccards(*(F.col(f"{side}_{c}") for c in ("name", "address") for side in "qt")))

    def sides(column: str) -> tuple[Column, Column]:
        return F.col(f"q_{column}"), F.col(f"t_{column}")

    def flag(condition: Column) -> Column:
        return condition.cast("int")

    def ratio(column: str) -> Column:
        a, b = (F.length(c) for c in sides(column))
        return F.least(a, b) / F.greatest(F.lit(1), a, b)

    name, core, address = sides("name_norm"), sides("core_name"), sides("address_norm")
    no_address = (address[0] == "") | (address[1] == "")
    made = {
        "name_exact": flag(name[0] == name[1]),
        "core_name_exact": flag((core[0] != "") & (core[0] == core[1])),
        "address_exact": flag((address[0] != "") & (address[0] == address[1])),
        "core_name_jaro": sim.jaro_winkler(*core),
        "name_levenshtein": sim.levenshtein_ratio(*name),
        "core_name_levenshtein": sim.levenshtein_ratio(*core),
        "address_levenshtein": F.when(no_address, 0.0).otherwise(sim.levenshtein_ratio(*address)),
        "name_char_jaccard": F.col("jaccard")["first"],
        "address_char_jaccard": F.col("jaccard")["second"],
        "name_token_jaccard": sim.set_jaccard(*sides("name_tokens")),
        "address_token_jaccard": sim.set_jaccard(*sides("address_tokens")),
        "name_token_overlap": sim.overlap(*sides("name_tokens")),
        "address_token_overlap": sim.overlap(*sides("address_tokens")),
        "digit_overlap": sim.overlap(*sides("digit_tokens")),
        "digit_jaccard": sim.set_jaccard(*sides("digit_tokens")),
        "name_length_ratio": ratio("name_norm"),
        "address_length_ratio": ratio("address_norm"),
        "target_address_missing": flag(address[1] == ""),
    }
    whole = both.withColumns(made).withColumns({"max_field_jaro": F.greatest("name_jaro", "core_name_jaro", "address_jaro"), "joint_jaro": F.col("name_jaro") + F.col("address_jaro")})
    return whole.select("query_id", "target_source", "target_id", "country", *FEATURES)


def truth_pairs(truth: DataFrame) -> DataFrame:
    """source1_entity_id, target_id: one row for each link of the lists, blanks around ids taken off, none for empty items; distinct, so labels can't fan out."""
    items = truth.select(F.trim("source1_entity_id").alias("source1_entity_id"), F.explode(F.split(F.coalesce("matched_entity_ids", F.lit("")), ",")).alias("x"))
    return items.select("source1_entity_id", F.trim("x").alias("target_id")).where("target_id <> ''").distinct()


def labelled(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """The features with label, 1 for a pair of the truth and 0 for others."""
    marks = pairs.select(F.col("source1_entity_id").alias("query_id"), "target_id", F.lit(1).alias("label"))
    return features.join(marks.hint("merge"), ["query_id", "target_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def bucket(entity_id: Column) -> Column:
    """A bucket from 0 to 99 from the digest of an id; the same in any engine."""
    return F.conv(F.substring(F.md5(entity_id), 1, 8), 16, 10).cast("long") % 100


SPLITS = ("train", "validation", "sample")


def split_queries(queries: DataFrame, train_percent: int, validation_percent: int, split: str = "sample") -> DataFrame:
    """The queries of a split with their part, train or validation, by the bucket of their id. sample is both; another split is a ValueError."""
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}; there are {', '.join(SPLITS)}")
    b = bucket(F.col("entity_id"))
    part = F.when(b < train_percent, "train").when(b < train_percent + validation_percent, "validation")
    return queries.withColumn("split", part).where("split is not null" if split == "sample" else F.col("split") == split)
