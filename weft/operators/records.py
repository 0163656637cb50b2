"""Normalised records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.functions import text


def normalise_records(records: DataFrame) -> DataFrame:
    """Distinct records with name_norm, core_name, address_norm, name_tokens, address_tokens, digit_tokens and name_acronym.

    Nulls count as ''; country loses outer spaces and stays open and case-sensitive; records are known by entity_id.
    """
    raw = records.select("entity_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("business_name", "business_address")], F.trim(F.coalesce("country", F.lit(""))).alias("country")).distinct()
    norm = raw.withColumns({"name_norm": text.normalise(F.col("business_name")), "address_norm": text.normalise(F.col("business_address"))})
    split = norm.withColumns({
        "core_name": text.without_legal(F.col("name_norm")),
        "name_tokens": text.tokens(F.col("name_norm")),
        "address_tokens": text.tokens(F.col("address_norm")),
        "digit_tokens": text.digits(F.concat_ws(" ", "name_norm", "address_norm")),
    })
    return split.withColumn("name_acronym", F.array_join(F.transform("name_tokens", lambda t: F.substring(t, 1, 1)), ""))
