"""Delivered files: tab-separated, with a header, without quoting; short rows are filled with nulls."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weft.config import RECORD_COLUMNS

RECORD_SCHEMA = StructType([StructField(c, StringType()) for c in RECORD_COLUMNS])
TRUTH_SCHEMA = StructType([StructField(c, StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
OPTIONS = {"sep": "\t", "header": True, "quote": "", "encoding": "UTF-8"}


def read_records(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Records as text. Fields beyond the fourth are dropped; blank lines are skipped; limit: any so many rows."""
    records = spark.read.schema(RECORD_SCHEMA).csv(path, **OPTIONS)
    return records if limit is None else records.limit(limit)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Links as lists; a missing list is ''."""
    return spark.read.schema(TRUTH_SCHEMA).csv(path, **OPTIONS).withColumn("matched_entity_ids", F.coalesce("matched_entity_ids", F.lit("")))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id: the distinct trimmed values of a file's first column."""
    first = spark.read.schema(StructType([StructField("entity_id", StringType())])).csv(path, **OPTIONS)
    return first.select(F.trim("entity_id").alias("entity_id")).where("entity_id <> ''").distinct()


def require_files(paths: list[str]) -> None:
    """Raise FileNotFoundError that names all local paths that aren't there."""
    missing = [p for p in paths if "://" not in p and not Path(p).exists()]
    if missing:
        raise FileNotFoundError("missing input: " + ", ".join(missing))


def read_metrics(path: str) -> dict:
    """The metrics of an earlier run."""
    if not Path(path).exists():
        raise FileNotFoundError(f"no metrics of a training run at {path}")
    return json.loads(Path(path).read_text())


def write_metrics(path: str, metrics: dict) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(metrics, indent=2, sort_keys=True) + "\n")
