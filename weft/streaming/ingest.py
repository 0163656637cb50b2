"""Continuous ingestion of delivered files: each new file is normalised and signed, and its rows appended as Parquet.

The batch operators hold for streams unchanged, for they are narrow: nothing is aggregated before the index is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weft.operators.signatures import all_signatures
from weft.operators.records import normalise_records
from weft.sources.tsv import OPTIONS, RECORD_SCHEMA


def ingest(spark: SparkSession, folder: str, out: str, state: str) -> StreamingQuery:
    """Start a query that handles all files there are and ends. It writes out/records and out/signatures, by batch, and is exact after a restart.

    A batch that is run again replaces its own folder, so a lost executor or driver leaves no row twice.
    """

    def handle(batch: DataFrame, number: int) -> None:
        records = normalise_records(batch)
        for name, frame in (("records", records), ("signatures", all_signatures(records))):
            frame.withColumn("loaded", F.current_timestamp()).write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    stream = spark.readStream.schema(RECORD_SCHEMA).csv(folder, **OPTIONS)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", state).trigger(availableNow=True).start()
