"""Files as a stream: each file once, by checksum, into the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gristmill.operators.store import append_new


def ingest_stream(spark: SparkSession, folder: str, store: str, checkpoint: str, pattern: str = "*.csv", source: str = "unknown") -> StreamingQuery:
    """Registers what has arrived in `folder` and ends. Content seen before, under any name, is not registered again, nor is a batch that is replayed."""

    def register(batch: DataFrame, _: int) -> None:
        files = batch.select(
            F.sha2("content", 256).alias("id"), F.col("path").alias("source_uri"), F.lit("csv").alias("file_type"), F.lit(source).alias("source_system"), F.sha2("content", 256).alias("checksum"), F.lit("received").alias("ingest_status"), F.col("modificationTime").cast("timestamp_ntz").alias("received_at")
        )
        append_new(files, store, "file_registry", "checksum")

    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", pattern).load(folder)
    return stream.writeStream.foreachBatch(register).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
