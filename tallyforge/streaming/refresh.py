"""New files of a landing folder into tables, once each; late and repeated rows are handled.

The batch operators recompute whole tables; these keep running totals instead, so that a
refresh costs what arrived since the last one. Exactly-once comes from the checkpoint and,
for the totals, from writing each micro-batch under its own number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def landing(spark: SparkSession, path: str, schema: StructType, files_at_once: int = 1000) -> DataFrame:
    """The landing folder as a stream of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def refresh_totals(stream: DataFrame, keys: list[str], value: str, out: str, checkpoint: str) -> StreamingQuery:
    """Adds partial sums of each micro-batch to ``out``, a folder a batch; a rerun replaces its own."""

    def keep(batch: DataFrame, number: int) -> None:
        part = batch.groupBy(*keys).agg(F.sum(value).alias("total"), F.count("*").alias("n"))
        part.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The totals of all batches so far."""
    return spark.read.parquet(out).groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def windowed_counts(stream: DataFrame, time: str, by: str, late: str = "2 days", width: str = "1 day") -> DataFrame:
    """Counts a window and value of ``by``; rows later than ``late`` are left out."""
    t = stream.withColumn(time, F.col(time).cast("timestamp"))
    return t.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def distinct_rows(stream: DataFrame, keys: list[str], time: str, late: str = "2 days") -> DataFrame:
    """Each row once, however often it lands within ``late``."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
