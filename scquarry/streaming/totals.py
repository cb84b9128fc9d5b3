"""An extension: running totals of cells from a stream of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry.model import COUNTS


def read_counts(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A stream of the Parquet files of a folder of counts."""
    return spark.readStream.schema(COUNTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def running_totals(counts: DataFrame) -> DataFrame:
    """ncount and nfeature of every cell so far; each entry of the matrix must come once."""
    return counts.groupBy("cell_id").agg(F.sum("value").alias("ncount"), F.count(F.when(F.col("value") > 0, 1)).alias("nfeature"))


def windowed_counts(events: DataFrame, at: str, key: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events and their sum per key and time window; rows later than the watermark are left out of closed windows."""
    w = events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").alias("start"), key, "n", "total")


def run_once(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> None:
    """Work off what is there into a table in memory."""
    df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
