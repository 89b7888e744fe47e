"""Segments of a growing folder of interval files, with the engine's checkpoint in place of done markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import schemas
from voxloom.config import Settings
from voxloom.operators.intervals import segments_of


def incoming(spark: SparkSession, path: str) -> DataFrame:
    """Interval files as a stream; a recording's intervals may come in several."""
    return spark.readStream.schema(schemas.INTERVAL).parquet(path)


def run_available(stream: DataFrame, out: str, checkpoint: str, settings: Settings) -> None:
    """Segments of what has come since the last call, a folder for each recording, replaced if a batch is run again.

    Each batch's intervals are kept below {out}_intervals, so a recording that
    goes on in a later batch is done again from all of its intervals.
    """
    kept = f"{out.rstrip('/')}_intervals"

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{kept}/batch={n}")
        every = batch.sparkSession.read.schema(schemas.INTERVAL).option("basePath", kept).parquet(kept)
        new = batch.sparkSession.read.schema(schemas.INTERVAL).parquet(f"{kept}/batch={n}").select("recording_id").distinct()
        rows = segments_of(every.join(new, "recording_id", "left_semi"), settings).withColumn("recording", F.col("recording_id"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("recording").parquet(out)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
