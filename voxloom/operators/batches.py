"""Fixed-size batches of ordered segments, padded to their longest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.arrays import padded


def batched(segments: DataFrame, size: int) -> DataFrame:
    """segments with batch: 0, 1, ... within each recording, `size` segments each, by segment_id."""
    nth = F.row_number().over(Window.partitionBy("recording_id").orderBy("segment_id"))
    return segments.withColumn("batch", F.floor((nth - 1) / size).cast("bigint"))


def padded_batches(segments: DataFrame, values: str, filler, size: int) -> DataFrame:
    """batched segments with `length` and `values` filled up to the batch's longest."""
    rows = batched(segments, size).withColumn("length", F.size(values).cast("bigint"))
    longest = F.max("length").over(Window.partitionBy("recording_id", "batch"))
    return rows.withColumn("longest", longest).withColumn(values, padded(F.col(values), F.col("longest"), filler))
