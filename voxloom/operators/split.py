"""Train and validation sets that share no recording."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.config import Settings
from voxloom.functions.durations import hours_of_frames
from voxloom.functions.names import recording_of_segment

TRAIN, VAL = "train", "val"


def with_recordings(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("recording_id", recording_of_segment(F.col("segment_id")))


def by_hash(recordings: DataFrame, settings: Settings) -> DataFrame:
    """recording_id, pos, split: the first share of the recordings in order of a seeded md5.

    The order is ranked in ranges of the hash's leading digits, so no task sorts
    all recordings: sizes of the ranges before it plus a rank within its own.
    """
    key = F.md5(F.concat(F.lit(f"{settings.split_seed}:"), F.col("recording_id")).cast("binary"))
    keyed = recordings.select("recording_id").distinct().withColumn("h", key).withColumn("range", F.substring("h", 1, 3))
    sizes = keyed.groupBy("range").agg(F.count("*").alias("n"))
    starts = sizes.select(
        "range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total")
    )
    nth = F.row_number().over(Window.partitionBy("range").orderBy("h", "recording_id"))
    placed = keyed.withColumn("nth", nth).join(starts, "range").withColumn("pos", F.col("start") + F.col("nth") - 1)
    n_train = F.floor(F.col("total") * F.lit(settings.train_share))
    return placed.select("recording_id", "pos", F.when(F.col("pos") < n_train, TRAIN).otherwise(VAL).alias("split"))


def by_shuffle(recordings: DataFrame, settings: Settings) -> DataFrame:
    """recording_id, pos, split by CPython's seeded shuffle of the sorted ids: needs them, and nothing else, on the driver.

    For parity with earlier splits; `by_hash` has no such bound.
    """
    ids = sorted(r["recording_id"] for r in recordings.select("recording_id").distinct().collect())
    random.Random(settings.split_seed).shuffle(ids)
    n_train = int(len(ids) * settings.train_share)
    rows = [(x, i, TRAIN if i < n_train else VAL) for i, x in enumerate(ids)]
    return recordings.sparkSession.createDataFrame(rows, "recording_id string, pos bigint, split string")


def assigned(manifest: DataFrame, split: DataFrame) -> DataFrame:
    """The manifest with recording_id, pos and split."""
    return with_recordings(manifest).join(split, "recording_id")


def summary(assigned_manifest: DataFrame, settings: Settings) -> DataFrame:
    """hours, recordings and segments of each split."""
    rows = assigned_manifest.groupBy("split").agg(
        F.sum("duration_frames").alias("frames"), F.countDistinct("recording_id").alias("n_recordings"), F.count("*").alias("n_segments")
    )
    return rows.select("split", hours_of_frames(F.col("frames"), settings.frame_rate).alias("hours"), "n_recordings", "n_segments")


def shared_recordings(train: DataFrame, val: DataFrame) -> DataFrame:
    """Recordings that both sets have; none if the split is right."""
    return with_recordings(train).select("recording_id").intersect(with_recordings(val).select("recording_id"))


def overlap(assigned_manifest: DataFrame) -> DataFrame:
    """Recordings that are in both sets of one manifest; none if the split is right. One pass, unlike `shared_recordings`."""
    rows = with_recordings(assigned_manifest).groupBy("recording_id").agg(*[F.bool_or(F.col("split") == s).alias(s) for s in (TRAIN, VAL)])
    return rows.where(F.col(TRAIN) & F.col(VAL)).select("recording_id")
