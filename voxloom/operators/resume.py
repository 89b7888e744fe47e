"""What is done, what is to do, and what a broken run has left behind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.names import recording_of_file, recording_of_segment


def to_process(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files (name) of recordings without a done row."""
    rows = files.withColumn("recording_id", recording_of_file(F.col("name")))
    return rows.join(done.select("recording_id").where("recording_id is not null"), "recording_id", "left_anti")


def collisions(files: DataFrame) -> DataFrame:
    """Recording ids that several files claim; only one of them would be processed."""
    rows = files.groupBy(recording_of_file(F.col("name")).alias("recording_id")).agg(F.count("*").alias("n_files"))
    return rows.where("n_files > 1")


def done_totals(done: DataFrame) -> DataFrame:
    return done.agg(F.count("*").alias("n_recordings"), F.coalesce(F.sum("n_segments"), F.lit(0)).alias("n_segments"))


def stale_segments(features: DataFrame, todo: DataFrame) -> DataFrame:
    """Feature rows of recordings that are to be processed again: an equi-join on the derived id, not a prefix match."""
    rows = features.withColumn("recording_id", recording_of_segment(F.col("segment_id")))
    return rows.join(todo.select("recording_id").distinct(), "recording_id", "left_semi")


def done_rows(recordings: DataFrame, segments: DataFrame, status: str = "ok") -> DataFrame:
    """recording_id, n_segments, status: a row for each recording, also for those that gave no segment."""
    counts = segments.groupBy("recording_id").agg(F.count("*").alias("n_segments"))
    rows = recordings.select("recording_id").distinct().join(counts, "recording_id", "left")
    return rows.select("recording_id", F.coalesce("n_segments", F.lit(0)).alias("n_segments"), F.lit(status).alias("status"))
