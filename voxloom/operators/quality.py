"""Quality of feature samples, and the manifest of those that pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.config import Settings
from voxloom.functions.arrays import gaps_after, gaps_before, has_run, largest_step, missing_keys
from voxloom.functions.durations import hours_of_frames, percentage, seconds_of_frames

KEPT, UNREADABLE = "kept", "load_error"


def rejection(settings: Settings, positions: str = "positions", frames: str = "duration_frames") -> Column:
    """Why a sample is rejected, or null; the first reason that holds counts."""
    p, dur = F.col(positions), seconds_of_frames(F.col(frames), settings.frame_rate)
    return (
        F.when(F.size(p) == 0, "empty_tokens")
        .when(dur < settings.least_duration, "too_short")
        .when(dur > settings.most_duration, "too_long")
        .when(has_run(p, settings.most_equal_positions), "consecutive_frames")
        .when(largest_step(p) > settings.most_position_gap, "large_gap")
    )


def judged(samples: DataFrame, settings: Settings) -> DataFrame:
    """samples with `reason`: null for those that pass; one without positions or duration couldn't be read."""
    unreadable = F.col("positions").isNull() | F.col("duration_frames").isNull()
    return samples.withColumn("reason", F.when(unreadable, F.lit(UNREADABLE)).otherwise(rejection(settings)))


def with_gaps(samples: DataFrame) -> DataFrame:
    """samples with f_before and f_after."""
    return samples.withColumns(
        {"f_before": gaps_before(F.col("positions")), "f_after": gaps_after(F.col("positions"), F.col("duration_frames"))}
    )


def manifest(judged_samples: DataFrame, settings: Settings, root: str = "features") -> DataFrame:
    """A row for each sample that passes; feature_path is relative to the data root: the sample's `file`, or one of its own."""
    name = F.col("file") if "file" in judged_samples.columns else F.concat(F.col("segment_id"), F.lit(".pt"))
    return judged_samples.where("reason is null").select(
        "segment_id",
        F.lit(settings.dataset).alias("dataset"),
        F.size("token_ids").cast("bigint").alias("num_tokens"),
        "duration_frames",
        F.concat(F.lit(f"{root}/"), name).alias("feature_path"),
    )


def rejection_counts(judged_samples: DataFrame) -> DataFrame:
    """reason, n, pct and the total over all reasons, kept ones included, the most frequent first."""
    counts = judged_samples.groupBy(F.coalesce("reason", F.lit(KEPT)).alias("reason")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    rows = counts.withColumn("total", total).select("reason", "n", percentage(F.col("n"), F.col("total")).alias("pct"), "total")
    return rows.orderBy(F.desc("n"), "reason")


def with_unreadable(judged_samples: DataFrame, files: DataFrame) -> DataFrame:
    """The reasons of judged samples and one load error for each file that can't be read."""
    return judged_samples.select("reason").unionByName(files.select(F.lit(UNREADABLE).alias("reason")))


def manifest_totals(entries: DataFrame, settings: Settings) -> DataFrame:
    """n_segments, hours and tokens; zeros for an empty manifest."""
    frames = F.coalesce(F.sum("duration_frames"), F.lit(0))
    return entries.agg(
        F.count("*").alias("n_segments"),
        hours_of_frames(frames, settings.frame_rate).alias("hours"),
        F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("tokens"),
    )


def incomplete(samples: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """samples with `missing`: the names of required columns that are null."""
    return samples.withColumn("missing", missing_keys(names))
