"""Samples, frames and seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_of_samples(samples: Column, rate: int) -> Column:
    return samples.cast("double") / F.lit(float(rate))


def sample_at(seconds: Column, rate: int) -> Column:
    """Truncated, not rounded."""
    return (seconds * F.lit(float(rate))).cast("bigint")


def total_frames(samples: Column, rate: int, frame_rate: int) -> Column:
    """Divided before multiplied, in doubles, then truncated: 13,920 samples are 28 frames."""
    return (seconds_of_samples(samples, rate) * F.lit(float(frame_rate))).cast("bigint")


def seconds_of_frames(frames: Column, frame_rate: int) -> Column:
    return frames.cast("double") / F.lit(float(frame_rate))


def hours_of_frames(frames: Column, frame_rate: int) -> Column:
    return seconds_of_frames(frames, frame_rate) / F.lit(3600.0)


def megabytes(size: Column) -> Column:
    return size.cast("double") / F.lit(1048576.0)


def percentage(n: Column, total: Column) -> Column:
    """0 of nothing."""
    return F.when(total > 0, n.cast("double") / total.cast("double") * 100.0).otherwise(F.lit(0.0))


def human(seconds: Column) -> Column:
    """1h 2m 3s, 2m 3s or 3s of whole seconds."""
    whole = F.floor(seconds).cast("bigint")
    h, m, s = F.floor(whole / 3600).cast("bigint"), F.floor(whole % 3600 / 60).cast("bigint"), whole % 60
    return (
        F.when(h > 0, F.format_string("%dh %dm %ds", h, m, s))
        .when(m > 0, F.format_string("%dm %ds", m, s))
        .otherwise(F.format_string("%ds", s))
    )


def remaining(elapsed: Column, fraction: Column) -> Column:
    """Seconds left at a linear pace; null before anything is done."""
    return F.when(fraction > 0, elapsed / fraction - elapsed)
