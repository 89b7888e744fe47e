"""From voice-activity intervals to segments.

Intervals have recording_id, seq, s and e and are ordered within a recording.
Everything stays partitioned by recording_id, so a whole chain of these
operators shuffles once. Null ends or starts make no sense here and are dropped
by `valid`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.config import Settings
from voxloom.functions.durations import sample_at, seconds_of_samples
from voxloom.functions.names import segment_id


def valid(intervals: DataFrame) -> DataFrame:
    return intervals.where("recording_id is not null and seq is not null and s is not null and e is not null")


def merge_gaps(intervals: DataFrame, gap: float) -> DataFrame:
    """Neighbours with less than `gap` between them become one, which ends where the last of them does."""
    by = Window.partitionBy("recording_id").orderBy("seq")
    begins = F.coalesce(F.col("s") - F.lag("e").over(by) >= gap, F.lit(True))
    islands = intervals.withColumn("island", F.sum(begins.cast("int")).over(by))
    return islands.groupBy("recording_id", "island").agg(F.min("seq").alias("seq"), F.min_by("s", "seq").alias("s"), F.max_by("e", "seq").alias("e")).drop("island")


def split_long(intervals: DataFrame, most: float, target: float, least: float | None = None) -> DataFrame:
    """Longer ones than `most` become equal parts of about `target`, with `part` for their order; shorter than `least` go."""
    dur = F.col("e") - F.col("s")
    parts = F.when(dur <= most, F.lit(1.0)).otherwise(F.greatest(F.lit(1.0), F.rint(dur / target)))
    cut = intervals.withColumn("n_parts", parts).withColumn("step", dur / F.col("n_parts"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("n_parts").cast("int") - 1)).alias("part"))
    whole = F.col("n_parts") == 1
    long = dur > most
    start = F.when(whole & ~long, F.col("s")).otherwise(F.col("s") + F.col("part") * F.col("step"))
    end = F.when(whole & ~long, F.col("e")).otherwise(F.col("s") + (F.col("part") + 1) * F.col("step"))
    out = cut.select("recording_id", "seq", "part", start.alias("s"), end.alias("e"))
    return out if least is None else out.where(F.col("e") - F.col("s") >= least)


def pack_greedy(intervals: DataFrame, most: float) -> DataFrame:
    """Neighbours join as long as they end within `most` of where their first one starts; that one is never checked.

    Each choice depends on the last, so no window expresses it: a fold over the
    sorted intervals of a recording collects where packs begin, in the JVM. A
    recording is bounded by its own length; nothing else is ever together.
    """
    rows = intervals.groupBy("recording_id").agg(F.sort_array(F.collect_list(F.struct("seq", "s", "e"))).alias("xs"))
    nothing = F.struct(F.lit(None).cast("double").alias("start"), F.array().cast("array<int>").alias("firsts"), F.lit(0).alias("n"))
    firsts = F.reduce(
        "xs",
        nothing,
        lambda acc, x: F.when(
            acc["start"].isNull() | (x["e"] - acc["start"] > most),
            F.struct(x["s"].alias("start"), F.concat(acc["firsts"], F.array(acc["n"])).alias("firsts"), (acc["n"] + 1).alias("n")),
        ).otherwise(F.struct(acc["start"].alias("start"), acc["firsts"].alias("firsts"), (acc["n"] + 1).alias("n"))),
        lambda acc: acc["firsts"],
    )
    at = rows.withColumn("firsts", firsts).select("recording_id", "xs", "firsts", F.posexplode("firsts").alias("k", "first"))
    after = F.coalesce(F.get("firsts", F.col("k") + 1), F.size("xs"))
    return at.select(
        "recording_id", F.col("k").cast("bigint").alias("seq"), F.get("xs", F.col("first"))["s"].alias("s"), F.get("xs", after - 1)["e"].alias("e")
    )


def absorb_runts(segments: DataFrame, least: float, most: float) -> DataFrame:
    """A segment below `least` extends the last full one if that stays within `most` of its start, else it goes.

    Runts before any full segment go too.
    """
    order = ["seq", "part"] if "part" in segments.columns else ["seq"]
    by = Window.partitionBy("recording_id").orderBy(*order)
    full = F.col("e") - F.col("s") >= least
    grouped = segments.withColumn("group", F.sum(full.cast("int")).over(by)).where("group > 0")
    own = Window.partitionBy("recording_id", "group").orderBy(*order)
    anchored = grouped.withColumn("anchor", F.first("s").over(own)).withColumn("full", full)
    kept = anchored.where(F.col("full") | (F.col("e") - F.col("anchor") <= most))
    place = F.struct(*order)
    merged = kept.groupBy("recording_id", "group").agg(F.min(place).alias("place"), F.first("anchor").alias("s"), F.max_by("e", place).alias("e"))
    return merged.where(F.col("e") - F.col("s") >= least).select("recording_id", F.col("group").cast("bigint").alias("seq"), "s", "e")


def numbered(segments: DataFrame) -> DataFrame:
    """idx from 0 within each recording, in order."""
    order = ["seq", "part"] if "part" in segments.columns else ["seq"]
    by = Window.partitionBy("recording_id").orderBy(*order)
    return segments.select("recording_id", (F.row_number().over(by) - 1).cast("bigint").alias("idx"), "s", "e")


def segments_of(intervals: DataFrame, settings: Settings) -> DataFrame:
    """recording_id, idx, s, e under the settings' policy."""
    rows = valid(intervals)
    if settings.policy == "merge":
        merged = merge_gaps(rows, settings.merge_gap)
        return numbered(split_long(merged, settings.most_duration, settings.split_target, settings.least_duration))
    packed = split_long(pack_greedy(rows, settings.pack_duration), settings.most_duration, settings.split_target)
    return numbered(absorb_runts(packed, settings.least_duration, settings.most_duration))


def segment_statistics(segments: DataFrame) -> DataFrame:
    """n, mean, least, most and sum of durations for each recording, added up in whole milliseconds."""
    ms = F.round((F.col("e") - F.col("s")) * 1000).cast("bigint")
    rows = segments.select("recording_id", ms.alias("ms")).groupBy("recording_id")
    return rows.agg(
        F.count("*").alias("n_segments"),
        (F.sum("ms") / F.count("*") / 1000.0).alias("mean_s"),
        (F.min("ms") / 1000.0).alias("min_s"),
        (F.max("ms") / 1000.0).alias("max_s"),
        (F.sum("ms") / 1000.0).alias("total_s"),
    )


def slice_offsets(segments: DataFrame, lengths: DataFrame, settings: Settings) -> DataFrame:
    """Where each segment lies in its recording's samples (lengths: recording_id, n_samples), and its id.

    Slices that truncation makes shorter than the least duration go; the others
    keep their idx.
    """
    rate = settings.sample_rate
    cut = segments.join(lengths, "recording_id").select(
        "recording_id", "idx", sample_at(F.col("s"), rate).alias("start_sample"), F.least(sample_at(F.col("e"), rate), F.col("n_samples")).alias("end_sample")
    )
    dur = seconds_of_samples(F.greatest(F.lit(0), F.col("end_sample") - F.col("start_sample")), rate)
    return (
        cut.withColumn("dur_s", dur)
        .where(F.col("dur_s") >= settings.least_duration)
        .select(segment_id(F.col("recording_id"), F.col("idx"), settings.index_digits).alias("segment_id"), "recording_id", "idx", "start_sample", "end_sample", "dur_s")
    )


def sliced(offsets: DataFrame, waveforms: DataFrame) -> DataFrame:
    """offsets with `samples`: the stretch of the recording's samples."""
    n = (F.col("end_sample") - F.col("start_sample")).cast("int")
    cut = F.slice("samples", (F.col("start_sample") + 1).cast("int"), n)
    return offsets.join(waveforms.select("recording_id", "samples"), "recording_id").withColumn("samples", cut)
