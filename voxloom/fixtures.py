"""Input relations derived from the test tables, as FIXTURES.md defines them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: F1, as FIXTURES.md states it.
INTERVALS = """
with a as (
  select user_id rec,
         cast(row_number() over(partition by user_id order by ts,event_id)-1 as bigint) seq,
         200+cast(round(value*400) as bigint) dur_ms,
         (event_id*7919)%1500 gap_ms
  from events),
b as (
  select *, cast(sum(dur_ms+gap_ms) over(partition by rec order by seq) as bigint) end_ms from a)
select rec, seq,
       (end_ms-dur_ms)/cast(1000 as double) s, end_ms/cast(1000 as double) e
from b
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recording_id, seq, s, e."""
    rows = spark.sql(INTERVALS.replace("from events", "from {events}"), events=table(spark, sf_dir, "events"))
    return rows.withColumnRenamed("rec", "recording_id")


def recording_lengths(intervals_: DataFrame, sample_rate: int) -> DataFrame:
    """Samples of each recording: a quarter of a second before its last interval ends."""
    end = (F.max("e") - 0.25) * float(sample_rate)
    return intervals_.groupBy("recording_id").agg(end.cast("bigint").alias("n_samples"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segment_id, recording_id, token_ids, positions, duration_frames, vec_id."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("vec_id") % 65).cast("int").alias("n"), "embedding")
    step = F.transform(
        F.slice("embedding", F.lit(1), F.col("n")),
        lambda x: (F.abs(x.cast("double")) * 50.0 * (F.col("label") + 1)).cast("bigint"),
    )
    running = F.reduce(
        step,
        F.array().cast("array<bigint>"),
        lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)))),
    )
    # a filter on what is made of positions would be pushed below and repeat the fold; nothing is pushed through a generator
    rows = rows.select(F.inline(F.array(F.struct("vec_id", "label", "n", running.alias("positions")))))
    recording = F.floor(F.col("vec_id") / 8).cast("bigint")
    return rows.select(
        F.format_string("r%03d_%04d", recording, F.col("vec_id") % 8).alias("segment_id"),
        F.format_string("r%03d", recording).alias("recording_id"),
        F.when(F.col("n") > 0, F.sequence(F.lit(1).cast("bigint"), F.greatest(F.col("n"), F.lit(1)).cast("bigint")))
        .otherwise(F.array().cast("array<bigint>"))
        .alias("token_ids"),
        "positions",
        (F.coalesce(F.get("positions", F.size("positions") - 1), F.lit(0)) + 25).alias("duration_frames"),
        "vec_id",
    )


def with_features(rows: DataFrame, width: int) -> DataFrame:
    """F2 with encoder_features; every 11th row is one value too narrow, every 13th has none."""
    own = F.when(F.col("vec_id") % 11 == 0, width - 1).otherwise(width)
    features = F.transform("token_ids", lambda t: F.array_repeat(F.lit(0.0).cast("float"), own))
    return rows.withColumn("encoder_features", F.when(F.col("vec_id") % 13 != 0, features))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recording_id, idx, raw_text."""
    raw = F.when(F.col("turn") % 5 == 3, F.lit(" \t\n")).otherwise(F.concat(F.lit("  "), F.col("text"), F.lit(" \n")))
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("recording_id"), F.col("turn").alias("idx"), raw.alias("raw_text")
    )


def remote_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, size."""
    key = F.concat(F.lit("audio/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit("_"), "source", F.lit(".mp3"))
    return table(spark, sf_dir, "documents").select(key.alias("key"), F.col("n_chars").alias("size"))


def local_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, size."""
    rows = table(spark, sf_dir, "documents").where("doc_id % 3 <> 0")
    name = F.concat(F.col("doc_id").cast("string"), F.lit("_"), "source", F.lit(".mp3"))
    return rows.select(name.alias("name"), (F.col("n_chars") + F.when(F.col("doc_id") % 7 == 0, 1).otherwise(0)).alias("size"))


def done_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recording_id, n_segments."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("recording_id"), F.col("quality").cast("bigint").alias("n_segments"))


def remote_features(accepted: DataFrame) -> DataFrame:
    """key, size of accepted F2 rows."""
    rows = accepted.where("vec_id % 4 <> 0")
    key = F.concat(F.lit("processed/features/"), "segment_id", F.lit(".pt"))
    return rows.select(key.alias("key"), (F.col("duration_frames") + F.when(F.col("vec_id") % 9 == 0, 1).otherwise(0)).alias("size"))
