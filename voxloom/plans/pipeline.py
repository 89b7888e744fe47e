"""The whole run: downloads, recordings to features, manifest, split, checks and uploads, resumable by recording."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.config import Settings
from voxloom.functions.audio import decoder_for
from voxloom.functions.names import basename
from voxloom.operators import inference, intervals, quality, resume, split, transfer, verify
from voxloom.sinks import tables as sinks
from voxloom.sources import files
from voxloom.sources import tables as sources


@dataclass(frozen=True)
class Backends:
    """decode takes a file's bytes (None: what is installed for the pattern); the others load a model on an executor.

    normalise and tokeniser are the text steps before the encoder; without them
    it gets the texts as they are.
    """

    decode: Callable[[bytes], tuple] | None
    voice_activity: Callable[[], inference.VoiceActivity]
    transcriber: Callable[[], inference.Transcriber]
    encoder: Callable[[], inference.FeatureEncoder]
    normalise: Callable[[str], str] | None = None
    tokeniser: Callable[[], Callable[[str], list[int]]] | None = None


@dataclass(frozen=True)
class Store:
    """A remote store: its listing (key, size) below a prefix, and copies of one object.

    fetch gets a row of the download plan, put one of the upload plan; each may
    return "skip" if there was nothing to do.
    """

    listing: Callable[[SparkSession, str], DataFrame]
    fetch: Callable[[dict], str | None]
    put: Callable[[dict], str | None]


@dataclass(frozen=True)
class Report:
    rejections: DataFrame
    totals: DataFrame
    summary: DataFrame
    checks: DataFrame


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _transferred(spark: SparkSession, plan: DataFrame, copy: Callable[[dict], str | None], at: str, settings: Settings) -> DataFrame:
    """Outcomes of a plan, which is written before it runs, so that it runs once."""
    plan.write.mode("overwrite").parquet(f"{at}-plan")
    transfer.execute(spark.read.parquet(f"{at}-plan"), copy, settings).write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)


def download(spark: SparkSession, store: Store, prefix: str, raw: str, root: str, settings: Settings) -> DataFrame:
    """Copies what the raw folder doesn't hold with its size; counts of outcomes."""
    here = files.listing(spark, raw).select(basename(F.col("key")).alias("name"), "size")
    plan = transfer.download_plan(store.listing(spark, prefix), here)
    return transfer.outcome_counts(_transferred(spark, plan, store.fetch, f"{root}/_downloads", settings))


def upload(spark: SparkSession, store: Store, root: str, settings: Settings) -> DataFrame:
    """Copies the manifests and the feature files they name, unless the store has them with their size; counts of outcomes."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    full = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    here = files.listing(spark, root).select(F.substring("key", len(full) + 2, 1 << 20).alias("local"), "size")
    manifests = here.withColumnRenamed("size", "local_size")
    candidates = transfer.upload_candidates(manifests, spark.read.parquet(f"{root}/manifest"), here, settings)
    plan = transfer.upload_plan(candidates, store.listing(spark, settings.output_prefix))
    return transfer.outcome_counts(_transferred(spark, plan, store.put, f"{root}/_uploads", settings))


def process(spark: SparkSession, raw: str, root: str, settings: Settings, backends: Backends, pattern: str = "*.mp3") -> int:
    """Turns recordings that aren't done into features; how many were.

    Features of a run count once done rows name it, so what a run that breaks
    has written is never read, is deleted by the next one, and its recordings
    are done again. What is to do is planned on names alone; of several files of
    a recording the first counts. A file that can't be decoded is done with 0
    segments and its error as status.
    """
    decode = backends.decode or decoder_for(pattern)
    listed = files.listing(spark, raw, pattern).select(F.col("key").alias("path"), basename(F.col("key")).alias("name"))
    if exists(spark, f"{root}/done"):
        done = sources.done_table(spark, f"{root}/done")
        listed = resume.to_process(listed, done)
    else:
        done = spark.createDataFrame([], "run string")
    sinks.drop_stale_runs(spark, f"{root}/features", done)
    files.first_of_each(listed).write.mode("overwrite").parquet(f"{root}/_todo")
    todo = spark.read.parquet(f"{root}/_todo")
    n = todo.count()
    if not n:
        return 0
    rows = files.recordings(spark, raw, pattern).join(todo.select("path"), "path", "left_semi")
    waves = files.decoded(rows, decode, settings.sample_rate)
    waves.write.mode("overwrite").parquet(f"{root}/_waves")
    waves = spark.read.parquet(f"{root}/_waves")
    found = inference.voice_activity(waves, backends.voice_activity)
    segments = intervals.segments_of(found, settings)
    offsets = intervals.slice_offsets(segments, waves.select("recording_id", "n_samples"), settings)
    slices = intervals.sliced(offsets, waves.where("error is null"))
    texts = inference.transcribed(slices.select("segment_id", "recording_id", "samples"), backends.transcriber, settings)
    samples = quality.with_gaps(inference.encoded(texts, backends.encoder, settings, backends.normalise, backends.tokeniser))
    run_id = uuid.uuid4().hex
    sinks.write_features(samples, f"{root}/features", run_id)
    written = sources.features(spark, f"{root}/features").where(F.col("run") == run_id)
    done = resume.done_rows(waves, written)
    status = waves.select("recording_id", F.coalesce("error", F.lit("ok")).alias("status"))
    done = done.drop("status").join(status, "recording_id").select("recording_id", "n_segments", "status", F.lit(run_id).alias("run"))
    sinks.append_done(done, f"{root}/done")
    return n


def new_segments(spark: SparkSession, root: str, before: int) -> int:
    """Segments of all done rows beyond those there were before."""
    return done_segments(spark, root) - before


def done_segments(spark: SparkSession, root: str) -> int:
    """Segments of all done rows."""
    if not exists(spark, f"{root}/done"):
        return 0
    return resume.done_totals(sources.done_table(spark, f"{root}/done")).first()["n_segments"]


def finish(spark: SparkSession, root: str, settings: Settings, strict: bool = False) -> Report:
    """Manifest, statistics, split and checks of all features that are done; strict raises if a check fails.

    Feature files that can't be read count as load errors in the statistics.
    """
    features = sources.committed(sources.features(spark, f"{root}/features"), sources.done_table(spark, f"{root}/done"))
    judged = quality.judged(features, settings)
    sinks.write_manifest(quality.manifest(judged, settings), f"{root}/manifest")
    entries = spark.read.parquet(f"{root}/manifest")
    assigned = split.assigned(entries, split.by_hash(split.with_recordings(entries), settings))
    sinks.write_split(assigned, f"{root}/splits")
    assigned = spark.read.parquet(f"{root}/splits")
    checks = verify.results(verify.checked(assigned, features, settings), assigned)
    if strict:
        verify.require(checks)
    rejections = quality.rejection_counts(quality.with_unreadable(judged, sources.unreadable_files(spark, f"{root}/features")))
    return Report(rejections, quality.manifest_totals(entries, settings), split.summary(assigned, settings), checks)


def run(
    spark: SparkSession,
    raw: str,
    root: str,
    settings: Settings,
    backends: Backends,
    pattern: str = "*.mp3",
    strict: bool = False,
    store: Store | None = None,
    prefix: str = "",
) -> Report:
    """All steps; with a store, recordings come from below prefix and manifests and features go back to it.

    The JSON manifests that are uploaded lie in root, which is a folder of the driver's disk then.
    """
    if store:
        download(spark, store, prefix, raw, root, settings)
    process(spark, raw, root, settings, backends, pattern)
    report = finish(spark, root, settings, strict)
    if store:
        assigned = spark.read.parquet(f"{root}/splits")
        entries = spark.read.parquet(f"{root}/manifest")
        for name, rows in zip(
            transfer.MANIFESTS,
            (entries, *(assigned.where(F.col("split") == s).select(*entries.columns) for s in (split.TRAIN, split.VAL))),
            strict=True,
        ):
            sinks.export_json(rows, f"{root}/{name}")
        upload(spark, store, root, settings)
    return report
