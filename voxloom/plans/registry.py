"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import fixtures
from voxloom.config import MERGE, PACK, Settings
from voxloom.functions import arrays, durations, names
from voxloom.operators import batches, intervals, quality, resume, split, transcripts, transfer, verify

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _joined(array):
    """Arrays as text, so that any engine's rows compare."""
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


# intervals


@query
def segment_merge(spark, sf_dir):
    return intervals.merge_gaps(fixtures.intervals(spark, sf_dir), MERGE.merge_gap)


@query
def segment_split(spark, sf_dir):
    return intervals.segments_of(fixtures.intervals(spark, sf_dir), MERGE)


@query
def segment_pack_greedy(spark, sf_dir):
    return intervals.pack_greedy(fixtures.intervals(spark, sf_dir), PACK.pack_duration)


@query
def segment_pack_split(spark, sf_dir):
    packed = intervals.pack_greedy(fixtures.intervals(spark, sf_dir), PACK.pack_duration)
    return intervals.numbered(intervals.split_long(packed, PACK.most_duration, PACK.split_target))


@query
def segment_pack_final(spark, sf_dir):
    return intervals.segments_of(fixtures.intervals(spark, sf_dir), PACK)


@query
def segment_stats(spark, sf_dir):
    return intervals.segment_statistics(intervals.segments_of(fixtures.intervals(spark, sf_dir), PACK))


def _offsets(spark, sf_dir, settings: Settings) -> DataFrame:
    rows = fixtures.intervals(spark, sf_dir)
    return intervals.slice_offsets(intervals.segments_of(rows, settings), fixtures.recording_lengths(rows, settings.sample_rate), settings)


@query
def segment_slice_offsets(spark, sf_dir):
    return _offsets(spark, sf_dir, MERGE)


@query
def segment_slice_offsets_pack(spark, sf_dir):
    return _offsets(spark, sf_dir, PACK)


@query
def total_frames(spark, sf_dir):
    rows = _offsets(spark, sf_dir, MERGE)
    n = F.col("end_sample") - F.col("start_sample")
    return rows.select("segment_id", durations.total_frames(n, MERGE.sample_rate, MERGE.frame_rate).alias("frames"))


@query
def sliced_samples(spark, sf_dir):
    """Slices of made-up waveforms, the token ids, by the operator: all but two samples at either end, as far as there are any."""
    rows = fixtures.samples(spark, sf_dir)
    waves = rows.select(F.col("segment_id").alias("recording_id"), F.col("token_ids").alias("samples"))
    start = F.least(F.lit(2), F.size("token_ids"))
    offsets = rows.select(
        "segment_id", F.col("segment_id").alias("recording_id"), start.alias("start_sample"), F.greatest(start, F.size("token_ids") - 2).alias("end_sample")
    )
    return intervals.sliced(offsets, waves).select("segment_id", _joined("samples").alias("samples"))


# arrays


@query
def frame_gaps(spark, sf_dir):
    rows = quality.with_gaps(fixtures.samples(spark, sf_dir))
    return rows.select("segment_id", _joined("f_before").alias("f_before"), _joined("f_after").alias("f_after"))


@query
def position_diffs(spark, sf_dir):
    rows = fixtures.samples(spark, sf_dir)
    p = F.col("positions")
    large = F.coalesce(arrays.largest_step(p) > MERGE.most_position_gap, F.lit(False))
    return rows.select("segment_id", _joined(arrays.steps(p)).alias("steps"), F.coalesce(arrays.largest_step(p), F.lit(-1).cast("bigint")).alias("largest"), large.alias("is_large"))


@query
def run_length_flag(spark, sf_dir):
    rows = fixtures.samples(spark, sf_dir)
    return rows.select("segment_id", arrays.has_run(F.col("positions"), MERGE.most_equal_positions).alias("has_run"))


@query
def trimmed_tokens(spark, sf_dir):
    rows = fixtures.samples(spark, sf_dir)
    length = F.when(F.col("vec_id") % 7 != 0, F.floor(F.size("token_ids") / 2))
    return rows.select("segment_id", F.size(arrays.trimmed(F.col("token_ids"), length)).cast("bigint").alias("n_tokens"))


@query
def token_batches(spark, sf_dir):
    rows = batches.padded_batches(fixtures.samples(spark, sf_dir), "token_ids", F.lit(0).cast("bigint"), 3)
    return rows.select("segment_id", "batch", "length", "longest", _joined("token_ids").alias("token_ids"))


@query
def padded_waveforms(spark, sf_dir):
    rows = batches.padded_batches(fixtures.samples(spark, sf_dir), "positions", F.lit(0).cast("bigint"), MERGE.batch_size)
    return rows.select("segment_id", "batch", F.size("positions").cast("bigint").alias("n_padded"), "length")


@query
def channel_mean(spark, sf_dir):
    halves = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    mean = arrays.channel_mean(F.transform(halves, lambda h: F.transform(h, lambda x: F.round(x.cast("double") * 1000).cast("bigint"))))
    rows = fixtures.table(spark, sf_dir, "embeddings").where("size(embedding) = 64")
    return rows.select("vec_id", _joined(F.transform(mean, lambda x: (x * 2).cast("bigint"))).alias("doubled_mean"))


@query
def snake_activation(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "embeddings")
    out = arrays.snake(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.5))
    return rows.select("vec_id", F.round(F.element_at(out, 1), 6).alias("first"), F.round(F.element_at(out, -1), 6).alias("last"))


# quality and manifest


def _judged(spark, sf_dir, settings: Settings = MERGE) -> DataFrame:
    return quality.judged(fixtures.samples(spark, sf_dir), settings)


@query
def quality_reason_merge(spark, sf_dir):
    return _judged(spark, sf_dir, MERGE).select("segment_id", "reason")


@query
def quality_reason_pack(spark, sf_dir):
    return _judged(spark, sf_dir, PACK).select("segment_id", "reason")


@query
def manifest(spark, sf_dir):
    return split.with_recordings(quality.manifest(_judged(spark, sf_dir), MERGE))


@query
def rejection_stats(spark, sf_dir):
    return quality.rejection_counts(_judged(spark, sf_dir))


@query
def manifest_totals(spark, sf_dir):
    return quality.manifest_totals(quality.manifest(_judged(spark, sf_dir), MERGE), MERGE)


@query
def transcripts_nonempty(spark, sf_dir):
    rows = transcripts.non_empty(fixtures.transcripts(spark, sf_dir))
    return rows.select(names.segment_id(F.col("recording_id"), F.col("idx"), 4).alias("segment_id"), "recording_id", "idx", "text")


@query
def segments_with_text(spark, sf_dir):
    rows = fixtures.transcripts(spark, sf_dir)
    return transcripts.attached(rows.select("recording_id", "idx"), rows, ["recording_id", "idx"])


# resume and transfer


@query
def name_parts(spark, sf_dir):
    rows = fixtures.remote_objects(spark, sf_dir).withColumn("name", names.basename(F.col("key")))
    rows = rows.select("key", "name", names.stem(F.col("name")).alias("stem"), names.recording_of_file(F.col("name")).alias("recording_id"))
    back = names.segment_id(F.col("recording_id"), F.length("key") * 100, 4)
    return rows.select("*", back.alias("segment_id"), names.recording_of_segment(back).alias("of_segment"), names.is_feature_name(F.col("stem")).alias("is_public"))


@query
def listed_recordings(spark, sf_dir):
    rows = fixtures.remote_objects(spark, sf_dir).select(names.basename(F.col("key")).alias("name"), "size")
    return rows.where(F.col("name").endswith(".mp3")).orderBy("name")


@query
def resume_todo(spark, sf_dir):
    files = fixtures.remote_objects(spark, sf_dir).select(names.basename(F.col("key")).alias("name"))
    return resume.to_process(files, fixtures.done_markers(spark, sf_dir))


@query
def done_totals(spark, sf_dir):
    return resume.done_totals(fixtures.done_markers(spark, sf_dir))


@query
def file_collisions(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "documents").select(F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".mp3")).alias("name"))
    return resume.collisions(rows)


@query
def stale_partials(spark, sf_dir):
    rows = fixtures.samples(spark, sf_dir)
    todo = rows.where("vec_id % 5 = 0").select("recording_id")
    return resume.stale_segments(rows.select("segment_id"), todo)


@query
def done_after_run(spark, sf_dir):
    rows = fixtures.intervals(spark, sf_dir)
    done = resume.done_rows(rows, intervals.segments_of(rows, PACK))
    return done.select(F.col("recording_id").cast("string").alias("recording_id"), "n_segments", "status")


@query
def download_plan(spark, sf_dir):
    return transfer.download_plan(fixtures.remote_objects(spark, sf_dir), fixtures.local_files(spark, sf_dir))


@query
def download_summary(spark, sf_dir):
    return transfer.download_summary(fixtures.remote_objects(spark, sf_dir), fixtures.local_files(spark, sf_dir))


@query
def transfer_counts(spark, sf_dir):
    status = F.when(F.col("doc_id") % 10 == 0, "error").when(F.col("doc_id") % 3 == 0, "skip").otherwise("ok")
    return transfer.outcome_counts(fixtures.table(spark, sf_dir, "documents").select(status.alias("status")))


def _upload_candidates(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    accepted = _judged(spark, sf_dir).where("reason is null")
    existing = accepted.where("vec_id % 6 <> 0").select(
        F.concat(F.lit("features/"), "segment_id", F.lit(".pt")).alias("local"), F.col("duration_frames").alias("size")
    )
    files = quality.manifest_totals(quality.manifest(accepted, MERGE), MERGE).select(
        F.explode(F.array(*map(F.lit, (*transfer.MANIFESTS, "notes.txt")))).alias("local"), F.col("n_segments").alias("local_size")
    )
    return transfer.upload_candidates(files, quality.manifest(accepted, MERGE), existing, MERGE), fixtures.remote_features(accepted)


@query
def upload_candidates(spark, sf_dir):
    return _upload_candidates(spark, sf_dir)[0]


@query
def upload_plan(spark, sf_dir):
    return transfer.upload_plan(*_upload_candidates(spark, sf_dir))


@query
def human_duration(spark, sf_dir):
    rows = fixtures.intervals(spark, sf_dir).groupBy("recording_id").agg(F.max("e").alias("e"))
    return rows.select("recording_id", durations.human(F.col("e") * 37.0).alias("took"))


@query
def time_left(spark, sf_dir):
    done = (F.col("doc_id") % 100) / 100.0
    rows = fixtures.table(spark, sf_dir, "documents").withColumn("left_s", durations.remaining(F.col("n_chars").cast("double"), done))
    return rows.select("doc_id", F.round("left_s", 6).alias("left_s"))


# split and verification


def _manifest(spark, sf_dir) -> DataFrame:
    return quality.manifest(_judged(spark, sf_dir), MERGE)


def _assigned(spark, sf_dir) -> DataFrame:
    entries = _manifest(spark, sf_dir)
    return split.assigned(entries, split.by_hash(split.with_recordings(entries), MERGE))


@query
def split_hash(spark, sf_dir):
    return split.by_hash(split.with_recordings(_manifest(spark, sf_dir)), MERGE)


@query
def split_exact(spark, sf_dir):
    return split.by_shuffle(split.with_recordings(_manifest(spark, sf_dir)), MERGE)


@query
def split_summary(spark, sf_dir):
    return split.summary(_assigned(spark, sf_dir), MERGE)


@query
def split_disjoint(spark, sf_dir):
    return split.overlap(_assigned(spark, sf_dir))


@query
def verify_sample(spark, sf_dir):
    return verify.sample(_assigned(spark, sf_dir), MERGE).select("split", "segment_id")


def _checks(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    entries = _assigned(spark, sf_dir)
    features = fixtures.with_features(quality.with_gaps(fixtures.samples(spark, sf_dir)), MERGE.feature_width)
    return verify.checked(entries, features.where("vec_id % 17 <> 0"), MERGE), entries


@query
def verify_keys_shapes(spark, sf_dir):
    rows, _ = _checks(spark, sf_dir)
    return rows.select("split", "segment_id", "found", F.array_join("missing", ",").alias("missing"), "shaped", "passed")


@query
def verify_results(spark, sf_dir):
    return verify.results(*_checks(spark, sf_dir))


@query
def verify_overall(spark, sf_dir):
    return verify.overall(verify.results(*_checks(spark, sf_dir)))


@query
def incomplete_samples(spark, sf_dir):
    rows = fixtures.with_features(fixtures.samples(spark, sf_dir), 4).withColumn("positions", F.when(F.col("vec_id") % 3 != 0, F.col("positions")))
    rows = quality.incomplete(rows, ("token_ids", "encoder_features", "positions"))
    return rows.select("segment_id", F.array_join("missing", ",").alias("missing"))
