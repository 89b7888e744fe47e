"""Plans of copies between stores, and their execution with retries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.config import Settings
from voxloom.functions.durations import megabytes
from voxloom.functions.names import basename, recording_of_file
from voxloom.shipping import ship

MANIFESTS = ("manifest.json", "manifest_train.json", "manifest_val.json")


def download_plan(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Remote objects (key, size) that aren't here (name, size) with their size."""
    wanted = remote.withColumn("name", basename(F.col("key")))
    return wanted.join(local.select("name", "size"), ["name", "size"], "left_anti").select(
        "key", "size", "name", recording_of_file(F.col("name")).alias("recording_id")
    )


def download_summary(remote: DataFrame, local: DataFrame) -> DataFrame:
    """n_objects, total_mb and how many are copied and skipped."""
    todo = download_plan(remote, local).agg(F.count("*").alias("n_copy"))
    every = remote.agg(F.count("*").alias("n_objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    return every.crossJoin(todo).select("n_objects", megabytes(F.col("bytes")).alias("total_mb"), "n_copy", (F.col("n_objects") - F.col("n_copy")).alias("n_skip"))


def upload_candidates(manifests: DataFrame, manifest: DataFrame, existing: DataFrame, settings: Settings) -> DataFrame:
    """local, key, local_size: manifests (local, local_size) and features of the manifest, if they exist (local, size)."""
    prefix = settings.output_prefix
    here = existing.select(F.col("local"), F.col("size").alias("local_size"))
    files = manifests.where(F.col("local").isin(*MANIFESTS)).select("local", F.concat(F.lit(f"{prefix}/"), "local").alias("key"), "local_size")
    features = manifest.select(F.col("feature_path").alias("local")).distinct().join(here, "local")
    features = features.select("local", F.concat(F.lit(f"{prefix}/features/"), basename(F.col("local"))).alias("key"), "local_size")
    return files.unionByName(features)


def upload_plan(candidates: DataFrame, remote: DataFrame) -> DataFrame:
    """Candidates that the remote index (key, size) doesn't hold with their size."""
    known = remote.select("key", F.col("size").alias("local_size"))
    return candidates.join(known, ["key", "local_size"], "left_anti").select("local", "key", "local_size")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """n_ok, n_skip and n_error of transfers; errors count as errors."""
    return outcomes.agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("ok", "skip", "error")])


def execute(plan: DataFrame, copy: Callable[[dict], str | None], settings: Settings, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """key, status, attempts, error: each row of the plan copied by `copy`, with retries, on the executors.

    copy returns "skip" if there was nothing to do. Attempts wait 1 s, 2 s, ...
    between them. The plan runs as often as the result does: write it once.
    """
    attempts = settings.attempts

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                error = None
                for n in range(1, attempts + 1):
                    try:
                        status, error = copy(row) or "ok", None
                        break
                    except Exception as e:  # the outcome says so
                        status, error = "error", str(e)
                        if n < attempts:
                            pause(float(n))
                rows.append({"key": row["key"], "status": status, "attempts": n, "error": error})
            kinds = [("key", pa.string()), ("status", pa.string()), ("attempts", pa.int32()), ("error", pa.string())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    ship(plan.sparkSession)
    return plan.mapInArrow(run, "key string, status string, attempts int, error string")
