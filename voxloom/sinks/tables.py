"""Features, done rows and manifests."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from voxloom.schemas import FEATURE_COLUMNS


def write_features(samples: DataFrame, path: str, run: str) -> None:
    """Feature samples of one run, a folder of its own; done rows that name the run make them count."""
    samples.select(*FEATURE_COLUMNS).write.mode("overwrite").parquet(f"{path}/run={run}")


def append_done(done: DataFrame, path: str) -> None:
    """Done rows (recording_id, n_segments, status, run), written after the features they stand for."""
    done.write.mode("append").parquet(path)


def drop_stale_runs(spark: SparkSession, path: str, done: DataFrame) -> list[str]:
    """Deletes the folders of runs that no done row names, which broke before they were done; their names."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    found = {f.getPath().getName(): f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("run=")}
    told = {f"run={r['run']}" for r in done.select("run").distinct().collect()}
    for name in (stale := sorted(found.keys() - told)):
        store.delete(found[name], True)
    return stale


def write_manifest(entries: DataFrame, path: str) -> None:
    """The manifest as a table, replaced on each run."""
    entries.write.mode("overwrite").parquet(path)


def write_split(assigned_manifest: DataFrame, path: str) -> None:
    assigned_manifest.write.mode("overwrite").partitionBy("split").parquet(path)


def export_json(entries: DataFrame, path: str | Path, order: str = "segment_id") -> int:
    """The manifest as one indented JSON array on the driver's disk, row by row; how many entries it has."""
    n = 0
    with open(path, "w") as f:
        for n, row in enumerate(entries.orderBy(order).toLocalIterator(), 1):  # noqa: B007
            f.write(("[\n" if n == 1 else ",\n") + "  " + json.dumps(row.asDict(recursive=True), indent=2).replace("\n", "\n  "))
        f.write("\n]\n" if n else "[]\n")
    return n
