"""Listings and contents of files in any store that Spark reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import schemas
from voxloom.functions.names import basename, recording_of_file
from voxloom.shipping import ship


def _binary(spark: SparkSession, path: str, pattern: str) -> DataFrame | None:
    """Files below path; null if there is no such folder."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """key, size of each file, in order of the key; contents aren't read. No rows if the folder doesn't exist."""
    found = _binary(spark, path, pattern)
    if found is None:
        return spark.createDataFrame([], schemas.LISTING)
    return found.select(F.col("path").alias("key"), F.col("length").alias("size")).orderBy("key")


def first_of_each(files: DataFrame) -> DataFrame:
    """recording_id, path: the first file, in order, of each recording that files (name, path) hold."""
    return files.groupBy(recording_of_file(F.col("name")).alias("recording_id")).agg(F.min("path").alias("path"))


def recordings(spark: SparkSession, path: str, pattern: str = "*.mp3") -> DataFrame:
    """recording_id, path, length, content of each recording."""
    found = _binary(spark, path, pattern)
    if found is None:
        return spark.createDataFrame([], schemas.RECORDING)
    return found.select(recording_of_file(basename(F.col("path"))).alias("recording_id"), "path", "length", "content")


def decoded(rows: DataFrame, decode: Callable[[bytes], tuple], sample_rate: int) -> DataFrame:
    """recording_id, samples, sample_rate, n_samples, error.

    decode gives (channels x samples, rate); several channels become their mean,
    another rate is resampled. What can't be decoded has an error and no samples.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from voxloom.functions.audio import mono, resampled

        for batch in batches:
            for row in batch.to_pylist():
                samples, n, error = None, 0, None
                try:
                    channels, rate = decode(row["content"])
                    x = np.asarray(resampled(mono(np.asarray(channels, np.float32)), rate, sample_rate), np.float32)
                    samples, n = x, len(x)
                except Exception as e:  # the row says so
                    error = f"{type(e).__name__}: {e}"
                kinds = [("recording_id", pa.string()), ("samples", pa.list_(pa.float32())), ("sample_rate", pa.int32()), ("n_samples", pa.int64()), ("error", pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, (_, t) in zip((row["recording_id"], samples, sample_rate, n, error), kinds, strict=True)],
                    [k for k, _ in kinds],
                )

    ship(rows.sparkSession)
    return rows.select("recording_id", "content").mapInArrow(run, schemas.WAVEFORM)
