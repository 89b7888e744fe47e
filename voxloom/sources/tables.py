"""Done markers, features and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import schemas
from voxloom.functions.names import basename, is_feature_name, stem


def done_markers(spark: SparkSession, path: str) -> DataFrame:
    """recording_id, n_segments of {recording}.done files with JSON; what doesn't parse counts as not done."""
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", "*.done").text(path)
    n = F.try_to_number(F.get_json_object("value", "$.n_segments"), F.lit("999999999999")).cast("bigint")
    rows = rows.select(stem(basename(F.col("_metadata.file_path"))).alias("recording_id"), n.alias("n_segments"))
    return rows.where("n_segments is not null")


def done_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DONE).parquet(path)


def features(spark: SparkSession, path: str) -> DataFrame:
    """Feature samples with `run` and `file`, where they lie below path; private ones (a leading underscore) aren't listed.

    Files that can't be read are left out; see `unreadable_files`.
    """
    rows = spark.read.schema(f"{schemas.FEATURES}, run string").option("ignoreCorruptFiles", "true").option("basePath", path).parquet(path)
    file = F.concat(F.lit("run="), F.element_at(F.split(F.col("_metadata.file_path"), "/run="), -1)).alias("file")
    return rows.select(*schemas.FEATURE_COLUMNS, "run", file).where(is_feature_name(F.col("segment_id")))


def committed(features_: DataFrame, done: DataFrame) -> DataFrame:
    """Samples of recordings that are done, of the run that did them; what broken runs have left isn't among them."""
    return features_.join(done.select("recording_id", "run"), ["recording_id", "run"], "left_semi")


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of the feature table that aren't readable parquet: they count as load errors.

    Only files without any row, one for each run at most beside the broken ones,
    are named on the driver and read again, since an empty table is no error.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    read = spark.read.schema(schemas.FEATURES).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").parquet(path)
    seen = read.select(F.col("_metadata.file_name").alias("name")).distinct()
    rest = listed.select("path", basename(F.col("path")).alias("name")).join(seen, "name", "left_anti")
    paths = [r["path"] for r in rest.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "name string")

    def broken(batches):
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            names = []
            for name, content in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                try:
                    pq.ParquetFile(io.BytesIO(content)).read()
                except Exception:  # whatever is wrong with it
                    names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    found = spark.read.format("binaryFile").load(paths)
    return found.select(basename(F.col("path")).alias("name"), "content").mapInArrow(broken, "name string")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest written as one JSON array."""
    return spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path)
