"""Checks of the finished sets: what is sampled, what holds, and whether all of it does."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.config import Settings
from voxloom.functions.arrays import has_shape, missing_keys
from voxloom.operators.split import overlap
from voxloom.schemas import REQUIRED_KEYS


class VerificationError(RuntimeError):
    pass


def sample(assigned_manifest: DataFrame, settings: Settings) -> DataFrame:
    """verify_rows entries of each split at most, by a seeded md5 of the id."""
    key = F.md5(F.concat(F.lit(f"{settings.verify_seed}:"), F.col("segment_id")).cast("binary"))
    nth = F.row_number().over(Window.partitionBy("split").orderBy(key, "segment_id"))
    return assigned_manifest.withColumn("nth", nth).where(F.col("nth") <= settings.verify_rows).drop("nth")


def checked(entries: DataFrame, features: DataFrame, settings: Settings) -> DataFrame:
    """split, segment_id, found, missing, shaped, passed of entries; of all of them, or of a sample."""
    names = [n for n in REQUIRED_KEYS if n in features.columns]
    seen = features.select("segment_id", *names, F.lit(True).alias("found"))
    rows = entries.select("split", "segment_id").join(seen, "segment_id", "left")
    shaped = F.coalesce(has_shape(F.col("encoder_features"), F.col("token_ids"), settings.feature_width), F.lit(False))
    rows = rows.select("split", "segment_id", F.coalesce("found", F.lit(False)).alias("found"), missing_keys(REQUIRED_KEYS).alias("missing"), shaped.alias("shaped"))
    return rows.withColumn("passed", F.col("found") & (F.size("missing") == 0) & F.col("shaped"))


def results(checks: DataFrame, assigned_manifest: DataFrame) -> DataFrame:
    """check, passed: a row for each split that has entries, and one for disjointness."""
    keys = checks.groupBy("split").agg(F.bool_and("passed").alias("passed"))
    keys = keys.select(F.concat("split", F.lit("_keys")).alias("check"), "passed")
    disjoint = overlap(assigned_manifest).agg((F.count("*") == 0).alias("passed")).select(F.lit("disjoint").alias("check"), "passed")
    return keys.unionByName(disjoint)


def overall(check_results: DataFrame) -> DataFrame:
    """passed: whether all checks hold, also if there is none."""
    return check_results.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"))


def require(check_results: DataFrame) -> None:
    """Raises if a check fails, for pipelines that must not go on."""
    failed = [r["check"] for r in check_results.where("not passed").collect()]
    if failed:
        raise VerificationError(", ".join(sorted(failed)))
