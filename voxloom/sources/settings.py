"""Secrets and store settings from an environment file."""

from __future__ import annotations

import os
from collections.abc import MutableMapping
from pathlib import Path

from pyspark.sql import SparkSession


def read_env(path: str | Path, into: MutableMapping[str, str] | None = None) -> dict[str, str]:
    """Sets NAME=value lines that aren't set yet; skips blanks, comments and lines without a name or value."""
    into = os.environ if into is None else into
    found: dict[str, str] = {}
    if Path(path).exists():
        for line in Path(path).read_text().splitlines():
            name, sign, value = (x.strip() for x in line.strip().partition("="))
            if sign and name and value and not name.startswith("#"):
                found[name] = value
                into.setdefault(name, value)
    return found


def use_object_store(spark: SparkSession, endpoint: str, access_key: str, secret_key: str, region: str = "auto") -> None:
    """Settings for s3a:// paths; its connections are pooled per executor."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name, value in (("endpoint", endpoint), ("access.key", access_key), ("secret.key", secret_key), ("endpoint.region", region)):
        conf.set(f"fs.s3a.{name}", value)
