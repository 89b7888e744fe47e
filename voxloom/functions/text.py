"""Transcripts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(text: Column) -> Column:
    """Without white space, of any script, at either end; null gives an empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
