"""Segments and their transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import stripped


def non_empty(transcripts: DataFrame, text: str = "raw_text") -> DataFrame:
    """transcripts with `text` stripped; those that are empty then go."""
    return transcripts.withColumn("text", stripped(F.col(text))).where("text <> ''")


def attached(segments: DataFrame, transcripts: DataFrame, keys: list[str]) -> DataFrame:
    """segments with their texts by key; a segment whose text is missing or empty goes, and so never takes another's."""
    return segments.join(non_empty(transcripts).select(*keys, "text"), keys)
