"""Names of files, recordings and segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(key: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(key, "/", -1)


def stem(name: Column) -> Column:
    """The name without its last suffix; a leading dot doesn't begin one."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def recording_of_file(name: Column) -> Column:
    """What precedes the first underscore, or the whole name."""
    return F.substring_index(name, "_", 1)


def recording_of_segment(segment_id: Column) -> Column:
    """What precedes the last underscore."""
    return F.regexp_replace(segment_id, r"_[^_]*$", "")


def segment_id(recording_id: Column, idx: Column, digits: int) -> Column:
    """The index is padded to the digits, never cut to them."""
    return F.format_string(f"%s_%0{digits}d", recording_id.cast("string"), idx)


def is_public(name: Column) -> Column:
    return ~name.startswith("_")


def is_feature_name(name: Column) -> Column:
    """Neither private nor a done marker."""
    return is_public(name) & ~name.endswith(".done")
