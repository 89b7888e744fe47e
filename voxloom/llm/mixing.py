"""Mixing sources to target weights.

Every document has a hash-random key. Within its source the keys are cut into
ranges by their leading digits, word counts are added up per range, and the sums
of the ranges before it plus the sum within its own range give each document its
place in the source's random order. The mix takes whole epochs first and then
the documents up to the exact word at which the source's budget ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"
#: Leading hex digits of the key that name a range.
RANGE_DIGITS = 3
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def random_key(seed: str = SEED):
    """Hex digits that depend on the seed, the id and the text alone, so reruns agree."""
    return F.substring(
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))).cast("binary")), 1, 16
    )


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source_key, source_size, target, from source_key, source, source_size: one row for each source.

    Sources in code point order, null last, take the weights in turn. Sources in
    order of the level at which they are full: one is full if its level is not
    above the one that all before it leave to the rest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    everything = Window.partitionBy()
    by_level = Window.orderBy("level", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    w = (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
        .withColumn("most", F.col("source_size").cast("double") * max_epochs)
        .withColumn("level", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double") * share)
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("full_before", F.coalesce(F.sum("most").over(by_level), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_level), F.lit(0.0)))
        .withColumn(
            "full", F.col("level") <= (F.col("total") - F.col("full_before")) / (F.col("weights") - F.col("weight_before"))
        )
    )
    rest = F.col("total") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    return w.select(
        "source_key",
        "source_size",
        F.when(F.col("full"), F.col("most")).otherwise(rest / F.nullif(open_weight, F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def source_key(source):
    """A key that no null has: the source behind an s, or null spelt out."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null"))


def _placed(docs: DataFrame, weights, share: float, max_epochs: int, seed: str) -> DataFrame:
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            random_key(seed).alias("random_key"),
        ),
        "mix",
    ).withColumns(
        {
            "source_key": source_key(F.col("source")),
            "key_range": F.substring("random_key", 1, RANGE_DIGITS),
        }
    )
    ranges = materialize(rows.groupBy("source_key", "source", "key_range").agg(F.sum("size").alias("words")), "mix-ranges")
    budget = targets(ranges.groupBy("source_key", "source").agg(F.sum("words").alias("source_size")), weights, share, max_epochs)
    before = (
        Window.partitionBy("source_key").orderBy("key_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = ranges.select(
        "source_key", "key_range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("range_start")
    ).join(budget, "source_key")
    own = (
        Window.partitionBy("source_key", "key_range")
        .orderBy("random_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("in_range", F.coalesce(F.sum("size").over(own), F.lit(0))).join(starts, ["source_key", "key_range"])
    limit = F.floor(F.col("target") + 0.5)
    epochs = F.coalesce(F.floor(limit / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    return placed.select(
        "source_key",
        "doc_id",
        "size",
        "source_size",
        "target",
        "random_key",
        epochs.alias("epochs"),
        (limit - epochs * F.col("source_size")).alias("last_words"),
        (F.col("range_start") + F.col("in_range")).alias("words_before"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, random_key, words_before: a row for each row of docs.

    A null text has no words, null is a source of its own, repeated rows are
    documents of their own, an empty table gives no rows. Documents of one key
    are ordered by id and size. Other columns of docs are not looked at.
    """
    in_last = F.least(F.col("size"), F.col("last_words") - F.col("words_before"))
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), in_last)
    return _placed(docs, weights, share, max_epochs, seed).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "random_key", "words_before"
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of docs.

    Here the budget ends between documents: the one that it would cut is taken
    if at least half of its words are within it. The cut is one key for each
    source, so the documents themselves are neither moved nor joined by id.
    Repeated rows have one key and share its fate.
    """
    placed = _placed(docs, weights, share, max_epochs, seed)
    within = (F.col("last_words") > 0) & (F.col("words_before") + F.col("size") / 2 <= F.col("last_words"))
    cuts = materialize(
        placed.groupBy("source_key").agg(
            F.max("epochs").alias("_epochs"), F.max(F.when(within, F.col("random_key"))).alias("_cut")
        ),
        "mix-cuts",
    )
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        source_key(F.col("source")).alias("source_key"),
        random_key(seed).alias("_key"),
    ).join(cuts, "source_key")
    copies = F.col("_epochs") + F.coalesce((F.col("_key") <= F.col("_cut")).cast("int"), F.lit(0))
    some = keyed.select("_row", copies.cast("int").alias("_copies")).where("_copies > 0")
    return some.select("_row", F.explode(F.sequence(F.lit(1), "_copies")).alias("_copy")).select("_row.*")
