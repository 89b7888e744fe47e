"""A corpus pipeline over documents: each stage is one operator, written and read again before the next.

In every stage null texts count as empty, rows are judged by what they hold, so
repeated rows without an own rule fare alike, an empty table gives no rows, and
columns of documents with any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm.common import shared_path, table, temporary
from voxloom.llm.decontamination import without_contaminated
from voxloom.llm.mixing import mixed_documents
from voxloom.llm.ngram_join import one_of_each
from voxloom.llm.quality import without_rejected
from voxloom.llm.sharding import with_shards


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network, trained on the labels of those not held out, doesn't reject; ids that are null have no label."""
    return without_rejected(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group of near copies; texts without words are copies of their own id and text only."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item, however long they are; empty ones stay."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents come as often as the mix takes them; null is a source of its own."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their virtual slot and shard, which replace columns of these names."""
    return with_shards(docs)


STAGES = [
    ("accept_quality", accept_quality),
    ("one_of_near_copies", one_of_near_copies),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: A trained network decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written beside its result is deleted once that is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"stage-{name}")
        with temporary(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
