"""One query for each operator of this package, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontamination import contamination
from .embedding_join import near_vectors
from .language_model import backoff_scores
from .mixing import mix
from .ngram_join import classes
from .oracles import ORACLE_SQL
from .quality import quality
from .sharding import assign
from .substring_dedup import without_repeats
from .token_grammar import token_ids
from .url_reputation import judge


def op1_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))


def op4_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).select("page_id", "host", "path", "rule", "verdict")


def op7_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op8_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_prefix_decontamination": op1_prefix_decontamination,
        "op2_virtual_slots": op2_virtual_slots,
        "op3_stupid_backoff": op3_stupid_backoff,
        "op4_repair_tokens": op4_repair_tokens,
        "op5_byte_network": op5_byte_network,
        "op6_host_reputation": op6_host_reputation,
        "op7_previous_factors": op7_previous_factors,
        "op8_chosen_path_join": op8_chosen_path_join,
        "op9_source_mix": op9_source_mix,
        "op10_multi_index": op10_multi_index,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
