"""The operators of this package as queries on the given tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafscore.llm import (
    alignment,
    block_dedup,
    bpe,
    chat,
    language_id,
    license_scan,
    norm_topk,
    order_minhash,
    suffix_dedup,
    token_files,
    toxicity,
    whitening,
    winnowing,
)
from leafscore.llm.store import table


def op1_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf, "documents"))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.language_report(table(spark, sf, "documents"))


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op4_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    return winnowing.winnowing_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op5_norm_topk(spark: SparkSession, sf: str) -> DataFrame:
    return norm_topk.top_products(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op6_block_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return block_dedup.block_report(table(spark, sf, "documents"))


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.token_report(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encoded(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op9_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.suffix_report(table(spark, sf, "documents"))


def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.alignment_report(table(spark, sf, "documents"), *paths)


def op12_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    return chat.chat_report(table(spark, sf, "conversations"))


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_order_minhash,
        op2_language_id,
        op3_toxicity,
        op4_winnowing,
        op5_norm_topk,
        op6_block_dedup,
        op7_token_files,
        op8_byte_bpe,
        op9_license_scan,
        op10_suffix_dedup,
        op11_token_alignment,
        op12_chat_format,
        op13_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op4_winnowing": winnowing.SQL,
    "op5_norm_topk": norm_topk.SQL,
    "op9_license_scan": license_scan.sql(),
    "op12_chat_format": chat.SQL,
}
