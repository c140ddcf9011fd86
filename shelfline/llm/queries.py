"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import (
    alignment, decontaminate, exact_dedup, html_text, lm_score, mixing, near_dedup, phrases, quality, sharding, tokens, topk,
    toxicity,
)

#: Bytes of text in a shard.
SHARD_BYTES = 16 << 20


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"), SHARD_BYTES)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest(exact_dedup.cut(_table(spark, sf_dir, "documents")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(_table(spark, sf_dir, "documents"), tokenizer_file(), by_words=True)


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(
        _table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_sharding": op2_sharding,
    "op3_html_text": op3_html_text,
    "op4_lm_score": op4_lm_score,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_tokens": op10_tokens,
    "op11_topk": op11_topk,
    "op12_phrases": op12_phrases,
    "op13_alignment": op13_alignment,
}
