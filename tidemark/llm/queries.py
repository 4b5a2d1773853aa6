"""The registered queries of the operators, over the whole tables, each derived from its operator's output."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    contamination,
    factors,
    forest,
    language,
    lines,
    maxent,
    outliers,
    quotes,
    repair,
    simple8b,
    sql,
    substring,
    whitening,
)
from tidemark.session import materialize, work_path

Query = Callable[[SparkSession, str], DataFrame]


def on_workers(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it, unless they are told a path of their own."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return query(spark, sf_dir)
    return run


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def repeats_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "token-files")
    simple8b.write(documents(spark, sf_dir), folder, vocabulary("byte_bpe_50k.json"), end_id=0,
                   partitions=_partitions(spark))
    found = materialize(simple8b.digests(spark, folder), "token-digests")
    return simple8b.starts(found).select("doc_id", "start", "n_tokens", "ids_crc32")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("lang_spans").alias("n_spans"))


def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.join(documents(spark, sf_dir))


def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(documents(spark, sf_dir, "doc_id", "text", "lang", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def lines_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_repeated(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(documents(spark, sf_dir))


def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(repair.repair(repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return found.select("vec_id", "n", "deviation", "identity_error",
                        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "found")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("found.whitened").alias("whitened"),
        F.col("found.explained").alias("explained"), "identity_error")


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.classify(documents(spark, sf_dir, "doc_id", "text", "n_chars"),
                            spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")


def queries() -> dict[str, Query]:
    plain: dict[str, Query] = {
        "op1_language_model": language_model,
        "op2_lines_removed": lines_removed,
        "op3_repeats_removed": repeats_removed,
        "op4_quality": quality,
        "op5_token_files": token_files,
        "op6_quote_links": quote_links,
        "op7_contaminated": contaminated,
        "op8_byte_bpe": byte_bpe,
        "op9_languages": languages,
        "op10_similar_documents": similar_documents,
        "op11_repaired": repaired,
        "op12_whitened": whitened,
        "op13_classified": classified,
    }
    return {name: _ready(query) for name, query in plain.items()}


def oracle_sql() -> dict[str, str]:
    return {"op2_lines_removed": sql.LINES_REMOVED, "op7_contaminated": sql.CONTAMINATED}
