"""From raw documents to token counts: five stages, each written as Parquet and read again by the next.

    corpus_pipeline.run(spark, folder)

``folder`` holds ``documents.parquet`` and ``benchmark.parquet``. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, contamination, forest, language, lines
from tidemark.llm.queries import on_workers, vocabulary
from tidemark.session import file_count, materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, no letter) go; ``lang`` becomes the predicted language of the rest."""
    on_workers(spark)
    found = language.identify(docs.select(*COLUMNS))
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go; documents stay, shorter, unless no line is left."""
    return lines.remove_repeated(docs).where("n_removed = 0 OR n_removed < n_lines").select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates stays: that of the smallest id, rows with a null id last.

    Rows are known by a hash of id and text, so that each of several texts of one id, and each text without an id, is in a
    class; of rows equal in both one stays."""
    on_workers(spark)
    rows = docs.withColumn("__row", contamination.row_key("doc_id", "text"))
    files = file_count(spark, 32 * docs.count())    # four longs a row
    ids = materialize(rows.groupBy("__row", "doc_id").agg(F.count(F.lit(1)).alias("times")), "row-ids", files)
    classes = forest.join(rows.select("__row", "text"), "__row").select("__row", "class_id").distinct()
    members = materialize(classes.join(ids, "__row"), "class-members", files)
    stays = members.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("first")).select(
        F.col("first.__row").alias("__row"))
    dropped = members.join(stays, "__row", "left_anti").select("__row")
    kept = rows.join(dropped, "__row", "left_anti")
    repeated = ids.where("times > 1").select("__row")
    once = kept.join(repeated, "__row", "left_semi").groupBy("__row").agg(F.min(F.struct(*COLUMNS)).alias("own"))
    return kept.join(repeated, "__row", "left_anti").select(*COLUMNS).unionByName(once.select("own.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = contamination.find(docs, items, "doc_id").where("hits IS NOT NULL").select("row")
    rows = docs.withColumn("__row", contamination.row_key("doc_id", "text"))
    return rows.join(hits.withColumnRenamed("row", "__row"), "__row", "left_anti").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text by the rank file, with the digests of the ids and of the decoded bytes."""
    on_workers(spark)
    coded = bpe.round_trip(docs.select("doc_id", "text", "lang", "source"), vocabulary("byte_bpe_50k.tiktoken"),
                           keep=("lang", "source"))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language", identify_language),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte-level BPE", tokenize),
]

#: Language ID is learned and tokens are encoded by a library, so no SQL says the same; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
