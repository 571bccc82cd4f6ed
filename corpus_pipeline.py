"""A pipeline that makes training sequences of the table documents.

Stages, in order: quality rules and language ID (documents that they reject go), the n-gram Jaccard join (of each group of near duplicates the document of the least id stays), secret scans (secrets are masked in the texts), and packing (a row for each piece of a document). Each stage works on all that the one before kept; its result is written as Parquet and read again for the next.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliotab.llm import language_id, local_search_pack, ngram_join, quality_rules, secret_scan
from heliotab.llm.common import documents, materialised, written
from heliotab.llm.queries import tokenizer_path

#: A language is accepted from this probability on.
LEAST_SCORE = 0.3
#: Tokens a sequence.
CAPACITY = 4096


def keep_by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor a learned rule rejects."""
    rules = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = quality_rules.assess(docs.withColumn("_row", F.struct(*docs.columns)), rules, "_row")
    return found.where("kept").select("_row.*")


def keep_by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told, by a model of the labelled ones."""
    key = F.col("doc_id")
    model = language_id.fit(docs.where(~language_id.held_out(key)), key)
    found = language_id.predict(docs.withColumn("_row", F.struct(*docs.columns)), model, "_row")
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the least id (null ids last, then by a hash of the text); of rows that repeat it, one. Documents without words stay."""
    rows, _ = ngram_join.near_duplicates(docs)
    rows = materialised(rows.where("class IS NOT NULL").select("doc_id", "text_hash", "class"))
    best = rows.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best"))
    best = materialised(best.select(F.col("best.doc_id").alias("best_id"), F.col("best.text_hash").alias("best_hash")))  # equal texts are of one class
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    blank = F.length(F.translate(F.coalesce("row.text", F.lit("")), " \t\n\x0b\f\r", "")) == 0
    single = keyed.where(~blank).join(best, F.col("id").eqNullSafe(F.col("best_id")) & (F.col("hash") == F.col("best_hash")), "left_semi")
    if rows.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():  # repeated rows
        single = single.dropDuplicates(["id", "hash"])
    return single.unionByName(keyed.where(blank)).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked, and n_chars of the new texts."""
    out = secret_scan.redact(docs, tokenizer_path("byte_bpe_50k.tiktoken"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of CAPACITY tokens."""
    pieces = local_search_pack.pieces(docs, tokenizer_path("word_bpe_49k.json"), CAPACITY, "doc_id")
    return local_search_pack.pack(pieces, CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_by_quality_rules),
    ("language ID", keep_by_language),
    ("n-gram Jaccard join", keep_one_of_near_duplicates),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: Learned rules, a trained model and a tokenizer decide, so SQL can't express the pipeline; tests hold it against its stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table documents, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
