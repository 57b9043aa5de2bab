"""The corpus pipeline: language ID, line dedup, near-duplicate documents, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, fresh_path, let_go, stored
from rentmart.llm.langid import UNKNOWN, fit, identify
from rentmart.llm.lines import NO_ID, dedup_lines
from rentmart.llm.mixing import mixed_documents
from rentmart.llm.nearcopies import near_copies
from rentmart.llm.packing import pack
from rentmart.llm.queries import tokenizer_path

#: a document whose language is less sure than this is rejected
LEAST_SCORE = 0.4
#: packing, the last stage, cannot be written as SQL
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with a score of ``LEAST_SCORE`` or more."""
    found = identify(docs, fit(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with repeated lines left in the first one only; n_chars follows the text."""
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8 or more): of the smallest doc_id, null
    first. Rows that share a doc_id, or have none, are judged each by their own text."""
    let_go(spark)       # the files of the stages before
    # the number of a row is fixed by the stored table, so a lost executor cannot change it
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = near_copies(rows.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text"), F.col("_row").alias("row"))
    kept = rows.select("_row", order.alias("_order")).join(found, "_row").groupBy("component_id").agg(F.min("_order").alias("_first"))
    kept = cut_lineage(kept.select(F.col("_first.row").alias("_row")))
    del found
    let_go(spark)
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a document taken n times stands n times."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece of a document."""
    return pack(docs, tokenizer_path()).drop("ids")


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near_duplicates), ("mixing", mixture), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
