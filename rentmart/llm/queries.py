"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentmart.llm.oracles import SQL


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pack_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.packing import pack

    pieces = pack(_documents(spark, sf_dir), tokenizer_path())
    return pieces.drop("ids")


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.common import fresh_path
    from rentmart.llm.records import documents_from_records, write_records

    path = write_records(_documents(spark, sf_dir), fresh_path(spark, "records"), tokenizer_path())
    return documents_from_records(spark, path)


def op5_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.fingerprints import fingerprints

    return fingerprints(_documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.lines import dedup_lines

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.mixing import mix

    return mix(_documents(spark, sf_dir))


def op2_path_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.urltree import judge

    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.langid import fit, identify

    docs = _documents(spark, sf_dir)
    return identify(docs.select("doc_id", "text"), fit(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.vectors import near_vectors

    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.nearcopies import near_copies

    return near_copies(_documents(spark, sf_dir), size=4)


def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.repeats import remove_repeats

    return remove_repeats(_documents(spark, sf_dir)).drop("text")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.secretscan import secrets

    return secrets(_documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.spelling import spelling_variants

    return spelling_variants(_documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rentmart.llm.prefixtrie import prefix_trie

    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


_ALL = (
    op1_pack_curve, op2_path_tree, op3_language_id, op4_near_vectors, op5_scaled_fingerprints, op6_line_dedup,
    op7_bottom_k, op8_mix_sources, op9_recompression, op10_token_records,
    op11_secret_scan, op12_spelling_variants, op13_prefix_trie,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE: dict[str, str] = dict(SQL)
