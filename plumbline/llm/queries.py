"""The ``opN_<name>`` queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.oracles import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``score`` in [0, 1]; predicted at 0.3; evidence of all maximal segments."""
    from plumbline.llm.toxicity import toxicity

    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("segments").cast("long").alias("n_segments"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives, reads them back, and takes every column from the records read; the archives are the result's files and stay."""
    from plumbline.llm.common import scratch, written
    from plumbline.llm.warc import read_archives, transactions, write_archives

    folder = scratch(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    records = written(read_archives(manifest, folder), "warc-records")
    return transactions(records).select(
        F.col("metadata.page_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.coalesce("response.digest", "response.declared").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.col("response.refers_page").alias("refers_to"),
    )


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.pieces import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op5_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.rans import read_token_files, token_folder, write_token_files

    folder = token_folder(spark)
    manifest, table_of = write_token_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 2, folder)
    return read_token_files(manifest, folder, table_of)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is a bad outcome if its html is missing or cut off before its end."""
    from plumbline.llm.urls import Rule, judged

    rules = [Rule("block", "com", "/en/"), Rule("allow", "example.com", "/en/7"), Rule("allow", "net", "/de/"), Rule("block", "example.net", "/de/8"), Rule("block", "org", "/es/")]
    bad = F.coalesce(~F.contains("html", F.lit("</html>")), F.lit(True))
    return judged(table(spark, sf_dir, "pages"), rules, bad).select("page_id", "host", "path", "rule", "verdict")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept from a posterior of 0.1: losing a clean document counts nine times keeping a poor one."""
    from plumbline.llm.quality import quality_posterior

    judged = quality_posterior(table(spark, sf_dir, "documents"), threshold=0.1)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.neighbours import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm.pii import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_rans_token_files": op5_rans_token_files,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_url_filters": op7_url_filters,
    "op8_quality_rules": op8_quality_rules,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_personal_data": op10_personal_data,
}
