"""The language gate on odd texts, against its SQL."""

import duckdb
from pyspark.sql import functions as F

from plumbline.functions import language
from plumbline.plans import registry

ENGLISH = "the and of to in a is for with that on are as this by "
TEXTS = [
    None, "", " ", "   ", "\t", "\n \n", "\u00a0", ".", "123 456", "÷ × " * 20, ENGLISH, ENGLISH.upper(), "the " * 14, "der die und den das " * 3, "el la de que y " * 3, "été les des un " * 4,
    "Это русский текст о наградах " * 5, "これは日本語の文章です", "هذا نص عربي " * 5, "한국어 문장입니다 " * 6, ENGLISH + "Это русский текст о наградах", ENGLISH + "这是一篇中文博客文章内容示例", ENGLISH + "हिन्दी Ελληνικά " * 9,
    *(" ".join(["the"] * hits + ["xyz"] * (25 * hits - hits + more)) for hits in (1, 3, 7, 29) for more in (0, 1)),
]


def test_lang_gate_funnel_of_odd_texts(spark, tmp_path):
    """Null, blank and other-script texts, and shares just at and below the least one."""
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(registry.oracle_sql()["lang_gate_funnel"]).fetchall()
    got = [(r["detected"], r["outcome"], r["n"]) for r in registry.queries()["lang_gate_funnel"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(n for _, _, n in got) == len(TEXTS)


def test_gate(spark):
    """The gate itself tells empty texts apart, and scripts are still detected."""
    df = spark.createDataFrame([(None,), (" ",), (ENGLISH,), ("Это русский текст",)], "t string")
    found = df.select(language.detected_language(F.col("t")).alias("l"), "t").select("l", language.gate(F.col("t"), F.col("l")).alias("o"))
    assert [tuple(r) for r in found.collect()] == [("und", "skipped_empty"), ("und", "skipped_empty"), ("en", "kept"), ("cyrillic", "skipped_non_english")]
