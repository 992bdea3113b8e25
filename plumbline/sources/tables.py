"""Sources: tables, raw archives, label corpora, sitemaps."""

from __future__ import annotations

import gzip
import json
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@F.pandas_udf(T.StringType())
def unzipped(data: pd.Series) -> pd.Series:
    """Text of gzip bytes, undecodable bytes replaced."""
    return data.map(lambda b: None if b is None else gzip.decompress(b).decode("utf-8", "replace"))


@F.pandas_udf(T.BinaryType())
def zipped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else gzip.compress(t.encode(), mtime=0))


def raw_pages(spark: SparkSession, path: str, page_type: str) -> DataFrame:
    """Archived pages of one type with their text."""
    return spark.read.parquet(path).where(F.col("page_type") == page_type).withColumn("html", unzipped("body"))


def label_corpus(spark: SparkSession, manifest: str) -> tuple[DataFrame, list[str]]:
    """Pairs of all files of a manifest, the first of each unordered pair, and the names of missing files.

    The manifest is JSON: ``components`` with a ``file`` each, in order of precedence. Pairs are put in
    code-point order; ``_component`` names the file they come from.
    """
    with open(manifest, encoding="utf-8") as f:
        files = [c["file"] for c in json.load(f)["components"]]
    base = os.path.dirname(os.path.abspath(manifest))
    missing = [n for n in files if not os.path.exists(os.path.join(base, n))]
    out = None
    for rank, name in enumerate(n for n in files if n not in missing):
        rows = spark.read.schema("key_a string, key_b string, label string").json(os.path.join(base, name))
        rows = rows.select(F.least("key_a", "key_b").alias("left_key"), F.greatest("key_a", "key_b").alias("right_key"), "label", F.lit(name).alias("_component"), F.lit(rank).alias("_rank"), F.monotonically_increasing_id().alias("_line"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], "left_key string, right_key string, label string, _component string"), missing
    first = F.row_number().over(Window.partitionBy("left_key", "right_key").orderBy("_rank", "_line"))
    return out.withColumn("_first", first).where("_first = 1").drop("_first", "_rank", "_line"), missing


def sitemap_locations(xml: DataFrame, column: str = "xml") -> DataFrame:
    """Locations of sitemaps: ``is_index`` tells whether they are further sitemaps."""
    place = F.expr(f"xpath(regexp_replace({column}, ' xmlns=\"[^\"]*\"', ''), '//loc/text()')")
    return xml.select(F.col(column).rlike(r"<sitemapindex").alias("is_index"), F.explode(place).alias("location")).select("is_index", F.trim("location").alias("location")).where("location <> ''")


def recognitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table of the award model, read from the order tables.

    One order is one recognition: its customer is the recipient, its priority the award's text, its year the
    order's, the customer's nation the country, the nation's region the program, the market segment the category.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation")
    from plumbline.functions.text import result_level

    # The award text that stands for a priority.
    award = F.when(F.col("o_orderpriority") == "1-URGENT", "Grand Winner").when(F.col("o_orderpriority") == "2-HIGH", "Gold Winner").when(F.col("o_orderpriority") == "3-MEDIUM", "Silver Winner").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Bronze Winner").otherwise("Finalist")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("o_orderkey").alias("node_id"), F.col("c_custkey").alias("org_id"), F.col("c_name").alias("org_name"), F.year("o_orderdate").alias("year"), result_level(award).alias("level"),
        F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country"), F.col("n_regionkey").alias("program_id"), F.col("c_mktsegment").alias("category"),
    )


#: The same in SQL, for the oracles.
RECOGNITIONS_SQL = """
recognitions AS (
  SELECT o_orderkey AS node_id, c_custkey AS org_id, c_name AS org_name, CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'grand' WHEN '2-HIGH' THEN 'gold' WHEN '3-MEDIUM' THEN 'silver'
              WHEN '4-NOT SPECIFIED' THEN 'bronze' ELSE 'finalist' END AS level,
         n_nationkey AS country_id, n_name AS country, n_regionkey AS program_id, c_mktsegment AS category
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
