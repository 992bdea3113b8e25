"""Connected components of an edge table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import dropped, salted_join, written_to


def components(edges: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Component of every node of ``edges`` (``a``, ``b``: long), named by its smallest node.

    Alternates large-star and small-star steps (Kiveris et al.) until nothing changes, in a number of rounds
    that grows with the square of the logarithm of the nodes at most; there is no bound on the rounds. Every
    step is two shuffles and is cut off by a table in the shared folder. A node gets its smallest
    neighbour by an aggregate and a join in which the edges of a node with many (over ``hot_rows``) are dealt in parts.

    Defined results: returns ``node``, ``component``; nodes without an edge to another node, and edges
    with a null end, are absent; repeated and reversed edges count once; no edges give no rows.
    """
    spark = edges.sparkSession
    now, path = written_to(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    last = None
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("weight"))
        total = 2 * last[0] if last else 2 * now.count()
        large = salted_join(both, low.select("a", "m"), "a", "b", total, low.select("a", "weight"), hot_rows).where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"), F.count("*").alias("weight"))
        small = salted_join(large, down.select("b", "m"), "b", "a", total, down.select("b", "weight"), hot_rows).select(F.col("m").alias("a"), "b", F.col("a").alias("c"))
        stars = small.select("a", "b").union(small.where("a <> c").select("a", F.col("c").alias("b")))
        new, new_path = written_to(stars.where("a <> b").distinct(), "edges")
        size = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        dropped(spark, path)
        now, path = new, new_path
        if size == last:
            break
        last = size
    return now.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("node"), "component").union(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
