"""Sinks: state tables as pure functions of old state and new rows, and writers.

There are no row locks and no in-place updates: a single writer computes the new state
and overwrites or appends it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import cut


def archive(old: DataFrame, new: DataFrame, order: Column) -> DataFrame:
    """Content-addressed insert: the earliest row of each (url, checksum) stays. Both have url, html, checksum."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    first = F.row_number().over(Window.partitionBy("url", "checksum").orderBy("_new", order))
    return both.withColumn("_n", first).where("_n = 1").drop("_n", "_new")


def checksum(html: Column) -> Column:
    return F.sha2(F.coalesce(html, F.lit("")), 256)


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Upsert: of each key the last row by ``order`` (given descending)."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def coalesced(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Upsert that keeps old values where new ones are null and counts attempts."""
    o = old.select(*keys, *(F.col(v).alias(f"_old_{v}") for v in values), F.col("attempts").alias("_old_attempts"))
    n = new.select(*keys, *values, F.lit(1).alias("_seen"))
    joined = o.join(n, list(keys), "full_outer")
    return joined.select(*keys, *(F.coalesce(v, f"_old_{v}").alias(v) for v in values), (F.coalesce("_old_attempts", F.lit(0)) + F.coalesce("_seen", F.lit(0))).cast("long").alias("attempts"))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows whose keys are not there yet, once each."""
    return new.dropDuplicates(list(keys)).join(old.select(*keys), list(keys), "left_anti")


def claimed(queue: DataFrame, limit: int) -> DataFrame:
    """The next ``limit`` pending rows by id, marked as being fetched."""
    return queue.where("status = 'pending'").orderBy("node_id").limit(limit).withColumn("status", F.lit("fetching"))


def settled(queue: DataFrame, outcome: DataFrame, most: int = 4) -> DataFrame:
    """Queue after outcomes (node_id, ok): done, failed after ``most`` attempts, else pending."""
    joined = queue.join(outcome, "node_id", "left")
    attempts = F.col("attempts") + F.when(F.col("ok").isNull(), 0).otherwise(1)
    status = F.when(F.col("ok").isNull(), F.col("status")).when(F.col("ok"), "done").when(attempts >= most, "failed").otherwise("pending")
    return joined.select("node_id", status.alias("status"), attempts.cast("long").alias("attempts"))


def requeued(queue: DataFrame) -> DataFrame:
    return queue.withColumn("status", F.when(F.col("status") == "fetching", "pending").otherwise(F.col("status")))


def rebuilt(df: DataFrame, path: str) -> None:
    """Truncate and rebuild; ``df`` may itself read the path, so it is finished in the shared folder first."""
    cut(df).write.mode("overwrite").parquet(path)


def appended(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


class FrozenVersion(RuntimeError):
    """A model version with a metrics summary must not change."""


def guard_frozen(registry: DataFrame, version: str) -> None:
    if registry.where((F.col("model_version") == version) & F.col("metrics_summary").isNotNull()).limit(1).count():
        raise FrozenVersion(version)
