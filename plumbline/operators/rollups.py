"""Rollups of the fact table, and the views around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.trust import band

# Weight of each result level.
PRESTIGE = {"grand": 8.0, "gold": 5.0, "silver": 3.0, "peoples_choice": 2.0, "bronze": 1.0, "finalist": 0.5, "distinguished_honoree": 0.5}
LEVELS = ("grand", "gold", "silver", "bronze", "finalist", "peoples_choice", "distinguished_honoree")


def counted(level: str) -> Column:
    return F.count_if(F.col("level") == level).alias(level)


def prestige() -> Column:
    weight = F.lit(0.0)
    for level, w in PRESTIGE.items():
        weight = F.when(F.col("level") == level, w).otherwise(weight)
    return F.round(F.sum(weight), 1)


def organization_stats(facts: DataFrame) -> DataFrame:
    years = F.countDistinct("year")
    return facts.groupBy("org_id", "org_name").agg(
        F.count("*").alias("total_recognitions"), *(counted(x) for x in LEVELS), F.min("year").alias("first_win_year"), F.max("year").alias("latest_win_year"), years.alias("active_years"),
        F.countDistinct("category").alias("category_diversity"), F.countDistinct("country_id").alias("country_spread"), F.countDistinct("program_id", "year").alias("editions_entered"),
        prestige().alias("prestige_score"), F.round(F.try_divide(F.count("*"), years), 2).alias("avg_wins_per_active_year"),
    )


def _span() -> list[Column]:
    return [F.min("year").alias("first_year"), F.max("year").alias("latest_year")]


def category_stats(facts: DataFrame) -> DataFrame:
    return facts.groupBy("category").agg(F.count("*").alias("total_recognitions"), F.countDistinct("org_id").alias("distinct_recipients"), F.countDistinct("year").alias("active_years"), *_span())


def country_stats(facts: DataFrame) -> DataFrame:
    return facts.groupBy("country_id", "country").agg(F.count("*").alias("total_recognitions"), F.countDistinct("org_id").alias("distinct_recipients"), F.countDistinct("category").alias("category_diversity"), *_span())


def program_stats(facts: DataFrame) -> DataFrame:
    return facts.groupBy("program_id").agg(F.count("*").alias("total_recognitions"), F.countDistinct("year").alias("editions"), F.countDistinct("org_id").alias("distinct_recipients"), *_span())


def timeline_stats(facts: DataFrame) -> DataFrame:
    return facts.where("year is not null").groupBy("year").agg(
        F.count("*").alias("total_recognitions"), *(counted(x) for x in ("gold", "silver", "bronze", "finalist")), F.countDistinct("org_id").alias("distinct_recipients"),
        F.countDistinct("country_id").alias("distinct_countries"), F.countDistinct("category").alias("distinct_categories"), F.countDistinct("program_id").alias("distinct_editions"),
    )


def refresh_derived(facts: DataFrame, folder: str) -> dict[str, str]:
    """Rebuild all rollups in order; returns their paths."""
    made = {}
    for build in (organization_stats, category_stats, country_stats, program_stats, timeline_stats):
        made[build.__name__] = path = f"{folder}/{build.__name__}"
        build(facts).write.mode("overwrite").parquet(path)
    return made


def recognition_confidence(links: DataFrame, trust: DataFrame) -> DataFrame:
    """Weakest and mean trust of each recognition's linked entities. ``links``: node_id, entity_type, entity_id."""
    low = F.min("score")
    return links.join(trust, ["entity_type", "entity_id"]).groupBy("node_id").agg(F.round(low, 4).alias("min_score"), F.round(F.avg("score"), 4).alias("avg_score"), F.count("*").alias("n_dimensions"), band(low).alias("band"))


def fetch_rate(samples: DataFrame, unit: str = "hour") -> DataFrame:
    """Rate between consecutive samples of a counter (``source``, ``ts``, ``fetched``).

    A source may have any number of samples: each ``unit`` of time is ordered on its own, and its first sample
    follows the last one of the unit before, of which there is one row each.
    """
    rows = samples.select("source", "ts", "fetched", F.date_trunc(unit, F.col("ts").cast("timestamp")).alias("_unit"))
    own = F.lag(F.struct("ts", "fetched")).over(Window.partitionBy("source", "_unit").orderBy("ts"))
    lasts = rows.groupBy("source", "_unit").agg(F.max(F.struct("ts", "fetched")).alias("_last"))
    before = lasts.select("source", "_unit", F.lag("_last").over(Window.partitionBy("source").orderBy("_unit")).alias("_before"))
    rows = rows.withColumn("_own", own).join(before, ["source", "_unit"]).withColumn("_prev", F.coalesce("_own", "_before"))
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_prev.ts").cast("timestamp"))
    gained = F.col("fetched") - F.col("_prev.fetched")
    return rows.select("source", "ts", "fetched", gained.alias("gained"), F.round(F.try_divide(gained * F.lit(1e6), seconds), 2).alias("rate_per_s"))


def queue_status(queue: DataFrame, reported: DataFrame) -> DataFrame:
    """One row of counts with the reported total and whether all is done; single rows are joined."""
    counts = queue.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("pending", "fetching", "done", "failed")), F.count("*").alias("queued"))
    done = (F.col("done") == F.col("reported")) & (F.col("pending") == 0) & (F.col("failed") == 0)
    return counts.join(reported).withColumn("complete", done)  # both sides are aggregates of one row


def top(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(k)
