"""Review of candidate pairs: lanes, exclusions, decisions, context and progress, as tables in and tables out.

Defined results: pairs are compared as (left_key, right_key) as they stand; null keys match nothing; repeated pairs of
an exclusion count once; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIR = ["left_key", "right_key"]


def acronym_priority(left: Column, right: Column) -> Column:
    """Letters of the shorter key without its spaces: of acronyms, long ones are the safer ones."""
    bare = lambda c: F.length(F.replace(c, F.lit(" "), F.lit("")))
    return F.least(bare(left), bare(right))


def lane(predictions: DataFrame, candidates: DataFrame, acronyms: bool, limit: int) -> DataFrame:
    """Pairs that candidates and predictions share, of one lane, in the order of review, ``limit`` at most.

    The acronym lane goes by length, the other by probability.
    """
    tagged = F.array_contains("reasons", "acronym")
    rows = predictions.join(candidates.select(*PAIR, "reasons"), PAIR).where(tagged if acronyms else ~tagged)
    rows = rows.withColumn("priority", acronym_priority(F.col("left_key"), F.col("right_key")).cast("long"))
    first = F.desc("priority") if acronyms else F.desc("probability")
    return rows.orderBy(first, *PAIR).limit(limit)


def excluded_pairs(*tables: DataFrame) -> DataFrame:
    """Pairs of any of the tables: the frozen benchmark, the labels, what is decided."""
    out = tables[0].select(*PAIR)
    for t in tables[1:]:
        out = out.union(t.select(*PAIR))
    return out.distinct()


def open_pairs(pairs: DataFrame, *tables: DataFrame) -> DataFrame:
    return pairs.join(excluded_pairs(*tables), PAIR, "left_anti")


def inserted_decisions(old: DataFrame, new: DataFrame, order: Column) -> DataFrame:
    """``new`` decisions with ``outcome``: inserted, or conflict where the losing key has lost already or an earlier new one has it."""
    rank = F.row_number().over(Window.partitionBy("loser_key").orderBy(order, "winner_key"))
    known = old.select("loser_key", F.lit(True).alias("_known")).distinct()
    fresh = new.withColumn("_rank", rank).join(known, "loser_key", "left")
    return fresh.withColumn("outcome", F.when(F.col("_known").isNull() & (F.col("_rank") == 1), "inserted").otherwise("conflict")).drop("_rank", "_known")


def context(keys: DataFrame, organizations: DataFrame, facts: DataFrame, countries: DataFrame) -> DataFrame:
    """What a reviewer sees of each key: its organisation, recognitions, years, programs and countries; nothing is lost on the way.

    ``organizations``: key, org_id, name; ``facts``: org_id, year, program_id, country_id; ``countries``: country_id, country.
    """
    per_org = facts.join(countries, "country_id", "left").groupBy("org_id").agg(F.count("*").alias("recognitions"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.countDistinct("program_id").alias("programs"), F.array_join(F.array_sort(F.collect_set("country")), "; ").alias("countries"))
    return keys.join(organizations, "key", "left").join(per_org, "org_id", "left").select("key", "name", F.coalesce("recognitions", F.lit(0)).alias("recognitions"), "first_year", "last_year", F.coalesce("programs", F.lit(0)).alias("programs"), F.coalesce("countries", F.lit("")).alias("countries"))


def hash_rank(rows: DataFrame, key: Column, buckets: int = 1024) -> DataFrame:
    """``rows`` with ``rank``: a fixed random order by the hash of ``key``, from 1.

    The order is cut into ``buckets`` of hashes, each ranked on its own behind the counts of those before it.
    """
    digest = F.sha2(key, 256)
    placed = rows.withColumn("_digest", digest).withColumn("_bucket", (F.conv(F.substr("_digest", F.lit(1), F.lit(8)), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("int"))
    counts = placed.groupBy("_bucket").count()
    before = counts.select("_bucket", (F.sum("count").over(Window.orderBy("_bucket")) - F.col("count")).alias("_before"))  # a row per bucket
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest"))
    return placed.join(F.broadcast(before), "_bucket").withColumn("rank", F.col("_before") + own).drop("_digest", "_bucket", "_before")


BANDS = ("high", "medium", "low")


def band(probability: Column) -> Column:
    return F.when(probability >= 0.8, "high").when(probability >= 0.5, "medium").when(probability.isNotNull(), "low")


def progress(pairs: DataFrame, labels: DataFrame, wanted: int) -> DataFrame:
    """Labelled pairs of each band of probability against the number wanted, best band first, pairs without one last."""
    rows = pairs.join(labels.select(*PAIR, "label"), PAIR, "left").groupBy(band(F.col("probability")).alias("band"))
    done = rows.agg(F.count("*").alias("pairs"), F.count("label").alias("labelled"), F.count_if(F.col("label") == "merge").alias("merges"))
    gap = F.greatest(F.lit(wanted) - F.col("labelled"), F.lit(0)).alias("gap")
    place = F.array_position(F.array(*map(F.lit, BANDS)), F.col("band"))
    return done.select("band", "pairs", "labelled", "merges", gap).orderBy(place.asc_nulls_last())


def exported(decisions: DataFrame, gold: DataFrame, version: int) -> DataFrame:
    """Decisions that the labels do not hold yet, as the rows of a new round."""
    return decisions.dropDuplicates(PAIR).join(gold.select(*PAIR), PAIR, "left_anti").select(*PAIR, "label", F.lit("active_learning").alias("provenance"), F.lit(version).alias("round"))
