"""Reports as tables: data quality, evidence, canonicalisation, people, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def quality_sections(facts: DataFrame, parties: DataFrame) -> DataFrame:
    """The data-quality report as (section, label, n): eleven scalars and seven groups, from one pass over each table.

    ``facts``: node_id, org_id, year, level, program_id, country_id, category; ``parties``: node_id, role, party_id.
    """
    scalars = facts.agg(
        F.count("*").alias("recognitions"), F.countDistinct("org_id").alias("organizations"), F.countDistinct("country_id").alias("countries"), F.countDistinct("program_id").alias("programs"), F.countDistinct("category").alias("categories"),
        F.countDistinct("program_id", "year").alias("editions"), F.count_if(F.col("year").isNull()).alias("without_year"), F.count_if(F.col("level") == "other").alias("without_level"), (F.max("year") - F.min("year") + 1).cast("long").alias("years"),
    )
    more = parties.agg(F.count("*").alias("parties"), F.countDistinct("party_id").alias("distinct_parties"))
    listing = lambda df: df.select(F.explode(F.array(*(F.struct(F.lit("scalars").alias("section"), F.lit(c).alias("label"), F.col(c).cast("long").alias("n")) for c in df.columns))).alias("s")).select("s.*")
    listed = listing(scalars).unionByName(listing(more))
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    groups = ("level", "program_id", "year", "country_id", "category")
    cut = facts.select(F.explode(F.array(*(F.struct(F.lit(f"by {c}").alias("section"), label(c).alias("label")) for c in groups))).alias("s")).select("s.*").groupBy("section", "label").agg(F.count("*").alias("n"))
    per_org = facts.groupBy("org_id").agg(F.count("*").alias("k")).select(F.lit("organizations by recognitions").alias("section"), F.when(F.col("k") == 1, "1").when(F.col("k") < 5, "2-4").when(F.col("k") < 10, "5-9").otherwise("10+").alias("label")).groupBy("section", "label").agg(F.count("*").alias("n"))
    by_role = parties.groupBy(F.lit("by role").alias("section"), label("role").alias("label")).agg(F.count("*").alias("n"))
    return listed.unionByName(cut).unionByName(per_org).unionByName(by_role)


def evidence_sections(rows: DataFrame) -> DataFrame:
    """Evidence by (section, label): count, subjects, average relevance; one pass with a row for each grouping.

    ``rows``: subject, kind, tier, categories (array), sentiment, model, domain, relevance.
    """
    pair = lambda section, c: F.struct(F.lit(section).alias("section"), F.coalesce(c.cast("string"), F.lit("none")).alias("label"))
    own = F.array(pair("all", F.lit("all")), pair("kind", F.col("kind")), pair("tier", F.col("tier")), pair("sentiment", F.col("sentiment")), pair("model", F.col("model")), pair("domain", F.col("domain")))
    cats = F.transform(F.coalesce("categories", F.array().cast("array<string>")), lambda c: pair("category", c))
    long = rows.select("subject", "relevance", F.explode(F.concat(own, cats)).alias("g")).select("subject", "relevance", "g.*")
    return long.groupBy("section", "label").agg(F.count("*").alias("n"), F.countDistinct("subject").alias("subjects"), F.round(F.avg("relevance"), 3).alias("relevance"))


def canonicalization_counters(rows: DataFrame, keys: dict[str, str], candidates: DataFrame | None = None) -> DataFrame:
    """Per dimension: distinct keys made, rows that met one exactly, and candidate pairs between its keys.

    ``keys``: dimension by column; ``candidates``: dimension and pair.
    """
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(c).cast("string").alias("key")) for c, d in keys.items()))).alias("k")).select("k.*").where("key IS NOT NULL")
    made = long.groupBy("dimension", "key").count().groupBy("dimension").agg(F.count("*").alias("created"), (F.sum("count") - F.count("*")).alias("exact"))
    if candidates is None:
        return made.withColumn("candidates", F.lit(0).cast("long"))
    return made.join(candidates.groupBy("dimension").agg(F.count("*").alias("candidates")), "dimension", "left").na.fill(0, ["candidates"])


def person_report(people: DataFrame, organizations: DataFrame, recognitions: DataFrame) -> DataFrame:
    """People with their organisation, if known, and what they are recognised for; people without a recognition are left out."""
    counted = recognitions.groupBy("person_id").agg(F.count("*").alias("recognitions"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return people.join(counted, "person_id").join(organizations.select("org_id", F.col("name").alias("organization")), "org_id", "left").select("person_id", "name", "organization", "recognitions", "first_year", "last_year")


def candidate_sample(candidates: DataFrame, names: DataFrame, limit: int) -> DataFrame:
    """The most similar candidates with the names of both sides; the limit is the report's."""
    side = lambda s: names.select(F.col("org_id").alias(f"{s}_id"), F.col("name").alias(f"{s}_name"))
    return candidates.join(side("left"), "left_id").join(side("right"), "right_id").orderBy(F.desc("similarity"), "left_id", "right_id").limit(limit).select("left_id", "left_name", "right_id", "right_name", "similarity")


def discoverable(ledger: DataFrame, mention_pairs: DataFrame, generated: DataFrame) -> DataFrame:
    """Pairs of organisations that similar mentions lead to, with whether candidates were generated for them.

    ``ledger``: mention, org_id; ``mention_pairs``: left_mention, right_mention, similarity; ``generated``: left_id, right_id, ids in order.
    """
    side = lambda s: ledger.select(F.col("mention").alias(f"{s}_mention"), F.col("org_id").alias(f"_{s}"))
    pairs = mention_pairs.join(side("left"), "left_mention").join(side("right"), "right_mention").where("_left <> _right")
    best = pairs.groupBy(F.least("_left", "_right").alias("left_id"), F.greatest("_left", "_right").alias("right_id")).agg(F.max("similarity").alias("similarity"))
    known = generated.select("left_id", "right_id", F.lit(True).alias("generated")).distinct()
    return best.join(known, ["left_id", "right_id"], "left").withColumn("generated", F.coalesce("generated", F.lit(False)))


def gap_sample(pairs: DataFrame, limit: int = 40) -> DataFrame:
    """The most similar discoverable pairs that were not generated; the limit is the report's."""
    return pairs.where("NOT generated").orderBy(F.desc("similarity"), "left_id", "right_id").limit(limit).select("left_id", "right_id", "similarity")


def worst_first(coverage: DataFrame, limit: int = 60) -> DataFrame:
    """Subjects with the least good evidence first; the limit is the report's."""
    return coverage.orderBy("good", "n", "subject").limit(limit)


def versioned(rows: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the version, rows of any other or of none)."""
    same = F.col("version").eqNullSafe(F.lit(version))
    return rows.where(same), rows.where(~same)


def backfilled(rows: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """``rows`` with ``column`` from ``source`` where it is null: an update from a join; of several source rows the smallest value counts."""
    found = source.groupBy(key).agg(F.min(column).alias("_found"))
    return rows.join(found, key, "left").withColumn(column, F.coalesce(column, "_found")).drop("_found")


def names_most_used(rows: DataFrame) -> DataFrame:
    """The key that most rows of an organisation have; ties go to the smaller key. ``rows``: org_id, key."""
    n = rows.groupBy("org_id", "key").agg(F.count("*").alias("n"))
    return n.withColumn("_r", F.row_number().over(Window.partitionBy("org_id").orderBy(F.desc("n"), "key"))).where("_r = 1").drop("_r")
