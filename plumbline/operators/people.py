"""The person layer: people named in titles of personal awards, one per name and organisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.people import PERSONAL_AWARD, extract_person, parsed_role
from plumbline.functions.text import norm_key
from plumbline.functions.trust import person_confidence
from plumbline.operators.canonical import with_slugs


def personal(records: DataFrame) -> DataFrame:
    """Records of awards to a person with a title. Input: rec_id, award, title, org_key."""
    return records.where(F.col("award").rlike(PERSONAL_AWARD) & (F.trim(F.coalesce("title", F.lit(""))) != ""))


def resolved_people(records: DataFrame) -> DataFrame:
    """People with first name form, first role, recognitions and confidence. Input: rec_id, title, org_key.

    Names are extracted once per distinct title.
    """
    titles = records.select("title").where("title is not null").distinct().withColumn("name", extract_person("title")).withColumn("role", parsed_role(F.col("title")))
    named = records.join(titles, "title").where("name is not null").withColumn("person_key", norm_key(F.col("name")))
    people = named.groupBy("person_key", "org_key").agg(
        F.min_by("name", "rec_id").alias("name"), F.min_by("role", F.when(F.col("role").isNotNull(), F.col("rec_id"))).alias("role"), F.count("*").alias("n"), F.array_sort(F.collect_list("rec_id")).alias("rec_ids"), F.min("rec_id").alias("first_seq"),
    )
    slugged = with_slugs(people.withColumn("norm_key", norm_key(F.col("name"))).withColumn("norm_key", F.concat_ws(" ", "norm_key")))
    return slugged.select(F.concat_ws("@", "person_key", F.coalesce("org_key", F.lit("0"))).alias("norm_key"), "slug", "name", "org_key", "role", person_confidence(F.col("n")).alias("confidence"), "rec_ids")
