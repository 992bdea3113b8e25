"""External evidence: a cheap-first filter cascade, counts by reason, coverage by subject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import fold_text
from plumbline.functions.trust import density_target
from plumbline.functions.urls import is_junk_url, source_tier

# Words of organisations' names that identify nobody.
ORG_STOP = "the of and for a an inc llc ltd co corp corporation company group holdings plc sa gmbh nv ag pt tbk limited incorporated".split()
PERSON_STOP = "dr mr mrs ms prof jr sr the".split()


def folded_subjects(rows: DataFrame, text: str = "text", name: str = "name", url: str = "url") -> DataFrame:
    """``rows`` with the folded forms that ``subject_mentioned`` reads."""
    return rows.withColumns({"_name": fold_text(F.col(name)), "_text": fold_text(F.col(text)), "_url": F.replace(fold_text(F.col(url)), F.lit(" "), F.lit(""))})


def subject_mentioned(kind: Column) -> Column:
    """Whether a page of ``folded_subjects`` names its subject, in its text or its url; true for an unusable name."""
    n, t, u = F.col("_name"), F.col("_text"), F.col("_url")
    words, have = F.filter(F.split(n, " "), lambda w: F.length(w) >= 2), F.split(t, " ")
    person = kind == "person"
    exact = F.concat(F.lit(" "), t, F.lit(" ")).contains(F.concat(F.lit(" "), n, F.lit(" ")))
    own = F.filter(words, lambda w: ~w.isin(*PERSON_STOP))
    surname = F.coalesce(F.element_at(F.when(F.size(own) > 0, own), -1), F.lit(""))
    by_person = ((F.length(surname) >= 3) & F.array_contains(have, surname)) | (F.size(F.filter(own, lambda w: F.array_contains(have, w))) >= 2)
    brand = F.filter(words, lambda w: ~w.isin(*ORG_STOP) & (F.length(w) >= 3))
    by_org = F.arrays_overlap(F.when(F.size(brand) > 0, brand).otherwise(words), have)
    in_text = (n == "") | exact | (F.size(words) == 0) | F.when(person, by_person).otherwise(by_org)
    slug = F.replace(n, F.lit(" "), F.lit(""))
    all_own = F.filter(F.split(n, " "), lambda w: ~w.isin(*PERSON_STOP))
    last = F.coalesce(F.element_at(F.when(F.size(all_own) > 0, all_own), -1), F.lit(""))
    long = F.filter(F.split(n, " "), lambda w: (F.length(w) >= 4) & ~w.isin(*ORG_STOP))
    in_url = (n != "") & (u != "") & (u.contains(slug) | F.when(person, (F.length(last) >= 4) & u.contains(last)).otherwise(F.exists(long, lambda w: u.contains(w))))
    return in_text | F.coalesce(in_url, F.lit(False))


def funnel(pages: DataFrame, known: DataFrame, least_chars: int = 500) -> DataFrame:
    """Each page with its tier and the first reason to skip it, or ``kept``.

    ``pages``: subject, kind, name, url, text; ``known``: subject, url already gathered. Of equal texts the first by
    subject and url stays.
    """
    rows = pages.join(known.select("subject", "url", F.lit(True).alias("_known")), ["subject", "url"], "left")
    text, tier = F.coalesce(F.col("text"), F.lit("")), source_tier(F.col("url"))
    early = F.when(is_junk_url(F.col("url")), "junk_url").when(tier == "E", "tier_e").when(F.col("_known"), "exists").when(F.length(text) < least_chars, "thin")
    rows = folded_subjects(rows.withColumn("tier", tier).withColumn("_early", early).withColumn("_sha", F.sha2(text, 256)))
    # only pages that are not skipped yet are compared; the others stand alone, so that empty texts are no hot key
    n = F.row_number().over(Window.partitionBy(F.when(F.col("_early").isNull(), F.col("_sha")).otherwise(F.concat_ws(" ", "subject", "url"))).orderBy("subject", "url"))
    outcome = F.coalesce("_early", F.when(n > 1, "duplicate").when(~subject_mentioned(F.col("kind")), "not_named").otherwise("kept"))
    return rows.select("subject", "kind", "url", "tier", outcome.alias("outcome"))


def coverage(subjects: DataFrame, evidence: DataFrame) -> DataFrame:
    """Rows and good sources of each subject against its target: met, partial, sparse or none."""
    have = evidence.groupBy("subject").agg(F.count("*").alias("n"), F.count_if(F.col("tier").isin("A", "B")).alias("good"))
    low, high = density_target(F.col("kind"), F.col("recognitions"))
    n = F.coalesce("n", F.lit(0))
    status = F.when(n >= F.col("low"), "met").when(n * 2 >= F.col("low"), "partial").when(n > 0, "sparse").otherwise("none")
    return subjects.join(have, "subject", "left").withColumn("low", low).withColumn("high", high).select("subject", "kind", "recognitions", n.cast("long").alias("n"), F.coalesce("good", F.lit(0)).cast("long").alias("good"), F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"), status.alias("status"))


def expanded_queries(subjects: DataFrame, templates: list[str]) -> DataFrame:
    """Search phrases of each subject from fixed templates with ``{name}``; equal phrases once."""
    phrases = F.array(*(F.replace(F.lit(t), F.lit("{name}"), F.col("name")) for t in templates))
    return subjects.select("subject", F.posexplode(phrases).alias("angle", "query")).groupBy("subject", "query").agg(F.min("angle").alias("angle"))


def ranked_subjects(orgs: DataFrame, people: DataFrame, n_org: int, n_person: int) -> DataFrame:
    """Most recognised organisations and people. Inputs: slug, name, recognitions."""
    def head(df: DataFrame, kind: str, n: int) -> DataFrame:
        return df.orderBy(F.desc("recognitions"), "slug").limit(n).select(F.lit(kind).alias("kind"), F.col("slug").alias("subject"), "name", "recognitions")

    return head(orgs, "organization", n_org).unionByName(head(people, "person", n_person))
