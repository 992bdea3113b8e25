"""Mentions of known entities in texts: a dictionary join over n-grams, longest first at each word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import let, norm_key, years_in

# Confidence of an edge by entity type.
CONFIDENCE = {"program": 0.70, "program_edition": 0.70, "category_definition": 0.65, "organization": 0.55}
LONGEST = 8
#: Distinct first words of a vocabulary that are carried in the plan; beyond, they are joined.
FIRST_WORDS = 10_000


def vocabulary(programs: DataFrame, categories: DataFrame, organizations: DataFrame) -> DataFrame:
    """Keys with the entity they name; programs win over categories over organisations. Inputs: id, slug, name.

    Categories and organisations need two words and six characters, so that ordinary words do not link.
    """
    rows = None
    for rank, (kind, df) in enumerate((("program", programs), ("category_definition", categories), ("organization", organizations))):
        part = df.select(norm_key(F.col("name")).alias("gram"), F.struct(F.lit(rank).alias("rank"), F.col("id").cast("long").alias("entity_id"), F.col("slug").alias("entity_slug"), F.lit(kind).alias("entity_type")).alias("e"))
        part = part.where("gram <> ''") if rank == 0 else part.where("size(split(gram, ' ')) >= 2 and length(gram) >= 6")
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("gram").agg(F.min("e").alias("e")).select("gram", "e.*").withColumn("words", F.size(F.split("gram", " ")))


def mentions(texts: DataFrame, vocab: DataFrame) -> DataFrame:
    """First mention of every entity in each text (``doc_id``, ``text``).

    Grams start only at words that start an entry. Up to FIRST_WORDS distinct ones are looked up inside the array of a text's words, so
    that only their places leave it; more are joined.
    """
    first = vocab.withColumn("word", F.split_part("gram", F.lit(" "), F.lit(1))).groupBy("word").agg(F.max("words").alias("longest"))
    words = F.split(norm_key(F.col("text")), " ")
    start = lambda w, i: F.struct(i.alias("at"), F.get(w, i).alias("word"), F.array_join(F.slice(w, i + 1, LONGEST), " ").alias("ahead"))
    known = [r["word"] for r in first.select("word").limit(FIRST_WORDS + 1).collect()]
    if len(known) <= FIRST_WORDS:
        places = lambda w: F.filter(F.transform(w, lambda x, i: F.when(x.isin(*known), i)), lambda i: i.isNotNull())
        found = let(words, lambda w: F.transform(places(w), lambda i: start(w, i)))
    else:
        found = let(words, lambda w: F.transform(w, lambda x, i: start(w, i)))
    starts = texts.select("doc_id", F.explode(found).alias("s")).select("doc_id", "s.*")
    near = starts.join(first, "word").select("doc_id", "at", F.split("ahead", " ").alias("a"), "longest")
    grams = near.select("doc_id", "at", F.explode(F.sequence(F.lit(1), F.least(F.size("a"), F.col("longest"), F.lit(LONGEST)))).alias("span"), "a").select("doc_id", "at", "span", F.array_join(F.slice("a", F.lit(1), F.col("span")), " ").alias("gram"))
    hits = grams.join(vocab, "gram").groupBy("doc_id", "at").agg(F.max_by(F.struct("gram", "entity_id", "entity_slug", "entity_type"), "span").alias("h"))
    first_of = hits.groupBy("doc_id", "h.entity_type", "h.entity_slug").agg(F.min_by(F.struct("h.gram", "h.entity_id"), "at").alias("m"))
    confidence = F.create_map(*(F.lit(x) for kv in CONFIDENCE.items() for x in kv))
    return first_of.select("doc_id", "entity_type", "entity_slug", F.col("m.entity_id").alias("entity_id"), F.col("m.gram").alias("mention_text"), confidence[F.col("entity_type")].alias("confidence"))


def edition_edges(found: DataFrame, texts: DataFrame, editions: DataFrame) -> DataFrame:
    """Edges to a program's edition whose year the text names too. ``editions``: program_id, year, slug."""
    programs = found.where("entity_type = 'program'").join(texts.select("doc_id", F.explode(years_in(F.col("text"))).alias("year")), "doc_id")
    joined = programs.join(editions.select(F.col("program_id").alias("entity_id"), "year", F.col("slug").alias("edition_slug")), ["entity_id", "year"])
    return joined.select("doc_id", F.lit("program_edition").alias("entity_type"), F.col("edition_slug").alias("entity_slug"), "year", F.concat_ws(" ", "mention_text", "year").alias("mention_text"), F.lit(CONFIDENCE["program_edition"]).alias("confidence"))
