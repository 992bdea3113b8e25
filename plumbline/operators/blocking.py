"""Candidate pairs of names: similarity join, rare tokens, acronyms and hard cases.

Inputs hold ``id`` and ``key`` (and ``name`` for the trigram join). Outputs are pairs in code-point
order of their keys with a ``reason``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.similarity import key_profile, profile_features, word_trigrams
from plumbline.functions.text import ABBREVIATIONS, SMALL_WORDS, content_tokens, initials, tokens

PAIR = ("left_key", "left_id", "right_key", "right_id", "reason")


def _ordered(pairs: DataFrame, reason: str) -> DataFrame:
    """From key_a, id_a, key_b, id_b; pairs of one key fall away."""
    swap = F.col("key_a") > F.col("key_b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return pairs.where("key_a <> key_b").select(pick("key_a", "key_b").alias("left_key"), pick("id_a", "id_b").alias("left_id"), pick("key_b", "key_a").alias("right_key"), pick("id_b", "id_a").alias("right_id"), F.lit(reason).alias("reason"))


def trigram_pairs(orgs: DataFrame, threshold: float = 0.4) -> DataFrame:
    """All pairs of names whose word-trigram similarity reaches ``threshold``; exact, without comparing all.

    Prefix filter: with grams in ascending global frequency, two sets of that similarity share one of their first
    ``n - ceil(t n) + 1`` grams; sizes must agree within t. Returns the pair columns and ``similarity``.
    """
    sets = orgs.select("id", "key", word_trigrams(F.col("name")).alias("grams")).where(F.size("grams") > 0)
    exploded = sets.select("id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    frequency = exploded.groupBy("gram").agg(F.count("*").alias("df"))
    ranked = exploded.join(frequency, "gram").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("g"))
    keep = (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1).cast("int")
    prefix = ranked.select("id", "n", F.explode(F.slice("g", F.lit(1), keep)).alias("g")).select("id", "n", F.col("g.gram").alias("gram"))
    a, b = (prefix.select(F.col("id").alias(f"id_{s}"), F.col("n").alias(f"n_{s}"), "gram") for s in "ab")
    near = (F.col("id_a") < F.col("id_b")) & (F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - 1e-9)
    found = a.join(b, "gram").where(near).select("id_a", "id_b").distinct()
    side = lambda s: sets.select(F.col("id").alias(f"id_{s}"), F.col("key").alias(f"key_{s}"), F.col("grams").alias(f"grams_{s}"))
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    scored = found.join(side("a"), "id_a").join(side("b"), "id_b").withColumn("similarity", common / (F.size("grams_a") + F.size("grams_b") - common)).where(F.col("similarity") >= threshold - 1e-12)
    swap = F.col("key_a") > F.col("key_b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return scored.where("key_a <> key_b").select(pick("key_a", "key_b").alias("left_key"), pick("id_a", "id_b").alias("left_id"), pick("key_b", "key_a").alias("right_key"), pick("id_b", "id_a").alias("right_id"), F.lit("trigram").alias("reason"), "similarity")


def token_frequency(orgs: DataFrame) -> DataFrame:
    """Occurrences of each content token over all keys."""
    return orgs.select(F.explode(content_tokens(F.col("key"))).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def rare_tokens(orgs: DataFrame, most: int = 5) -> DataFrame:
    return token_frequency(orgs).where(F.col("df") <= most).select("token")


def rare_token_pairs(orgs: DataFrame, most: int = 5) -> DataFrame:
    """Pairs that share a rare token; a rare token has at most ``most`` owners, so the join stays small. One row per pair."""
    owned = orgs.select("id", "key", F.explode(F.array_distinct(content_tokens(F.col("key")))).alias("token")).join(rare_tokens(orgs, most), "token")
    a, b = (owned.select("token", F.col("id").alias(f"id_{s}"), F.col("key").alias(f"key_{s}")) for s in "ab")
    return _ordered(a.join(b, "token").where("id_a < id_b"), "rare_token").distinct()


def acronym_pairs(orgs: DataFrame) -> DataFrame:
    """A key of one word of 2 to 7 letters with every key of two or more words whose initials it spells."""
    key = F.col("key")
    long = orgs.where(F.size(tokens(key)) >= 2).select(F.col("id").alias("id_b"), F.col("key").alias("key_b"), F.explode(F.array_distinct(F.array(initials(key, False), initials(key, True)))).alias("key_a")).where(F.length("key_a").between(2, 7))
    short = orgs.where(key.rlike(r"^\p{L}{2,7}$")).select(F.col("id").alias("id_a"), F.col("key").alias("key_a"))
    return _ordered(short.join(long, "key_a").select("key_a", "id_a", "key_b", "id_b"), "acronym").distinct()


def _same(orgs: DataFrame, signature, reason: str) -> DataFrame:
    marked = orgs.withColumn("sig", signature).where("sig is not null")
    a, b = (marked.select("sig", F.col("id").alias(f"id_{s}"), F.col("key").alias(f"key_{s}")) for s in "ab")
    return _ordered(a.join(b, "sig").where("key_a < key_b"), reason)


def reordered_pairs(orgs: DataFrame) -> DataFrame:
    content = F.filter(tokens(F.col("key")), lambda t: ~t.isin(*SMALL_WORDS))
    return _same(orgs, F.when(F.size(content) >= 2, F.array_join(F.array_sort(content), " ")), "reordered")


def and_variant_pairs(orgs: DataFrame) -> DataFrame:
    return _same(orgs, F.array_join(F.filter(tokens(F.col("key")), lambda t: t != "and"), " "), "and_variant")


def abbreviation_pairs(orgs: DataFrame) -> DataFrame:
    """Keys that become another key when one known abbreviation is spelled out."""
    entries = [F.struct(F.lit(k).alias("short"), F.lit(v).alias("full")) for k, vs in ABBREVIATIONS.items() for v in vs]
    words = orgs.select("id", "key", tokens(F.col("key")).alias("w")).select("id", "key", "w", F.posexplode("w").alias("at", "word"))
    meant = words.select("*", F.explode(F.filter(F.array(*entries), lambda e: e["short"] == F.col("word"))).alias("e"))
    spelled = meant.select(F.col("id").alias("id_a"), F.col("key").alias("key_a"), F.array_join(F.transform("w", lambda t, i: F.when(i == F.col("at"), F.col("e.full")).otherwise(t)), " ").alias("key_b"))
    return _ordered(spelled.join(orgs.select(F.col("key").alias("key_b"), F.col("id").alias("id_b")), "key_b"), "abbreviation").distinct()


def merged_pairs(*blockers: DataFrame) -> DataFrame:
    """Union of blockers: one row per pair with its sorted reasons."""
    rows = blockers[0].select(*PAIR)
    for b in blockers[1:]:
        rows = rows.unionByName(b.select(*PAIR))
    return rows.groupBy("left_key", "right_key").agg(F.min("left_id").alias("left_id"), F.min("right_id").alias("right_id"), F.array_sort(F.collect_set("reason")).alias("reasons"))


#: Blockers by name, each a function of the names' table; add entries to extend ``generate``.
BLOCKERS = {"trigram": trigram_pairs, "rare_token": rare_token_pairs, "acronym": acronym_pairs}


def generate(orgs: DataFrame) -> DataFrame:
    return merged_pairs(*(f(orgs) for f in BLOCKERS.values()))


def with_features(pairs: DataFrame, orgs: DataFrame, rare: Column | None = None, rare_tokens: DataFrame | None = None) -> DataFrame:
    """Pairs (left_key, right_key, reasons) of ``orgs`` with the fourteen features; each key is profiled once and joined to its pairs.

    Rare tokens are an array column or a table (``token``) of any size; of the table each key gets its own.
    """
    keys = orgs.select("key").distinct().withColumn("profile", key_profile(F.col("key")))
    if rare is None:
        held = keys.select("key", F.explode("profile.content").alias("token")).join(rare_tokens, "token").groupBy("key").agg(F.collect_set("token").alias("rare"))
        keys = keys.join(held, "key", "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<string>")))
    else:
        keys = keys.withColumn("rare", rare)
    left = keys.select(F.col("key").alias("left_key"), F.col("profile").alias("_left"), "rare")
    right = keys.select(F.col("key").alias("right_key"), F.col("profile").alias("_right"))
    joined = pairs.join(left, "left_key").join(right, "right_key")
    return joined.select("left_key", "right_key", *profile_features(F.col("_left"), F.col("_right"), F.col("reasons"), F.col("rare")))


def hard_cases(orgs: DataFrame) -> DataFrame:
    """Pairs of all four patterns with the patterns joined by ``+``."""
    merged = merged_pairs(reordered_pairs(orgs), acronym_pairs(orgs), abbreviation_pairs(orgs), and_variant_pairs(orgs))
    return merged.withColumn("pattern", F.array_join("reasons", "+"))


def possible_duplicates(names: DataFrame, threshold: float) -> DataFrame:
    """Diagnostic count of similar pairs in a dimension."""
    return trigram_pairs(names, threshold).agg(F.count("*").alias("pairs"))
