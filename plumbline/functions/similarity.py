"""Similarities of names, pair features, and hash splits, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import content_tokens, feature_key, initials, tokens

FEATURES = (
    "blocked_by_trigram", "blocked_by_rare_token", "blocked_by_acronym", "trigram_similarity", "token_jaccard", "length_ratio", "shared_rare_token_count",
    "normalized_token_overlap", "despaced_trigram_similarity", "is_acronym_expansion", "prefix_overlap", "suffix_match", "acronym_x_trigram", "acronym_x_jaccard",
)
BINARY = ("blocked_by_trigram", "blocked_by_rare_token", "blocked_by_acronym", "is_acronym_expansion")
CONTINUOUS = tuple(f for f in FEATURES if f not in BINARY)


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two arrays as sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def _grams(padded: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substr(padded, i, F.lit(3))))


def word_trigrams(name: Column) -> Column:
    """Trigrams of each lower-case word padded with two spaces before and one after, as a set."""
    words = F.filter(F.split(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    return F.array_distinct(F.flatten(F.transform(words, lambda w: _grams(F.concat(F.lit("  "), w, F.lit(" "))))))


def pg_similarity(a: Column, b: Column) -> Column:
    """Set similarity of word trigrams."""
    return jaccard(word_trigrams(a), word_trigrams(b))


def trigrams(s: Column) -> Column:
    """Trigrams of a whole string padded once."""
    return _grams(F.concat(F.lit("  "), s, F.lit(" ")))


def trigram_similarity(a: Column, b: Column) -> Column:
    return jaccard(trigrams(a), trigrams(b))


def token_jaccard(a: Column, b: Column) -> Column:
    return jaccard(F.array_distinct(tokens(a)), F.array_distinct(tokens(b)))


def overlap_coefficient(a: Column, b: Column) -> Column:
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    return ratio(F.size(F.array_intersect(x, y)), F.least(F.size(x), F.size(y)))


def length_ratio(a: Column, b: Column) -> Column:
    low, high = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return F.when(low > 0, low / high).otherwise(F.lit(0.0))


def despaced_similarity(a: Column, b: Column) -> Column:
    bare = lambda s: F.replace(s, F.lit(" "), F.lit(""))
    return trigram_similarity(bare(a), bare(b))


def prefix_overlap(a: Column, b: Column) -> Column:
    """Length of the common beginning over the longer length."""
    short = F.least(F.length(a), F.length(b))
    same = F.size(F.filter(F.sequence(F.lit(0), short), lambda i: (i > 0) & (F.left(a, i) == F.left(b, i))))
    return ratio(same, F.greatest(F.length(a), F.length(b)))


def suffix_match(a: Column, b: Column) -> Column:
    return prefix_overlap(F.reverse(a), F.reverse(b))


def is_acronym(a: Column, b: Column) -> Column:
    """Whether one key is one word of 2 to 7 letters that spells the initials of the other, of two or more words."""

    def one(short: Column, long: Column) -> Column:
        spelled = (short == initials(long, False)) | (short == initials(long, True))
        return short.rlike(r"^\p{L}{2,7}$") & (F.size(tokens(long)) >= 2) & spelled

    return one(a, b) | one(b, a)


def key_profile(key: Column) -> Column:
    """What the features need of one key: normal form, token and trigram sets, initials."""
    k = feature_key(key)
    many = F.size(tokens(k)) >= 2
    return F.struct(
        k.alias("key"), F.array_distinct(tokens(k)).alias("tokens"), F.array_distinct(content_tokens(k)).alias("content"), trigrams(k).alias("grams"), trigrams(F.replace(k, F.lit(" "), F.lit(""))).alias("despaced"),
        F.when(k.rlike(r"^\p{L}{2,7}$"), k).alias("short"), F.when(many, initials(k, False)).alias("initials"), F.when(many, initials(k, True)).alias("skipped"),
    )


def profile_features(a: Column, b: Column, reasons: Column, rare: Column) -> list[Column]:
    """The fourteen features of a pair of profiles. Similarities are rounded to six places."""
    r6 = lambda c: F.round(c, 6)
    spells = lambda x, y: F.coalesce((x["short"] == y["initials"]) | (x["short"] == y["skipped"]), F.lit(False))
    acronym = spells(a, b) | spells(b, a)
    tri, tok = r6(jaccard(a["grams"], b["grams"])), r6(jaccard(a["tokens"], b["tokens"]))
    overlap = ratio(F.size(F.array_intersect(a["tokens"], b["tokens"])), F.least(F.size(a["tokens"]), F.size(b["tokens"])))
    made = [
        F.array_contains(reasons, "trigram"), F.array_contains(reasons, "rare_token"), F.array_contains(reasons, "acronym"), tri, tok, r6(length_ratio(a["key"], b["key"])),
        F.size(F.array_intersect(F.array_intersect(a["content"], b["content"]), rare)), r6(overlap), r6(jaccard(a["despaced"], b["despaced"])), acronym,
        r6(prefix_overlap(a["key"], b["key"])), r6(suffix_match(a["key"], b["key"])), F.when(acronym, tri).otherwise(0.0), F.when(acronym, tok).otherwise(0.0),
    ]
    return [c.alias(n) for c, n in zip(made, FEATURES)]


def pair_features(key_a: Column, key_b: Column, reasons: Column, rare: Column) -> list[Column]:
    """The features of a pair of keys; ``blocking.with_features`` profiles each key only once."""
    return profile_features(key_profile(key_a), key_profile(key_b), reasons, rare)


def pair_fraction(left: Column, right: Column, salt: str | None = None) -> Column:
    """A pair's place in [0, 1): the first eight bytes of the SHA-256 of its keys (and a salt), big-endian."""
    parts = [F.lit(salt), F.lit("\0")] if salt else []
    digest = F.sha2(F.concat(*parts, left, F.lit("\0"), right), 256)
    return F.conv(F.substr(digest, F.lit(1), F.lit(16)), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


#: Shares of the splits, in order; boundaries are running sums of doubles.
SPLIT_V1 = (("train", 0.6), ("calibration", 0.2), ("evaluation", 0.2))
SPLIT_V2 = (("train", 0.7), ("calibration", 0.15), ("validation", 0.15))


def assigned_split(fraction: Column, shares=SPLIT_V1) -> Column:
    out, edge = None, 0.0
    for name, share in shares[:-1]:
        edge += share
        out = (F.when if out is None else out.when)(fraction < edge, name)
    return out.otherwise(shares[-1][0])


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of a share of k in n, within [0, 1]; (0, 1) without observations."""
    p = k / F.nullif(n, F.lit(0))
    d = 1 + z * z / F.nullif(n, F.lit(0))
    mid = (p + z * z / (2 * F.nullif(n, F.lit(0)))) / d
    half = z * F.sqrt(p * (1 - p) / F.nullif(n, F.lit(0)) + z * z / (4 * F.nullif(n, F.lit(0)) * F.nullif(n, F.lit(0)))) / d
    return F.coalesce(F.greatest(F.lit(0.0), mid - half), F.lit(0.0)), F.coalesce(F.least(F.lit(1.0), mid + half), F.lit(1.0))


def uncertainty(p: Column) -> Column:
    return F.abs(p - 0.5)


def ordered_pair(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)
