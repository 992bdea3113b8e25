"""Trust in facts: scores with stated reasons, bands, densities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entity types whose values come from a controlled list.
CONTROLLED = ("country", "industry", "program", "program_edition", "category", "category_group", "category_definition")


def entity_score(kind: Column, n: Column) -> Column:
    base = F.when(kind.isin(*CONTROLLED), 0.85).otherwise(0.70)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), base + F.when(n >= 10, 0.10).when(n >= 3, 0.05).when(n == 2, 0.0).otherwise(-0.30))), 4)


def entity_reasons(kind: Column, n: Column) -> Column:
    """One sentence per term of the score."""
    told = F.concat(F.lit("appears in "), n.cast("string"), F.lit(" recognitions"))
    origin = F.when(kind.isin(*CONTROLLED), F.concat(F.lit("controlled-vocabulary dimension ("), kind, F.lit(")"))).otherwise(F.concat(F.lit("free-text entity ("), kind, F.lit(") — trust leans on corroboration")))
    count = F.when(n >= 10, F.concat(F.lit("well-corroborated: "), told)).when(n >= 3, F.concat(F.lit("corroborated: "), told)).when(n == 2, told).otherwise("singleton — appears in only 1 recognition (unverified)")
    return F.array(origin, count)


def band(score: Column) -> Column:
    return F.when(score >= 0.85, "high").when(score >= 0.65, "medium").otherwise("low")


def person_confidence(n: Column) -> Column:
    return F.when(n == 1, 0.55).when(n < 4, 0.68).otherwise(0.80)


def density_target(kind: Column, recognitions: Column) -> tuple[Column, Column]:
    """Evidence rows wanted of a subject: enough, and ideal."""
    large = F.when(kind == "organization", recognitions >= 100).otherwise(recognitions >= 10)
    low = F.when(kind == "organization", F.when(large, 50).otherwise(20)).otherwise(F.when(large, 30).otherwise(15))
    return low, F.when(low == 50, 100).otherwise(low * 2)


def review_priority(key_a: Column, key_b: Column, acronym: Column, same_country: Column, same_industry: Column, recognitions: Column) -> Column:
    bare = lambda k: F.length(F.replace(k, F.lit(" "), F.lit("")))
    score = F.least(bare(key_a), bare(key_b)) - F.when(acronym, 1).otherwise(0)
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), 3).otherwise(0)
    return score + flag(same_country) + flag(same_industry) + F.least(F.greatest(recognitions, F.lit(0)), F.lit(20)) / 10


def token_cost(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    """Cost of a run from token counts and prices per million."""
    return (tokens_in * price_in + tokens_out * price_out) / 1e6
