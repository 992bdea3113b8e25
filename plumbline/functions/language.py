"""Language of a text from its script and its function words; no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import let

# Function words by language, in the order that breaks ties.
WORDS = {
    "en": "the and of to in a is for with that on are as this by an be or from at your you we it its our has have will",
    "de": "der die und den das von ist mit für auf ein eine im dem des zu sich nicht auch werden wird sind als es bei aus",
    "es": "el la de que y en los un una por con para se del las es su lo como más",
    "fr": "le la les de des et un une que dans pour sur est au du en qui avec pas sont",
}
# Ranges of scripts that decide alone.
SCRIPTS = {"cjk": r"[\x{4E00}-\x{9FFF}\x{3040}-\x{30FF}\x{AC00}-\x{D7AF}&&\p{L}]", "cyrillic": r"[\x{0400}-\x{04FF}&&\p{L}]", "arabic": r"[\x{0600}-\x{06FF}&&\p{L}]"}


def _among(words: list[str]):
    return lambda w: w.isin(*words)


def latin_language(text: Column, least_words: int = 15, least_ratio: float = 0.04) -> Column:
    """``en``, ``de``, ``es``, ``fr`` or ``und`` by function words alone, whatever other scripts the text holds."""
    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([a-zA-Zà-ÿÀ-ß]+)"), F.lit(1)), lambda w: F.lower(w))
    known = sorted({w for v in WORDS.values() for w in v.split()})

    def by_words(n: Column) -> Column:
        best = F.greatest(*(n[k] for k in WORDS))
        out = F.when((n["words"] < least_words) | (best < least_ratio * n["words"]), "und")
        for k in WORDS:
            out = out.when(n[k] == best, k)
        return out

    hits = let(words, lambda w: F.struct(F.size(w).alias("words"), F.filter(w, _among(known)).alias("hits")))
    of_words = let(hits, lambda n: F.struct(n["words"].alias("words"), *(F.size(F.filter(n["hits"], _among(v.split()))).alias(k) for k, v in WORDS.items())))
    return let(of_words, by_words)


def detected_language(text: Column, script_share: float = 0.10, least_words: int = 15, least_ratio: float = 0.04) -> Column:
    """A script name, ``en``, ``de``, ``es``, ``fr`` or ``und``."""
    text = F.coalesce(text, F.lit(""))

    def by_script(n: Column) -> Column:
        top = F.greatest(*(n[k] for k in SCRIPTS))
        out = F.when(n["letters"] == 0, "und")
        for k in SCRIPTS:
            out = out.when((top >= script_share * n["letters"]) & (n[k] == top), k)
        return out

    counts = F.struct(F.regexp_count(text, F.lit(r"\p{L}")).alias("letters"), *(F.regexp_count(text, F.lit(p)).alias(k) for k, p in SCRIPTS.items()))
    latin = latin_language(text, least_words, least_ratio)
    # Texts without a letter or with one of a script that decides alone are few; only they are counted by script.
    scripted = ~text.rlike(r"\p{L}") | text.rlike("|".join(SCRIPTS.values()))
    out = F.when(scripted, F.coalesce(let(counts, by_script), latin)).otherwise(latin)
    return out


def gate(text: Column, language: Column) -> Column:
    """What the English gate does with a text of that language: ``kept``, ``skipped_non_english`` or ``skipped_empty``."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "skipped_empty").when(language == "en", "kept").otherwise("skipped_non_english")
