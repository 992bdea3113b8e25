"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at one measured property of a text and votes good (+1), bad
(-1) or abstains (0). A two-class latent model (Dawid and Skene's, with
abstention as a third outcome) is fitted to the counts of vote patterns of the
whole corpus; the posterior probability of the good class replaces a conjunction
of hard rules. Only the pattern counts, of which there are at most ``3 ** rules``,
reach the driver.

Defined results: a null or empty text has no words, fails the base rule and is
never kept; repeated rows are judged alike; an empty table gives an empty
result; columns of the input other than id and text are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import batch_words, column, lean, mixed, row_of, sums, text_steps, written

#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to a in is it that for was on are as with at by this from be "
    "der die das und in zu den von mit ist für auf ein eine im des sich dem "
    "le la les de et un une est en que dans pour par sur au des du "
    "el los las y que se del con una por para su como al lo"
).split()

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_distinct_words", "n_lines", "n_function_words", "n_upper_words", "n_bare_words", "n_shouts", "n_run_words")
SYMBOLS = b"#*$%&|<>"


def measured(batches: Iterator[pa.RecordBatch], text_col: str = "text", prefix: str = "") -> Iterator[pa.RecordBatch]:
    """The rows with the measures of their whole texts, named with ``prefix``."""
    lean()
    symbol = np.zeros(256, np.int8)
    symbol[list(SYMBOLS)] = 1
    function_words = pa.array(sorted(set(FUNCTION_WORDS)))
    for batch in batches:
        for step in text_steps(batch, text_col):
            text = pc.fill_null(column(step, text_col), "")
            codes, bounds, words = batch_words(text)
            out = _measures(text, codes, bounds, words, symbol, function_words)
            yield pa.RecordBatch.from_arrays([*step.columns, *(pa.array(out[k], pa.int64()) for k in (*MEASURES, *EXTRA))], names=[*step.schema.names, *(prefix + k for k in (*MEASURES, *EXTRA))])


def _measures(text: pa.Array, codes: np.ndarray, bounds: np.ndarray, words: pa.Array, symbol: np.ndarray, function_words: pa.Array) -> dict[str, np.ndarray]:
    n_words, doc = np.diff(bounds), row_of(bounds)
    of = lambda per_word: sums(per_word.to_numpy(zero_copy_only=False).astype(np.int64)[codes], bounds)
    lower = pc.utf8_lower(words)
    bare = pc.utf8_trim(lower, characters=".,;:!?\"'()")
    letters = pc.match_substring_regex(bare, pattern=r"^\pL+$")
    upper = pc.and_(pc.not_equal(words, lower), pc.equal(words, pc.utf8_upper(words)))
    shout = pc.or_(pc.match_substring(words, "!!"), pc.match_substring(words, "??"))

    texts = text.cast(pa.string())
    raw = texts.buffers()[2]
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    marks = symbol[data[offsets[0] : offsets[-1]]].astype(np.int64)

    lines = pc.split_pattern(texts, "\n")
    ends = lines.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    coded = pc.dictionary_encode(lines.flatten())
    line_code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    worded = pc.greater(pc.binary_length(pc.ascii_trim(coded.dictionary, characters=" \t\n\v\f\r")), 0).to_numpy(zero_copy_only=False)[line_code]
    line_doc = row_of(ends)[worded]
    pairs = np.unique((line_doc.astype(np.uint64) << np.uint64(32)) | line_code[worded].astype(np.uint64))
    n_lines = np.bincount(line_doc, minlength=len(texts))
    distinct_lines = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=len(texts))
    distinct = np.unique((doc.astype(np.uint64) << np.uint64(32)) | codes.astype(np.uint64))

    return {
        "n_words": n_words,
        "word_chars": of(pc.utf8_length(words)),
        "n_symbols": sums(marks, offsets - offsets[0]),
        "n_dup_lines": n_lines - distinct_lines,
        "n_repeat_words": sums(_repeated(codes, bounds, doc), bounds),
        "n_distinct_words": np.bincount((distinct >> np.uint64(32)).astype(np.int64), minlength=len(texts)),
        "n_lines": n_lines,
        "n_function_words": of(pc.is_in(bare, value_set=function_words)),
        "n_upper_words": of(upper),
        "n_bare_words": of(letters),
        "n_shouts": of(shout),
        "n_run_words": sums(np.concatenate(([0], (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1]))).astype(np.int64)[: len(codes)], bounds),
    }


def _repeated(codes: np.ndarray, bounds: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """1 for each word in a 3-word window that its text holds twice or more, else 0."""
    hit = np.zeros(len(codes), np.int64)
    if len(codes) < 3:
        return hit
    at = np.flatnonzero(doc[:-2] == doc[2:])
    if not len(at):
        return hit
    u = codes.astype(np.uint64)
    key = mixed(mixed(mixed(doc[at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + u[at]) + u[at + 1]) + u[at + 2]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    for w in (order[1:][same], order[:-1][same]):
        for k in range(3):
            hit[at[w] + k] = 1
    return hit


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules(prefix: str = "") -> dict[str, Column]:
    """Vote of each rule as a column expression over the measures."""
    n = F.col(prefix + "n_words")
    share = lambda c, of=n: F.col(prefix + c) / F.greatest(of, F.lit(1))
    mean, lines = share("word_chars"), F.col(prefix + "n_lines")
    return {
        "word_length": _vote(mean.between(3.0, 10.0), (mean < 2.0) | (mean > 14.0)),
        "symbols": _vote(share("n_symbols") <= 0.02, share("n_symbols") > 0.15),
        "duplicate_lines": _vote(share("n_dup_lines", lines) <= 0.1, share("n_dup_lines", lines) > 0.3),
        "repeated_windows": _vote(share("n_repeat_words") <= 0.2, share("n_repeat_words") > 0.4),
        "function_words": _vote(share("n_function_words") >= 0.06, share("n_function_words") < 0.02),
        "upper_case": _vote(share("n_upper_words") <= 0.1, share("n_upper_words") > 0.5),
        "plain_words": _vote(share("n_bare_words") >= 0.85, share("n_bare_words") < 0.6),
        "shouting": _vote(share("n_shouts") <= 0.01, share("n_shouts") > 0.2),
        "runs": _vote(share("n_run_words") <= 0.02, share("n_run_words") > 0.2),
        "variety": _vote((n >= 50) & (share("n_distinct_words") >= 0.2), share("n_distinct_words") < 0.1),
        "length": _vote(n >= 80, n < 30),
    }


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, trust: float = 8.0) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns.

    ``patterns``: one row of votes (-1, 0, 1) per distinct pattern; ``counts``: rows of each.
    ``trust``: pseudo-counts per rule and class of votes that agree with the class (a quarter
    of them disagree), which keeps the classes named. Returns the log prior odds of good and
    the log odds of each rule's three outcomes.
    """
    total = counts.sum()
    k = patterns.shape[1]
    prior = np.array([[2.0, 1.0, 0.5], [0.5, 1.0, 2.0]]) / 3.5 * trust  # class bad, good: outcomes -1, 0, 1
    score = patterns.sum(1)
    q = np.clip(0.5 + score / (2.0 * max(k, 1)), 0.02, 0.98)
    base = 0.0
    odds = np.zeros((k, 3))
    hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        w1, w0 = counts * q, counts * (1 - q)
        p1 = np.einsum("i,ikv->kv", w1, hot) + prior[1]
        p0 = np.einsum("i,ikv->kv", w0, hot) + prior[0]
        new = np.log(p1 / p1.sum(1, keepdims=True)) - np.log(p0 / p0.sum(1, keepdims=True))
        base = float(np.log((w1.sum() + 1) / (w0.sum() + 1)))
        moved, odds = np.abs(new - odds).max(initial=0), new
        q = 1 / (1 + np.exp(-np.clip(base + np.einsum("ikv,kv->i", hot, odds), -50, 50)))
        if moved < 1e-9 * max(total, 1) or moved < 1e-7:
            break
    return base, odds


def _with_measures(docs: DataFrame, text_col: str, prefix: str = "") -> DataFrame:
    extra = ", ".join(f"`{prefix}{c}` long" for c in (*MEASURES, *EXTRA))
    own = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(lambda it: measured(it, text_col, prefix), f"{own}, {extra}")


def fitted(rows: DataFrame) -> tuple[float, dict[str, tuple[float, float, float]]]:
    """Prior log odds and, per rule, the log odds of its outcomes, from the votes on measured ``rows``."""
    votes = rules()
    names = list(votes)
    seen = rows.select(*(v.alias(k) for k, v in votes.items())).groupBy(*names).count().collect()  # at most 3 ** rules rows
    patterns = np.array([[r[k] for k in names] for r in seen], dtype=int).reshape(len(seen), len(names))
    base, odds = fit_votes(patterns, np.array([r["count"] for r in seen], dtype=float))
    return base, {name: tuple(float(x) for x in odds[k]) for k, name in enumerate(names)}


def verdict(model: tuple[float, dict[str, tuple[float, float, float]]], threshold: float, prefix: str = "") -> tuple[Column, Column, Column]:
    """Expressions over the measures: base rule failed, posterior of good, kept."""
    base, odds = model
    logit = F.lit(base)
    for name, vote in rules(prefix).items():
        bad, none, good = odds[name]
        logit = logit + F.when(vote < 0, bad).when(vote > 0, good).otherwise(none)
    n, repeat = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    failed = (n < 50) | (100 * repeat > 50 * n)
    quality = 1 / (1 + F.exp(-logit))
    return failed, quality, ~failed & (quality >= threshold)


def quality_posterior(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Measures, votes' posterior and verdict of every document.

    Returns id_col as ``doc_id`` with the measures, ``base_failed``, ``quality`` (posterior of
    the good class, 0 to 1) and ``kept`` (not failed and ``quality >= threshold``).
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(_with_measures(slim, "text").drop("text"), "quality")
    failed, quality, kept = verdict(fitted(rows), threshold)
    return rows.select("doc_id", *MEASURES, *EXTRA, failed.alias("base_failed"), quality.alias("quality"), kept.alias("kept"))


def good_documents(docs: DataFrame, text_col: str = "text", threshold: float = 0.1) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Texts are measured twice, once to fit and once to filter, so that no text is shuffled.
    """
    rows = written(_with_measures(docs.select(F.col(text_col).alias("text")), "text").drop("text"), "quality")
    prefix = "__quality_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    _, _, kept = verdict(fitted(rows), threshold, prefix)
    return _with_measures(docs, text_col, prefix).where(kept).select(*(F.col(f"`{c}`") for c in docs.columns))
