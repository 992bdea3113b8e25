"""Toxicity by maximum-scoring segments over token log-odds.

1. Token scores: log-odds ratios between toxic and other labelled texts with an informative Dirichlet
   prior (the pooled token distribution), counting a token once a text. Every token of the training
   texts has one; it counts as far as it is certain, so its score is the bound of its log-odds that is
   ``certainty`` deviations nearer to 0. Tokens are words and word beginnings, so that unseen
   inflections are weighed; a word takes the score of its most certain token. Every word costs
   ``cost``, so that the expected score of other texts is negative.
2. Segments: a linear-time scan (Ruzzo and Tompa's) finds all maximal scoring segments of a whole text.
3. Calibration: the best segment of n words of other texts follows an extreme-value law with
   parameters lambda and K, fitted by maximum likelihood to the other training texts. A segment of score S
   has ``lambda * S - ln(K * n)`` nats; it is significant above 0. The best r segments of a text are judged together by
   Karlin and Altschul's law of their sum, and the least likely r is the text's evidence, which a
   logistic fit on training texts maps to a probability.

Bounds: at most about ``train_limit`` distinct labelled texts train the model (a parameter; all where there are fewer).
Tokens whose score is 0 need no place in the table that is broadcast; it holds the others
of the training texts, and more than TABLE_TOKENS of them are an error.

Defined results: a null or empty text has no segment and gets the least probability; rows without a label are
scored like others; repeated labels of an id count once, contradicting ones not at all; without any
label of one class every score is 0. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import batch_words, column, lean, mixed, row_of, tables, text_steps, written

EDGES = ".,;:!?\"'()[]{}<>*-_…«»„“”’‘"


#: Lengths of the word beginnings that stand in for inflected forms.
STEMS = (4, 5, 6, 7, 8)


def plain(words: pa.Array) -> pa.Array:
    """Tokens as they are counted: lower case, without punctuation at their ends."""
    return pc.utf8_trim(pc.utf8_lower(words), characters=EDGES)


def tokens_of(words: pa.Array) -> list[pa.Array]:
    """The tokens that each word stands for: itself and, marked with ``^``, its beginnings."""
    bare = plain(words)
    begins = [pc.binary_join_element_wise(pa.scalar("^"), pc.utf8_slice_codeunits(bare, 0, k), "") for k in STEMS]
    return [bare, *begins]


def with_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``sketch``, the smallest hash of a text's 5-word windows (of all words, if fewer): near copies mostly share it."""
    for batch in batches:
        for step in text_steps(batch, "text"):
            codes, bounds, words = batch_words(column(step, "text"))
            h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))[codes]
            key = h.copy()
            for k in range(1, 5):
                key[: len(h) - k if len(h) > k else 0] = mixed(key[: len(h) - k if len(h) > k else 0]) + h[k:]
            sketch = np.zeros(step.num_rows, np.uint64)
            for d in range(step.num_rows):
                a, b = bounds[d], bounds[d + 1]
                if b > a:
                    sketch[d] = mixed(key[a : max(b - 4, a + 1)]).min()
            yield pa.RecordBatch.from_arrays([*step.columns, pa.array(sketch.view(np.int64))], names=[*step.schema.names, "sketch"])


def token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: in how many toxic and other texts each token stands. Input: ``text``, ``toxic``."""
    lean()
    for batch in batches:
        for step in text_steps(batch, "text"):
            codes, bounds, words = batch_words(column(step, "text"))
            if not len(codes):
                continue
            kinds = tokens_of(words)
            tokens = pc.dictionary_encode(pa.concat_arrays(kinds))
            token = tokens.indices.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(kinds), -1)[:, codes]
            n = len(tokens.dictionary)
            once = np.unique((row_of(bounds) * n + token).ravel())
            toxic = column(step, "toxic").to_numpy(zero_copy_only=False).astype(np.int64)[once // n]
            bad = np.bincount(once % n, weights=toxic, minlength=n).astype(np.int64)
            every = np.bincount(once % n, minlength=n)
            yield pa.RecordBatch.from_arrays([tokens.dictionary, pa.array(bad), pa.array(every - bad)], names=["token", "bad", "good"])


def maximal_segments(left: list[float], right: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments of a sequence, in order, as (score, first, last).

    Its items are the positive ones of the sequence; ``left`` and ``right`` are the sums of the whole sequence before
    and after each. Ruzzo and Tompa's scan in linear time: each candidate remembers the last one before
    it with a smaller left sum, and a new least left sum makes all candidates final.
    """
    out: list[tuple[float, int, int]] = []
    kept: list[tuple[float, float, int, int, int]] = []  # left, right, first, last, the candidate remembered
    for k, (low, high) in enumerate(zip(left, right)):
        first = k
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= low:
                j = kept[j][4]
            if j < 0:
                out += [(r - l, a, b) for l, r, a, b, _ in kept]
                kept = [(low, high, first, k, -1)]
                break
            if kept[j][1] >= high:
                kept.append((low, high, first, k, j))
                break
            low, first = kept[j][0], kept[j][2]
            del kept[j:]
    return out + [(r - l, a, b) for l, r, a, b, _ in kept]


#: Evidence of a text without words, and the bound of all evidence.
LEAST, MOST = -30.0, 1e4


def evidence_of(nats: list[float]) -> float:
    """Evidence of a text from its segments' nats.

    For r segments of sum t the chance is about ``exp(-t) * t ** (r - 1) / (r! * (r - 1)!)``; looking at all r
    costs a factor of 2 for each further segment. The negative logarithm of the least chance is the evidence.
    """
    if not nats:
        return LEAST
    x = sorted(nats, reverse=True)
    best, total = x[0], 0.0
    for r, v in enumerate(x, 1):
        total += v
        if v <= 0:
            break
        best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r) - (r - 1) * math.log(2))
    return min(max(best, LEAST), MOST)


@dataclass
class ToxicModel:
    """Token scores with the calibration; ``evidence`` needs no Spark."""

    tokens: pa.Array = field(default_factory=lambda: pa.array([], pa.string()))
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    cost: float = 1.0
    lam: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    intercept: float = -50.0

    def word_scores(self, words: pa.Array) -> np.ndarray:
        """Score of each word: that of its token that is farthest from 0, less the cost of a word."""
        best = np.zeros(len(words))
        if len(self.tokens) and len(words):
            padded = np.append(self.scores, np.float32(0))
            for kind in tokens_of(words):
                own = padded[pc.fill_null(pc.index_in(kind, value_set=self.tokens), len(self.tokens)).to_numpy(zero_copy_only=False)]
                best = np.where(np.abs(own) > np.abs(best), own, best)
        return best - self.cost

    def best_and_segments(self, text: pa.Array) -> tuple[list[float], list[int], list[list[tuple[float, int, int]]]]:
        """For each text the score of its best segment, one word at least, its words, and all maximal segments as (score, first word, last word)."""
        codes, bounds, words = batch_words(text)
        w = self.word_scores(words)[codes]
        hits = np.flatnonzero(w > 0)
        first = np.searchsorted(hits, bounds)
        n = np.diff(bounds)
        best = np.full(len(n), -np.inf)
        some = np.flatnonzero(n)
        if len(some):
            best[some] = np.maximum.reduceat(w, bounds[some])
        out: list[list[tuple[float, int, int]]] = [[] for _ in n]
        for d in np.flatnonzero(np.diff(first)):
            at = hits[first[d] : first[d + 1]] - bounds[d]
            after = np.cumsum(w[bounds[d] : bounds[d + 1]])
            right = after[at]
            out[d] = [(s, int(at[a]), int(at[b])) for s, a, b in maximal_segments((right - w[bounds[d] + at]).tolist(), right.tolist())]
            best[d] = max(s for s, *_ in out[d])
        return best.tolist(), n.tolist(), out

    def segments(self, text: pa.Array) -> list[list[tuple[float, int, int]]]:
        """For each text its maximal segments as (nats, first word, last word); a text without any has the chance 1 and less the worse its best word is."""
        out = []
        for best, n, found in zip(*self.best_and_segments(text)):
            level = self.log_k + math.log(max(n, 1))
            out.append([(self.lam * s - level, a, b) for s, a, b in found] or ([(self.lam * best, -1, -1)] if n else []))
        return out

    def evidence(self, text: pa.Array) -> np.ndarray:
        return np.array([evidence_of([x for x, *_ in found]) for found in self.segments(text)], float)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * scaled(evidence), -50, 50)))


def scaled(evidence: np.ndarray) -> np.ndarray:
    """Evidence as the logistic fit takes it: beyond 50 nats more of it adds nothing."""
    return np.clip(evidence, -10.0, 50.0)


def token_score(alpha: float, certainty: float, n: dict[str, float]) -> Column:
    """The score of a token from ``bad`` and ``good``, the numbers of toxic and other texts that hold it.

    ``n``: sums of both over all tokens. ``alpha``: mass of the Dirichlet prior as a share of all counts; a token's prior is
    its share of the pooled counts.
    """
    a = alpha * (F.col("bad") + F.col("good"))
    mass = alpha * (n["bad"] + n["good"])
    # the prior deals a token's mass to the classes as all mass is dealt
    b, g = F.col("bad") + a * (n["bad"] / (n["bad"] + n["good"])), F.col("good") + a * (n["good"] / (n["bad"] + n["good"]))
    odds = F.log(b / (n["bad"] + mass * n["bad"] / (n["bad"] + n["good"]) - b)) - F.log(g / (n["good"] + mass * n["good"] / (n["bad"] + n["good"]) - g))
    return F.signum(odds) * F.greatest(F.abs(odds) - certainty * F.sqrt(1 / b + 1 / g), F.lit(0.0))


def extreme_value_fit(best: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """lambda and ln K of the law of best segments: ``exp(-K * n * exp(-lambda * S))`` is the chance that n words have none above S.

    By maximum likelihood; of a text without a positive segment only that is known.
    """
    seen = best > 0
    n, s = words[seen], best[seen]
    none = float(words[~seen].sum())
    if not seen.any():
        return 1.0, -math.log(none + 1)

    def fitted(lam: float) -> tuple[float, float]:
        log_k = math.log(len(s)) - math.log(none + float((n * np.exp(-lam * s)).sum()))
        return len(s) * (math.log(lam) + log_k) - lam * float(s.sum()) - len(s), log_k

    grid = np.exp(np.linspace(math.log(0.02), math.log(20.0), 200))
    lam = float(grid[int(np.argmax([fitted(x)[0] for x in grid]))])
    return lam, fitted(lam)[1]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope of a one-feature logistic fit by Newton's method."""
    w = np.zeros(2)
    X = np.column_stack([np.ones_like(x), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -50, 50)))
        h = (X * (p * (1 - p))[:, None]).T @ X + ridge * np.eye(2)
        step = np.linalg.solve(h, X.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


#: Tokens with a score other than 0 that a model holds at most.
TABLE_TOKENS = 5_000_000


def train_toxicity(labelled: DataFrame, train_limit: int = 40_000, alpha: float = 0.02, certainty: float = 2.5, cost: float = 0.5) -> ToxicModel:
    """Fit on ``labelled`` (``id``, ``text``, ``toxic`` 0 or 1)."""
    spark = labelled.sparkSession
    # One text of each group of near copies: words of a text that was copied often must not look like evidence.
    keyed = labelled.where("toxic in (0, 1)").select(F.col("id"), F.col("text"), F.col("toxic").cast("int").alias("toxic"))
    sketched = keyed.mapInArrow(with_sketch, f"id {dict(labelled.dtypes)['id']}, text string, toxic int, sketch long")
    rows = written(sketched.groupBy("sketch", "toxic").agg(F.min_by("text", F.struct("id", "text")).alias("text")), "toxic-train")
    rows = hashed_share(rows, "sketch", train_limit, rows.count())
    counts = written(rows.select("text", "toxic").mapInArrow(token_counts, "token string, bad long, good long").where("token <> ''").groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "toxic-tokens")
    sums = counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first().asDict()
    if not (sums["bad"] and sums["good"]):
        return ToxicModel()
    scored = counts.select("token", token_score(alpha, certainty, sums).cast("float").alias("score")).where("score <> 0").limit(TABLE_TOKENS + 1).toArrow()
    if scored.num_rows > TABLE_TOKENS:
        raise ValueError("the training texts hold too many tokens for a table in memory; choose a smaller train_limit")
    model = ToxicModel(tokens=scored.column("token").combine_chunks().cast(pa.string()), scores=scored.column("score").to_numpy(), cost=cost)
    shared = spark.sparkContext.broadcast(model)
    # one row a training text, bounded by train_limit
    found = rows.select("text", "toxic").mapInArrow(_bests_of_training(shared), "toxic int, best double, words long, others array<double>").toArrow()
    toxic, best, words = (found.column(c).to_numpy() for c in ("toxic", "best", "words"))
    full = words > 0
    other = full & (toxic == 0)
    if not other.any() or not (toxic[full] == 1).any():
        return ToxicModel()
    model.lam, model.log_k = extreme_value_fit(best[other], words[other].astype(float))
    evidence = np.array([evidence_of([model.lam * s - model.log_k - math.log(n) for s in others] or [model.lam * b]) for b, n, others in zip(best[full], words[full], itertools.compress(found.column("others").to_pylist(), full))])
    model.intercept, model.slope = logistic(scaled(evidence), toxic[full].astype(float))
    model.slope = max(model.slope, 0.0)
    return model


def _bests_of_training(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch, "text"):
                best, words, found = shared.value.best_and_segments(column(step, "text"))
                others = pa.array([[s for s, *_ in segments] for segments in found], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([column(step, "toxic"), pa.array(best, pa.float64()), pa.array(words, pa.int64()), others], names=["toxic", "best", "words", "others"])

    return run


def hashed_share(df: DataFrame, key: str, limit: int, of: int) -> DataFrame:
    """About ``limit`` of the ``of`` rows of ``df``, the same ones each time, by a hash of ``key``."""
    if of <= limit:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 20)) < int(limit / of * (1 << 20)))


def score_toxicity(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Probability and segments of each whole text.

    Returns ``doc_id``, ``score`` (0 to 1), ``evidence``, ``segments`` (array of struct of
    first and last word and nats: the significant ones).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        m = shared.value
        kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("nats", pa.float64())]))
        for batch in batches:
            for step in text_steps(batch, "text"):
                found = m.segments(column(step, "text"))
                evidence = np.array([evidence_of([x for x, *_ in f]) for f in found], float)
                spans = pa.array([[{"first_word": a, "last_word": b, "nats": x} for x, a, b in f if x > 0 and a >= 0] for f in found], kind)
                yield pa.RecordBatch.from_arrays([column(step, "doc_id"), pa.array(m.probability(evidence)), pa.array(evidence), spans], names=["doc_id", "score", "evidence", "segments"])

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, score double, evidence double, segments array<struct<first_word: bigint, last_word: bigint, nats: double>>"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def learnt(docs: DataFrame, labels: DataFrame, train_limit: int, held_out: int, folds: int) -> ToxicModel:
    usable = labels.select("doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").where(fold(folds) != held_out)
    usable = usable.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most")
    with tables(docs.sparkSession):
        usable = written(usable, "toxic-labels")
        # about train_limit ids, one row each, whatever the input, so that the texts need no shuffle
        chosen = hashed_share(usable, "doc_id", train_limit, usable.count())
        train = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").alias("id"), "text", "toxic")
        return train_toxicity(train, train_limit)


def fold(folds: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def toxicity(docs: DataFrame, labels: DataFrame, train_limit: int = 40_000, held_out: int = 2, folds: int = 4) -> DataFrame:
    """Scores of ``docs`` by a model learnt from ``labels`` (``doc_id``, ``toxic``) outside fold ``held_out``.

    The fold of an id is crc32 of its decimal text modulo ``folds``. Returns score_toxicity's columns and ``held_out``.
    """
    scored = score_toxicity(docs, learnt(docs, labels, train_limit, held_out, folds))
    return scored.withColumn("held_out", F.coalesce(fold(folds) == held_out, F.lit(False)))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, train_limit: int = 40_000, held_out: int = 2, folds: int = 4) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(learnt(docs, labels, train_limit, held_out, folds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        m = shared.value
        for batch in batches:
            for step in text_steps(batch, "text"):
                yield step.filter(pa.array(m.probability(m.evidence(column(step, "text"))) < threshold))

    return docs.mapInArrow(run, docs.schema)
