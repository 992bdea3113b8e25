"""Pair scorer: standardised logistic regression, Platt calibration, scoring as an expression, evaluation."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.similarity import BINARY, CONTINUOUS, FEATURES


@dataclass
class Scorer:
    """Coefficients over raw features: ``score = intercept + sum(weight * (x - mean) / scale)``; Platt ``a``, ``b``."""

    weights: dict[str, float]
    intercept: float
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    platt_a: float = 1.0
    platt_b: float = 0.0

    def decision(self) -> Column:
        out = F.lit(self.intercept)
        for name, w in self.weights.items():
            x = F.col(name).cast("double")
            if name in self.means:
                x = (x - self.means[name]) / self.scales[name]
            out = out + F.lit(w) * x
        return out

    def probability(self) -> Column:
        return F.round(1 / (1 + F.exp(-(self.platt_a * self.decision() + self.platt_b))), 6)

    def coefficient_table(self) -> list[tuple[str, float]]:
        return sorted(self.weights.items(), key=lambda kv: (-abs(kv[1]), kv[0]))

    def save(self, path: str) -> None:
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            json.dump(asdict(self), f, indent=1, sort_keys=True)


def fit(train: DataFrame, features: tuple[str, ...] = FEATURES, binary: tuple[str, ...] = BINARY, balanced: bool = False, max_iter: int = 1000) -> Scorer:
    """L2-regularised (C = 1) logistic regression on ``features`` and ``label`` (0, 1).

    Continuous features are scaled by the training mean and population deviation. The summed-loss
    objective with C = 1 equals Spark's mean loss with ``regParam = 1 / n``.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    scaled = [c for c in features if c not in binary]
    stats = train.agg(F.count("*").alias("n"), F.sum("label").alias("pos"), *(F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in scaled), *(F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in scaled)).first()
    means, scales = {c: stats[f"m_{c}"] for c in scaled}, {c: stats[f"s_{c}"] or 1.0 for c in scaled}
    n, pos = stats["n"], stats["pos"]
    ready = train.select("label", *(((F.col(c).cast("double") - means[c]) / scales[c]).alias(c) if c in means else F.col(c).cast("double").alias(c) for c in features))
    weight = F.when(F.col("label") == 1, n / (2.0 * max(pos, 1))).otherwise(n / (2.0 * max(n - pos, 1))) if balanced else F.lit(1.0)
    vectors = VectorAssembler(inputCols=list(features), outputCol="_vector").transform(ready.withColumn("_weight", weight).withColumn("label", F.col("label").cast("double")))
    model = LogisticRegression(featuresCol="_vector", labelCol="label", weightCol="_weight", regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-8).fit(vectors)
    return Scorer(dict(zip(features, map(float, model.coefficients))), float(model.intercept), means, scales)


def calibrated(scorer: Scorer, rows: DataFrame) -> Scorer:
    """``scorer`` with Platt's ``a`` and ``b`` from a calibration split (features and ``label``)."""
    one = fit(rows.select(scorer.decision().alias("d"), "label"), features=("d",), binary=("d",))
    return Scorer(scorer.weights, scorer.intercept, scorer.means, scorer.scales, one.weights["d"], one.intercept)


def scored(pairs: DataFrame, scorer: Scorer, version: str) -> DataFrame:
    """Predictions: probability, label at one half, version."""
    p = scorer.probability()
    return pairs.select("left_key", "right_key", p.alias("probability"), F.when(p >= 0.5, "merge").otherwise("distinct").alias("predicted_label"), F.lit(version).alias("model_version"))


def unscored(pairs: DataFrame, predictions: DataFrame, version: str) -> DataFrame:
    """Pairs that a version has not scored yet."""
    return pairs.join(predictions.where(F.col("model_version") == version).select("left_key", "right_key"), ["left_key", "right_key"], "left_anti")


# --- evaluation --------------------------------------------------------------------------------------


def confusion(actual: Column, predicted: Column) -> list[Column]:
    """tp, fp, fn, tn, precision, recall, f1 (null on a zero divisor), accuracy; booleans in."""
    tp, fp, fn, tn = (F.count_if(c) for c in (actual & predicted, ~actual & predicted, actual & ~predicted, ~actual & ~predicted))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return [
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), F.round(precision, 4).alias("precision"), F.round(recall, 4).alias("recall"),
        F.round(F.try_divide(2 * precision * recall, precision + recall), 4).alias("f1"), F.round(F.try_divide(tp + tn, F.count("*")), 4).alias("accuracy"),
    ]


def brier(p: Column, y: Column) -> Column:
    return F.avg((p - y) * (p - y))


def provenance(rows: DataFrame) -> DataFrame:
    """Confusion per blocker; a pair counts for each of its reasons. ``rows``: reasons, label, predicted_label."""
    return rows.select(F.explode("reasons").alias("reason"), "label", "predicted_label").groupBy("reason").agg(*confusion(F.col("label") == "merge", F.col("predicted_label") == "merge"))


def reliability(rows: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width bins of ``p`` with counts, means and observed share; the last bin is closed, empty bins are null."""
    spark = rows.sparkSession
    found = rows.groupBy(F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("p"), 4).alias("mean_p"), F.round(F.avg("y"), 4).alias("observed"))
    return spark.range(bins).select(F.col("id").cast("int").alias("bin")).join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "mean_p", "observed")


def false_negatives(rows: DataFrame) -> DataFrame:
    return rows.where("label = 'merge' and predicted_label = 'distinct'")


def class_counts(rows: DataFrame, labels: tuple[str, ...] = ("merge", "distinct")) -> DataFrame:
    return rows.groupBy("split").pivot("label", list(labels)).count().na.fill(0)


def blocker_recall(gold: DataFrame, candidates: DataFrame, organizations: DataFrame) -> DataFrame:
    """Recall of blocking over gold pairs: one row of counts and percentages.

    A missed merge is a gap of the blockers if both keys exist, else a missing organisation.
    """
    keys = organizations.select("key").distinct()
    known = gold.join(candidates.select("left_key", "right_key", "reasons"), ["left_key", "right_key"], "left")
    known = known.join(keys.select(F.col("key").alias("left_key"), F.lit(True).alias("l")), "left_key", "left").join(keys.select(F.col("key").alias("right_key"), F.lit(True).alias("r")), "right_key", "left")
    merge, found, both = F.col("label") == "merge", F.col("reasons").isNotNull(), F.col("l").isNotNull() & F.col("r").isNotNull()
    hit, gap, gone = F.count_if(merge & found), F.count_if(merge & ~found & both), F.count_if(merge & ~found & ~both)
    return known.agg(
        F.count_if(merge).alias("merges"), hit.alias("found"), gap.alias("blocking_gap"), gone.alias("missing_org"), F.round(F.try_divide(100.0 * hit, hit + gap), 2).alias("achievable_pct"),
        F.round(F.try_divide(100.0 * hit, F.count_if(merge)), 2).alias("overall_pct"), F.count_if((F.col("label") == "distinct") & found).alias("distinct_surfaced"), F.count_if(merge & (F.size("reasons") == 1)).alias("marginal"),
    )


# --- frozen benchmark --------------------------------------------------------------------------------


class Contaminated(RuntimeError):
    """Training pairs stand in the frozen benchmark."""


def contamination(training: DataFrame, frozen: DataFrame) -> DataFrame:
    return training.select("left_key", "right_key").distinct().join(frozen.select("left_key", "right_key"), ["left_key", "right_key"], "left_semi")


def assert_clean(training: DataFrame, frozen: DataFrame) -> None:
    if contamination(training, frozen).limit(1).count():
        raise Contaminated("training pairs are part of the frozen benchmark")


def digest(pairs: DataFrame) -> DataFrame:
    """SHA-256 of the sorted benchmark lines; a benchmark is a small reviewed table."""
    line = F.concat(F.col("left_key"), F.lit("\0"), F.col("right_key"), F.lit("\0"), F.col("label"), F.lit("\n"))
    return pairs.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ""), 256).alias("digest"), F.count("*").alias("n"))


def verified(frozen: DataFrame, current: DataFrame) -> DataFrame:
    """Counts of benchmark pairs that were relabelled, dropped, or are new in the reserved split."""
    both = frozen.select("left_key", "right_key", F.col("label").alias("old")).join(current.select("left_key", "right_key", F.col("label").alias("new")), ["left_key", "right_key"], "full_outer")
    return both.agg(F.count_if(F.col("old") != F.col("new")).alias("relabelled"), F.count_if(F.col("new").isNull()).alias("dropped"), F.count_if(F.col("old").isNull()).alias("reserved_new"), F.count_if(F.col("old") == F.col("new")).alias("unchanged"))


# --- active learning ---------------------------------------------------------------------------------


def selected_queue(pairs: DataFrame, limit: int, random_fraction: float, fraction: Column) -> DataFrame:
    """The most uncertain pairs and a random part by hash ``fraction`` of the rest, tagged."""
    n_random = int(limit * random_fraction)
    ranked = pairs.withColumn("fraction", fraction).orderBy(F.abs(F.col("probability") - 0.5), "left_key", "right_key").limit(limit - n_random).withColumn("strategy", F.lit("uncertainty"))
    rest = pairs.withColumn("fraction", fraction).join(ranked.select("left_key", "right_key"), ["left_key", "right_key"], "left_anti")
    return ranked.unionByName(rest.orderBy("fraction", "left_key", "right_key").limit(n_random).withColumn("strategy", F.lit("random")))


def eligible(pairs: DataFrame, decisions: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Pairs of which neither key has lost a decision and that nobody reviewed."""
    losers = decisions.select("loser_key").distinct()
    out = pairs.join(losers.select(F.col("loser_key").alias("left_key")), "left_key", "left_anti").join(losers.select(F.col("loser_key").alias("right_key")), "right_key", "left_anti")
    return out.join(reviewed.select("left_key", "right_key"), ["left_key", "right_key"], "left_anti")


assert set(CONTINUOUS) | set(BINARY) == set(FEATURES)
