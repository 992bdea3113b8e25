"""Scorer bookkeeping: data sets with their splits, evaluation, blocker efficiency, registry and predictions.

Defined results: pairs labelled neither merge nor distinct take no part in training and evaluation; metrics
without a denominator are null; empty tables give counts of 0.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.similarity import SPLIT_V1, SPLIT_V2, assigned_split, pair_fraction
from plumbline.operators.scoring import Scorer, assert_clean, brier, calibrated, confusion, fit, scored
from plumbline.sources.state import FrozenVersion, guard_frozen

PAIR = ["left_key", "right_key"]
TRAINED = ("merge", "distinct")


class MixedVersions(RuntimeError):
    """Stored features of several versions must not train one scorer."""


def dataset(gold: DataFrame, stored: DataFrame, computed: dict[str, Column]) -> DataFrame:
    """Labelled pairs with stored features, or computed ones where none are stored, and their hash split.

    ``stored``: pair, ``feature_version`` and the features; ``computed``: feature to expression over the keys. ``fallback`` tells
    which rows were computed.
    """
    known = gold.where(F.col("label").isin(*TRAINED)).join(stored, PAIR, "left")
    features = [F.coalesce(F.col(name), value).alias(name) for name, value in computed.items()]
    return known.select(*PAIR, "label", "feature_version", F.col("feature_version").isNull().alias("fallback"), *features, assigned_split(pair_fraction(F.col("left_key"), F.col("right_key")), SPLIT_V1).alias("split"))


def assert_one_version(rows: DataFrame) -> None:
    found = [r[0] for r in rows.where("feature_version IS NOT NULL").select("feature_version").distinct().limit(2).collect()]
    if len(found) > 1:
        raise MixedVersions(", ".join(sorted(map(str, found))))


def frozen_benchmark(gold: DataFrame) -> DataFrame:
    """Labelled pairs that hash into the evaluation split, in order."""
    split = assigned_split(pair_fraction(F.col("left_key"), F.col("right_key")), SPLIT_V1)
    return gold.where(split == "evaluation").select(*PAIR, "label").orderBy(*PAIR)


def second_dataset(rows: DataFrame, frozen: DataFrame) -> DataFrame:
    """Splits of the second version: frozen pairs evaluate, the others are dealt by the salted hash; missing provenance is manual, round 0."""
    flagged = rows.join(frozen.select(*PAIR, F.lit(True).alias("_frozen")).distinct(), PAIR, "left")
    split = F.when(F.col("_frozen"), "evaluation").otherwise(assigned_split(pair_fraction(F.col("left_key"), F.col("right_key"), "split_v2"), SPLIT_V2))
    return flagged.select(*PAIR, "label", split.alias("split"), F.coalesce("provenance", F.lit("manual")).alias("provenance"), F.coalesce("round", F.lit(0)).alias("round"))


def with_reasons(predictions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Predictions with the reasons of their candidate; none where there is no candidate."""
    return predictions.join(candidates.select(*PAIR, "reasons"), PAIR, "left").withColumn("reasons", F.coalesce("reasons", F.array().cast("array<string>")))


def judged(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """Predictions of labelled pairs of the evaluation split."""
    return predictions.join(gold.select(*PAIR, "label"), PAIR).where(assigned_split(pair_fraction(F.col("left_key"), F.col("right_key")), SPLIT_V1) == "evaluation")


def evaluated(rows: DataFrame) -> DataFrame:
    """One row of metrics per model version over judged rows; related pairs are only counted."""
    merge, said = F.col("label") == "merge", F.col("predicted_label") == "merge"
    trained = F.col("label").isin(*TRAINED)
    metrics = rows.where(trained).groupBy("model_version").agg(F.count("*").alias("n"), *confusion(merge, said), F.round(brier(F.col("probability"), merge.cast("double")), 4).alias("brier"))
    related = rows.where("label = 'related'").groupBy("model_version").agg(F.count("*").alias("related"), F.count_if(said).alias("related_merged"))
    return metrics.join(related, "model_version", "left").na.fill(0, ["related", "related_merged"])


def deltas(metrics: DataFrame, base: str, names: tuple[str, ...] = ("precision", "recall", "f1", "brier")) -> DataFrame:
    """Metrics of every version beside those of ``base``, a row for each metric."""
    long = metrics.select("model_version", F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names))).alias("m")).select("model_version", "m.*")
    old = long.where(F.col("model_version") == base).select("metric", F.col("value").alias("base"))
    return long.where(F.col("model_version") != base).join(F.broadcast(old), "metric").select("model_version", "metric", "base", "value", F.round(F.col("value") - F.col("base"), 4).alias("delta"))


def fitted_version(rows: DataFrame, frozen: DataFrame, registry: DataFrame, version: str, features: tuple[str, ...], binary: tuple[str, ...] = ()) -> tuple[Scorer, DataFrame, DataFrame]:
    """Fit, calibrate and evaluate a version: (scorer, its predictions of the frozen pairs, the registry with its summary).

    ``rows``: pairs with label and features. Refuses versions that have a summary, and training pairs that are frozen. The frozen pairs
    evaluate; the others train and calibrate by the salted hash.
    """
    guard_frozen(registry, version)
    dealt = second_dataset(rows.withColumn("provenance", F.lit(None).cast("string")).withColumn("round", F.lit(None).cast("int")), frozen).select(*PAIR, "split")
    data = rows.where(F.col("label").isin(*TRAINED)).withColumn("y", (F.col("label") == "merge").cast("int")).join(dealt, PAIR)
    part = lambda name: data.where(F.col("split") == name).drop("label").withColumnRenamed("y", "label")
    assert_clean(part("train"), frozen)
    scorer = calibrated(fit(part("train"), features, binary), part("calibration"))
    held = data.where(F.col("split") == "evaluation").select(*PAIR, *features)
    predictions = scored(held, scorer, version)
    metrics = evaluated(predictions.join(frozen.select(*PAIR, "label"), PAIR))
    summary = F.lit(json.dumps({c: v for c, v in metrics.first().asDict().items() if c != "model_version"}, sort_keys=True))
    known = registry if registry.where(F.col("model_version") == version).limit(1).count() else registry.unionByName(registry.sparkSession.createDataFrame([(version, json.dumps(scorer.coefficient_table()), None)], "model_version string, coefficients string, metrics_summary string"))
    return scorer, predictions, frozen_registry(known, version, summary)


def blocker_efficiency(gold: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per blocker: merges found, those that it alone finds, pairs emitted, and merges per pair; a pair counts for each of its reasons."""
    emitted = candidates.select(F.explode("reasons").alias("blocker")).groupBy("blocker").agg(F.count("*").alias("emitted"))
    hits = gold.where("label = 'merge'").join(candidates.select(*PAIR, "reasons"), PAIR)
    found = hits.select(F.explode("reasons").alias("blocker"), (F.size("reasons") == 1).alias("alone")).groupBy("blocker").agg(F.count("*").alias("found"), F.count_if("alone").alias("marginal"))
    return emitted.join(found, "blocker", "left").na.fill(0, ["found", "marginal"]).withColumn("efficiency", F.round(F.col("found") / F.col("emitted"), 4))


def upserted_predictions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Predictions by pair and version, new ones in place of old; of several new ones the most probable stays."""
    keys = [*PAIR, "model_version"]
    fresh = new.groupBy(*keys).agg(F.max_by(F.struct("probability", "predicted_label"), F.struct("probability", "predicted_label")).alias("p")).select(*keys, "p.*")
    return old.select(*keys, "probability", "predicted_label").join(fresh, keys, "left_anti").unionByName(fresh)


def upserted_registry(old: DataFrame, new: DataFrame) -> DataFrame:
    """Registry rows by model version, new ones in place of old; a version with a metrics summary is frozen and raises."""
    frozen = old.where("metrics_summary IS NOT NULL").join(new, "model_version", "left_semi").select("model_version").limit(1).collect()
    if frozen:
        raise FrozenVersion(frozen[0][0])
    return old.join(new, "model_version", "left_anti").unionByName(new)


def frozen_registry(registry: DataFrame, version: str, summary: Column) -> DataFrame:
    """The registry with ``summary`` written for ``version``, once: a summary that is there stays."""
    return registry.withColumn("metrics_summary", F.when(F.col("model_version") == version, F.coalesce("metrics_summary", summary)).otherwise(F.col("metrics_summary")))


def rebuilt_candidates(predictions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Predictions after the candidates were rebuilt: they stay by their pair, and point to a candidate or to none."""
    return predictions.drop("candidate_id").join(candidates.select(*PAIR, "candidate_id"), PAIR, "left")


def finite(value: Column) -> Column:
    """Null in place of NaN."""
    return F.nanvl(value, F.lit(None).cast("double"))
