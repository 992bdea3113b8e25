"""Review, evaluation bookkeeping and reports on small tables."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import evaluation, reports, review
from plumbline.sources import state

PREDICTION = "left_key string, right_key string, model_version string, probability double, predicted_label string"


def test_prediction_upsert_keeps_other_versions(spark):
    old = spark.createDataFrame([("a", "b", "v1", 0.2, "distinct"), ("a", "b", "v2", 0.3, "distinct")], PREDICTION)
    new = spark.createDataFrame([("a", "b", "v2", 0.9, "merge"), ("a", "b", "v2", 0.8, "merge"), ("c", "d", "v2", 0.5, "merge")], PREDICTION)
    assert sorted(map(tuple, evaluation.upserted_predictions(old, new).collect())) == [("a", "b", "v1", 0.2, "distinct"), ("a", "b", "v2", 0.9, "merge"), ("c", "d", "v2", 0.5, "merge")]


def test_frozen_versions_refuse(spark):
    kind = "model_version string, coefficients string, metrics_summary string"
    old = spark.createDataFrame([("v1", "x", "done"), ("v2", "y", None)], kind)
    with pytest.raises(state.FrozenVersion):
        evaluation.upserted_registry(old, spark.createDataFrame([("v1", "z", None)], kind))
    got = evaluation.frozen_registry(evaluation.upserted_registry(old, spark.createDataFrame([("v2", "z", None)], kind)), "v2", F.lit("now"))
    assert sorted(map(tuple, got.collect())) == [("v1", "x", "done"), ("v2", "z", "now")]
    assert sorted(r["metrics_summary"] for r in evaluation.frozen_registry(got, "v1", F.lit("again")).collect()) == ["done", "now"]


def test_one_feature_version(spark):
    rows = spark.createDataFrame([("v1",), ("v2",), (None,)], "feature_version string")
    evaluation.assert_one_version(rows.where("feature_version = 'v1' OR feature_version IS NULL"))
    with pytest.raises(evaluation.MixedVersions):
        evaluation.assert_one_version(rows)


def test_metrics_without_a_merge_are_null(spark):
    rows = spark.createDataFrame([("v1", 0.1, "distinct", "distinct"), ("v1", 0.9, "merge", "related")], "model_version string, probability double, predicted_label string, label string")
    m = evaluation.evaluated(rows).first()
    assert (m["n"], m["tn"], m["precision"], m["recall"], m["f1"], m["accuracy"], m["related"], m["related_merged"]) == (1, 1, None, None, None, 1.0, 1, 1)


def test_blockers_count_for_each_reason(spark):
    cand = spark.createDataFrame([("a", "b", ["trigram", "acronym"]), ("c", "d", ["trigram"]), ("e", "f", ["rare_token"])], "left_key string, right_key string, reasons array<string>")
    gold = spark.createDataFrame([("a", "b", "merge"), ("c", "d", "merge"), ("e", "f", "distinct"), ("x", "y", "merge")], "left_key string, right_key string, label string")
    assert {r["blocker"]: tuple(r)[1:] for r in evaluation.blocker_efficiency(gold, cand).collect()} == {"trigram": (2, 2, 1, 1.0), "acronym": (1, 1, 0, 1.0), "rare_token": (1, 0, 0, 0.0)}


def test_lanes(spark):
    p = spark.createDataFrame([("ibm", "international business machines", 0.4), ("a b", "acme", 0.9), ("aa", "bb", 0.6), ("solo", "x", 0.99)], "left_key string, right_key string, probability double")
    c = spark.createDataFrame([("ibm", "international business machines", ["acronym"]), ("a b", "acme", ["acronym"]), ("aa", "bb", ["trigram"])], "left_key string, right_key string, reasons array<string>")
    assert [(r["left_key"], r["priority"]) for r in review.lane(p, c, True, 10).collect()] == [("ibm", 3), ("a b", 2)]
    assert [r["left_key"] for r in review.lane(p, c, False, 10).collect()] == ["aa"]
    assert review.lane(p.where("false"), c, True, 10).count() == 0


def test_decisions_with_conflicts(spark):
    old = spark.createDataFrame([("a",)], "loser_key string")
    new = spark.createDataFrame([("a", "w", 1), ("b", "x", 3), ("b", "y", 2), ("c", "z", 4)], "loser_key string, winner_key string, seq int")
    got = {(r["loser_key"], r["winner_key"]): r["outcome"] for r in review.inserted_decisions(old, new, F.col("seq")).collect()}
    assert got == {("a", "w"): "conflict", ("b", "x"): "conflict", ("b", "y"): "inserted", ("c", "z"): "inserted"}


def test_exports_only_what_labels_lack(spark):
    pairs = spark.createDataFrame([("a", "b", "merge"), ("a", "b", "merge"), ("c", "d", "distinct")], "left_key string, right_key string, label string")
    assert [tuple(r) for r in review.exported(pairs, pairs.where("left_key = 'c'"), 2).collect()] == [("a", "b", "merge", "active_learning", 2)]
    assert sorted(tuple(r) for r in review.open_pairs(pairs, pairs.where("left_key = 'a'")).collect()) == [("c", "d", "distinct")]


def test_hash_rank_is_a_permutation(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    got = [r["rank"] for r in review.hash_rank(rows, F.col("k"), buckets=16).collect()]
    assert sorted(got) == list(range(1, 3001))


def test_progress_by_band(spark):
    p = spark.createDataFrame([("a", "b", 0.9), ("c", "d", 0.6), ("e", "f", None), ("g", "h", 0.1)], "left_key string, right_key string, probability double")
    labels = spark.createDataFrame([("a", "b", "merge")], "left_key string, right_key string, label string")
    assert [tuple(r) for r in review.progress(p, labels, 2).collect()] == [("high", 1, 1, 1, 1), ("medium", 1, 0, 0, 2), ("low", 1, 0, 0, 2), (None, 1, 0, 0, 2)]


def test_rebuild_over_its_own_input(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    state.rebuilt(spark.read.parquet(path).where("id < 5"), path)
    assert spark.read.parquet(path).count() == 5


def test_backfill_and_versions(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "id int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, v string")
    assert sorted(map(tuple, reports.backfilled(rows, source, "id", "v").collect())) == [(1, "a"), (2, "x"), (3, None)]
    same, other = reports.versioned(spark.createDataFrame([("a",), ("b",), (None,)], "version string"), "a")
    assert same.count() == 1 and other.count() == 2


def test_version_is_fitted_evaluated_and_frozen_once(spark):
    from plumbline.functions.similarity import pair_fraction

    rows = spark.range(600).select(F.concat(F.lit("l"), F.col("id").cast("string")).alias("left_key"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("right_key"), F.when(F.col("id") % 3 == 0, "merge").when(F.col("id") % 50 == 1, "related").otherwise("distinct").alias("label"))
    rows = rows.withColumn("x", F.when(F.col("label") == "merge", 1.0).otherwise(0.0) + pair_fraction(F.col("left_key"), F.col("right_key"), "noise"))
    frozen = evaluation.frozen_benchmark(rows)
    registry = spark.createDataFrame([("old", "[]", "done")], "model_version string, coefficients string, metrics_summary string")
    scorer, predictions, after = evaluation.fitted_version(rows, frozen, registry, "v2", ("x",))
    assert scorer.weights["x"] > 0 and predictions.count() == frozen.where("label <> 'related'").count()
    summary = {r["model_version"]: r["metrics_summary"] for r in after.collect()}
    assert summary["old"] == "done" and '"accuracy": 1.0' in summary["v2"]
    with pytest.raises(state.FrozenVersion):
        evaluation.fitted_version(rows, frozen, after, "v2", ("x",))
