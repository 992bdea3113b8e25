"""Queries of review, scorer bookkeeping and reports.

Pairs are made from orders (customer and order), with a probability by their hash; labels, reasons and
features follow from the order's number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import similarity as sim
from plumbline.operators import evaluation, reports, review
from plumbline.plans.matching_plans import _frac
from plumbline.sources.tables import RECOGNITIONS_SQL, recognitions, table

QUERIES, SQL = {}, {}

CTE = {
    "pred": f"pred AS (SELECT 'c' || o_custkey AS left_key, 'o' || o_orderkey AS right_key, round({_frac('')}, 6) AS probability, {_frac('')} AS f, o_orderkey AS k, 'v1' AS model_version FROM orders)",
    "said": "said AS (SELECT *, CASE WHEN probability >= 0.5 THEN 'merge' ELSE 'distinct' END AS predicted_label FROM pred)",
    "gold": "gold AS (SELECT left_key, right_key, CASE k % 5 WHEN 0 THEN 'merge' WHEN 1 THEN 'related' ELSE 'distinct' END AS label, f, k FROM pred WHERE k % 3 = 0)",
    "cand": "cand AS (SELECT left_key, right_key, CASE WHEN k % 7 = 0 THEN ['rare_token'] WHEN k % 2 = 0 THEN ['acronym', 'trigram'] ELSE ['trigram'] END AS reasons, k AS candidate_id FROM pred WHERE k % 4 <> 3)",
    "frozen": "frozen AS (SELECT left_key, right_key, label FROM gold WHERE f >= 0.8)",
    "recognitions": RECOGNITIONS_SQL.strip(),
}
_SPLIT = "CASE WHEN f < 0.6 THEN 'train' WHEN f < 0.8 THEN 'calibration' ELSE 'evaluation' END"


def query(name: str, sql: str, *ctes: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = (f"WITH {', '.join(CTE[c] for c in ctes)} " if ctes else "") + sql
        return f

    return add


def _pred(spark, d):
    left, right = F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    p = table(spark, d, "orders").select(left.alias("left_key"), right.alias("right_key"), F.col("o_orderkey").alias("k"))
    p = p.withColumn("probability", F.round(sim.pair_fraction(F.col("left_key"), F.col("right_key")), 6))
    return p.withColumn("predicted_label", F.when(F.col("probability") >= 0.5, "merge").otherwise("distinct")).withColumn("model_version", F.lit("v1"))


def _gold(spark, d):
    label = F.when(F.col("k") % 5 == 0, "merge").when(F.col("k") % 5 == 1, "related").otherwise("distinct")
    return _pred(spark, d).where("k % 3 = 0").select("left_key", "right_key", label.alias("label"), "k")


def _cand(spark, d):
    reasons = F.when(F.col("k") % 7 == 0, F.array(F.lit("rare_token"))).when(F.col("k") % 2 == 0, F.array(F.lit("acronym"), F.lit("trigram"))).otherwise(F.array(F.lit("trigram")))
    return _pred(spark, d).where("k % 4 <> 3").select("left_key", "right_key", reasons.alias("reasons"), F.col("k").alias("candidate_id"))


@query("prediction_upsert", """, old AS (SELECT left_key, right_key, model_version, probability, predicted_label FROM said WHERE k % 2 = 0),
 fresh AS (SELECT left_key, right_key, v AS model_version, round(1 - probability, 6) AS probability, CASE WHEN round(1 - probability, 6) >= 0.5 THEN 'merge' ELSE 'distinct' END AS predicted_label FROM said, (VALUES ('v1'), ('v2')) x(v) WHERE k % 3 = 0)
 SELECT * FROM old WHERE (left_key, right_key, model_version) NOT IN (SELECT left_key, right_key, model_version FROM fresh) UNION ALL SELECT * FROM fresh""", "pred", "said")
def prediction_upsert(spark, d):
    p = _pred(spark, d)
    new = p.where("k % 3 = 0").withColumn("probability", F.round(1 - F.col("probability"), 6)).withColumn("predicted_label", F.when(F.col("probability") >= 0.5, "merge").otherwise("distinct"))
    new = new.withColumn("model_version", F.explode(F.array(F.lit("v1"), F.lit("v2"))))
    return evaluation.upserted_predictions(p.where("k % 2 = 0"), new)





@query("registry_upsert", """SELECT 'm' || n_nationkey AS model_version, CASE WHEN n_nationkey % 2 = 0 THEN 'refit' ELSE n_name END AS coefficients, CASE WHEN n_nationkey % 2 = 1 AND n_regionkey = 0 THEN 'frozen' WHEN n_nationkey = 2 THEN 'summary' END AS metrics_summary FROM nation
 WHERE NOT (n_nationkey % 2 = 0 AND n_nationkey > 20) UNION ALL SELECT 'm' || n_nationkey, 'refit', NULL FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey > 20""")
def registry_upsert(spark, d):
    """Even versions are fitted anew, odd ones of one region are frozen, and one is frozen afterwards."""
    version = F.concat(F.lit("m"), F.col("n_nationkey").cast("string")).alias("model_version")
    n = table(spark, d, "nation")
    old = n.where("n_nationkey <= 20 OR n_nationkey % 2 = 1").select(version, F.col("n_name").alias("coefficients"), F.when((F.col("n_nationkey") % 2 == 1) & (F.col("n_regionkey") == 0), "frozen").alias("metrics_summary"))
    new = n.where("n_nationkey % 2 = 0").select(version, F.lit("refit").alias("coefficients"), F.lit(None).cast("string").alias("metrics_summary"))
    return evaluation.frozen_registry(evaluation.upserted_registry(old, new), "m2", F.lit("summary"))


_METRICS = """SELECT model_version, count(*) FILTER (WHERE t) AS n, count(*) FILTER (WHERE t AND a AND p) AS tp, count(*) FILTER (WHERE t AND NOT a AND p) AS fp, count(*) FILTER (WHERE t AND a AND NOT p) AS fn, count(*) FILTER (WHERE t AND NOT a AND NOT p) AS tn,
 round(sum(CASE WHEN t AND a AND p THEN 1 ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN t AND p THEN 1 ELSE 0 END), 0), 4) AS precision, round(sum(CASE WHEN t AND a AND p THEN 1 ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN t AND a THEN 1 ELSE 0 END), 0), 4) AS recall,
 CASE WHEN sum(CASE WHEN t AND a AND p THEN 1 ELSE 0 END) > 0 THEN round(2.0 * sum(CASE WHEN t AND a AND p THEN 1 ELSE 0 END) / (sum(CASE WHEN t AND p THEN 1 ELSE 0 END) + sum(CASE WHEN t AND a THEN 1 ELSE 0 END)), 4) END AS f1, round(sum(CASE WHEN t AND a = p THEN 1 ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN t THEN 1 ELSE 0 END), 0), 4) AS accuracy,
 round(avg(CASE WHEN t THEN (probability - CASE WHEN a THEN 1 ELSE 0 END) * (probability - CASE WHEN a THEN 1 ELSE 0 END) END), 4) AS brier, count(*) FILTER (WHERE NOT t) AS related, count(*) FILTER (WHERE NOT t AND p) AS related_merged
 FROM (SELECT model_version, probability, predicted_label = 'merge' AS p, label = 'merge' AS a, label <> 'related' AS t FROM versions JOIN gold USING (left_key, right_key) WHERE versions.f >= 0.8) GROUP BY model_version"""
CTE["versions"] = "versions AS (SELECT left_key, right_key, probability, predicted_label, f, model_version FROM said UNION ALL SELECT left_key, right_key, round(1 - probability, 6), CASE WHEN round(1 - probability, 6) >= 0.5 THEN 'merge' ELSE 'distinct' END, f, 'v2' FROM said)"


def _versions(spark, d):
    p = _pred(spark, d)
    other = p.withColumn("probability", F.round(1 - F.col("probability"), 6)).withColumn("predicted_label", F.when(F.col("probability") >= 0.5, "merge").otherwise("distinct")).withColumn("model_version", F.lit("v2"))
    return p.unionByName(other)


@query("evaluation_metrics", _METRICS, "pred", "said", "gold", "versions")
def evaluation_metrics(spark, d):
    return evaluation.evaluated(evaluation.judged(_versions(spark, d), _gold(spark, d)))


@query("ab_deltas", f", m AS ({_METRICS}), l AS (SELECT model_version, unnest(['precision', 'recall', 'f1', 'brier']) AS metric, unnest([precision, recall, f1, brier]) AS value FROM m) SELECT l.model_version, l.metric, b.value AS base, l.value, round(l.value - b.value, 4) AS delta FROM l JOIN l b ON b.metric = l.metric AND b.model_version = 'v1' WHERE l.model_version <> 'v1'", "pred", "said", "gold", "versions")
def ab_deltas(spark, d):
    return evaluation.deltas(evaluation_metrics(spark, d), "v1")


@query("evaluation_by_reason", """SELECT reason, count(*) FILTER (WHERE a) AS merges, count(*) FILTER (WHERE a AND p) AS found FROM (SELECT unnest(CASE WHEN len(coalesce(reasons, [])) = 0 THEN ['none'] ELSE reasons END) AS reason, label = 'merge' AS a, predicted_label = 'merge' AS p
 FROM said JOIN gold USING (left_key, right_key) LEFT JOIN cand USING (left_key, right_key)) GROUP BY reason""", "pred", "said", "gold", "cand")
def evaluation_by_reason(spark, d):
    rows = evaluation.with_reasons(_pred(spark, d).join(_gold(spark, d).drop("k"), evaluation.PAIR), _cand(spark, d))
    reason = F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("none"))).otherwise(F.col("reasons")))
    merge = F.col("label") == "merge"
    return rows.select(reason.alias("reason"), "label", "predicted_label").groupBy("reason").agg(F.count_if(merge).alias("merges"), F.count_if(merge & (F.col("predicted_label") == "merge")).alias("found"))


@query("gold_dataset", f"""SELECT left_key, right_key, label, CASE WHEN k % 4 <> 3 THEN 'f3' END AS feature_version, k % 4 = 3 AS fallback, CASE WHEN k % 4 <> 3 THEN round((k % 100) / 100.0, 4) ELSE round(least(length(left_key), length(right_key))::DOUBLE / greatest(length(left_key), length(right_key)), 4) END::DOUBLE AS length_ratio, {_SPLIT} AS split
 FROM gold WHERE label <> 'related'""", "pred", "gold")
def gold_dataset(spark, d):
    ratio = F.round(F.least(F.length("left_key"), F.length("right_key")) / F.greatest(F.length("left_key"), F.length("right_key")), 4)
    stored = _pred(spark, d).where("k % 4 <> 3").select("left_key", "right_key", F.lit("f3").alias("feature_version"), F.round(F.col("k") % 100 / 100.0, 4).cast("double").alias("length_ratio"))
    return evaluation.dataset(_gold(spark, d), stored, {"length_ratio": ratio})


@query("frozen_benchmark", "SELECT * FROM frozen", "pred", "gold", "frozen")
def frozen_benchmark(spark, d):
    return evaluation.frozen_benchmark(_gold(spark, d))


_F2 = "CAST(CAST('0x' || left(sha256('split_v2' || chr(0) || left_key || chr(0) || right_key), 16) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0"


@query("second_dataset", f"""SELECT left_key, right_key, label, CASE WHEN (left_key, right_key) IN (SELECT left_key, right_key FROM frozen) THEN 'evaluation' WHEN {_F2} < 0.7 THEN 'train' WHEN {_F2} < {0.7 + 0.15!r} THEN 'calibration' ELSE 'validation' END AS split,
 CASE WHEN k % 2 = 0 THEN 'active_learning' ELSE 'manual' END AS provenance, CASE WHEN k % 2 = 0 THEN 2 ELSE 0 END AS round FROM gold""", "pred", "gold", "frozen")
def second_dataset(spark, d):
    g = _gold(spark, d)
    rows = g.withColumn("provenance", F.when(F.col("k") % 2 == 0, "active_learning")).withColumn("round", F.when(F.col("k") % 2 == 0, 2))
    return evaluation.second_dataset(rows, evaluation.frozen_benchmark(g))


@query("label_export", "SELECT left_key, right_key, predicted_label AS label, 'active_learning' AS provenance, 4 AS round FROM said WHERE k % 2 = 0 AND k % 3 <> 0", "pred", "said")
def label_export(spark, d):
    decided = _pred(spark, d).where("k % 2 = 0").select("left_key", "right_key", F.col("predicted_label").alias("label"))
    return review.exported(decided.union(decided), _gold(spark, d), 4)


@query("blocker_efficiency", """SELECT blocker, emitted, coalesce(found, 0) AS found, coalesce(marginal, 0) AS marginal, round(coalesce(found, 0)::DOUBLE / emitted, 4) AS efficiency FROM (SELECT blocker, count(*) AS emitted FROM (SELECT unnest(reasons) AS blocker FROM cand) GROUP BY 1)
 LEFT JOIN (SELECT blocker, count(*) AS found, count(*) FILTER (WHERE alone) AS marginal FROM (SELECT unnest(reasons) AS blocker, len(reasons) = 1 AS alone FROM cand JOIN gold USING (left_key, right_key) WHERE label = 'merge') GROUP BY 1) USING (blocker)""", "pred", "gold", "cand")
def blocker_efficiency(spark, d):
    return evaluation.blocker_efficiency(_gold(spark, d), _cand(spark, d))


def _lane_sql(cond: str, order: str) -> str:
    return f"SELECT left_key, right_key, probability, least(length(left_key), length(right_key)) AS priority FROM said JOIN cand USING (left_key, right_key) WHERE {cond} ORDER BY {order} DESC, left_key, right_key LIMIT 50"


@query("acronym_lane", _lane_sql("list_contains(reasons, 'acronym')", "priority"), "pred", "said", "cand")
def acronym_lane(spark, d):
    """The next 50 pairs of the lane: the limit is the operator."""
    return review.lane(_pred(spark, d), _cand(spark, d), True, 50).select("left_key", "right_key", "probability", "priority")


@query("similarity_lane", _lane_sql("NOT list_contains(reasons, 'acronym')", "probability"), "pred", "said", "cand")
def similarity_lane(spark, d):
    """The next 50 pairs of the lane: the limit is the operator."""
    return review.lane(_pred(spark, d), _cand(spark, d), False, 50).select("left_key", "right_key", "probability", "priority")


@query("review_exclusions", "SELECT left_key, right_key FROM pred WHERE (left_key, right_key) NOT IN (SELECT left_key, right_key FROM frozen) AND k % 3 <> 0 AND k % 10 <> 1", "pred", "gold", "frozen")
def review_exclusions(spark, d):
    p, g = _pred(spark, d), _gold(spark, d)
    return review.open_pairs(p, evaluation.frozen_benchmark(g), g, p.where("k % 10 = 1")).select("left_key", "right_key")


@query("decision_insert", """, old AS (SELECT DISTINCT 'p' || l_partkey AS loser_key FROM lineitem WHERE l_orderkey % 50 = 0), new AS (SELECT 'p' || l_partkey AS loser_key, 's' || l_suppkey AS winner_key, l_orderkey AS seq, l_linenumber AS line FROM lineitem WHERE l_orderkey % 7 = 1)
 SELECT loser_key, winner_key, seq, CASE WHEN loser_key NOT IN (SELECT loser_key FROM old) AND row_number() OVER (PARTITION BY loser_key ORDER BY seq, line, winner_key) = 1 THEN 'inserted' ELSE 'conflict' END AS outcome FROM new""")
def decision_insert(spark, d):
    line = table(spark, d, "lineitem")
    key = F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("loser_key")
    new = line.where("l_orderkey % 7 = 1").select(key, F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("winner_key"), F.col("l_orderkey").alias("seq"), F.col("l_linenumber").alias("line"))
    return review.inserted_decisions(line.where("l_orderkey % 50 = 0").select(key), new, F.struct("seq", "line")).select("loser_key", "winner_key", "seq", "outcome")


SQL["decision_insert"] = "WITH " + SQL["decision_insert"].removeprefix(", ")


@query("review_context", """SELECT keys.key, c_name AS name, coalesce(n, 0) AS recognitions, first_year, last_year, coalesce(programs, 0) AS programs, coalesce(countries, '') AS countries FROM (SELECT 'c' || c_custkey AS key FROM customer UNION ALL SELECT 's' || s_suppkey FROM supplier) keys
 LEFT JOIN customer ON key = 'c' || c_custkey LEFT JOIN (SELECT org_id, count(*) AS n, min(year) AS first_year, max(year) AS last_year, count(DISTINCT program_id) AS programs, array_to_string(list_sort(list(DISTINCT country)), '; ') AS countries FROM recognitions GROUP BY 1) ON org_id = c_custkey""", "recognitions")
def review_context(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    key = lambda mark, col: F.concat(F.lit(mark), F.col(col).cast("string")).alias("key")
    orgs = c.select(key("c", "c_custkey"), F.col("c_custkey").alias("org_id"), F.col("c_name").alias("name"))
    countries = table(spark, d, "nation").select(F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country"))
    return review.context(orgs.select("key").union(s.select(key("s", "s_suppkey"))), orgs, recognitions(spark, d).select("org_id", "year", "program_id", "country_id"), countries)


@query("hash_rank", "SELECT p_partkey, row_number() OVER (ORDER BY sha256(p_partkey::VARCHAR)) AS rank FROM part")
def hash_rank(spark, d):
    return review.hash_rank(table(spark, d, "part"), F.col("p_partkey").cast("string")).select("p_partkey", "rank")


@query("label_progress", """SELECT band, count(*) AS pairs, count(label) AS labelled, count(*) FILTER (WHERE label = 'merge') AS merges, greatest(500 - count(label), 0) AS gap FROM (SELECT CASE WHEN k % 11 = 0 THEN NULL WHEN probability >= 0.8 THEN 'high' WHEN probability >= 0.5 THEN 'medium' ELSE 'low' END AS band, label
 FROM pred LEFT JOIN gold USING (left_key, right_key, k)) GROUP BY band""", "pred", "gold")
def label_progress(spark, d):
    p = _pred(spark, d)
    return review.progress(p.withColumn("probability", F.when(F.col("k") % 11 != 0, F.col("probability"))), _gold(spark, d), 500)


@query("rebuilt_candidates", "SELECT left_key, right_key, probability, candidate_id FROM pred LEFT JOIN cand USING (left_key, right_key)", "pred", "cand")
def rebuilt_candidates(spark, d):
    old = _pred(spark, d).withColumn("candidate_id", F.col("k"))
    return evaluation.rebuilt_candidates(old, _cand(spark, d)).select("left_key", "right_key", "probability", "candidate_id")


def _quality_sql() -> str:
    groups = " UNION ALL ".join(f"SELECT 'by {c}', coalesce(CAST({c} AS VARCHAR), 'none'), count(*) FROM recognitions GROUP BY 2" for c in ("level", "program_id", "year", "country_id", "category"))
    one = lambda name, value, of="recognitions": f"SELECT 'scalars', '{name}', CAST({value} AS BIGINT) FROM {of}"
    scalars = [one("recognitions", "count(*)"), one("organizations", "count(DISTINCT org_id)"), one("countries", "count(DISTINCT country_id)"), one("programs", "count(DISTINCT program_id)"), one("categories", "count(DISTINCT category)"), one("editions", "count(DISTINCT (program_id, year))")]
    scalars += [one("without_year", "count(*) FILTER (WHERE year IS NULL)"), one("without_level", "count(*) FILTER (WHERE level = 'other')"), one("years", "max(year) - min(year) + 1"), one("parties", "count(*)", "lineitem"), one("distinct_parties", "count(DISTINCT l_suppkey)", "lineitem")]
    orgs = "SELECT 'organizations by recognitions', CASE WHEN k = 1 THEN '1' WHEN k < 5 THEN '2-4' WHEN k < 10 THEN '5-9' ELSE '10+' END, count(*) FROM (SELECT org_id, count(*) AS k FROM recognitions GROUP BY 1) GROUP BY 2"
    roles = "SELECT 'by role', CASE WHEN l_linenumber = 1 THEN 'recipient' ELSE 'nominee' END, count(*) FROM lineitem GROUP BY 2"
    return f"SELECT * FROM ({' UNION ALL '.join([scalars[0].replace('SELECT', 'SELECT', 1), *scalars[1:], groups, orgs, roles])}) t(section, label, n)"


@query("data_quality_report", _quality_sql(), "recognitions")
def data_quality_report(spark, d):
    parties = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("node_id"), F.when(F.col("l_linenumber") == 1, "recipient").otherwise("nominee").alias("role"), F.col("l_suppkey").alias("party_id"))
    return reports.quality_sections(recognitions(spark, d), parties)


_EVIDENCE = """ev AS (SELECT user_id % 40 AS subject, event_type AS kind, CASE event_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' END AS tier, CASE WHEN event_id % 3 = 0 THEN ['award', event_type] WHEN event_id % 3 = 1 THEN ['news'] END AS categories,
 CASE WHEN value < 20 THEN 'negative' WHEN value < 60 THEN 'neutral' ELSE 'positive' END AS sentiment, 'm' || (event_id % 2) AS model, 'd' || (user_id % 9) AS domain, round(value, 2) AS relevance FROM events)"""


@query("evidence_sections", f"WITH {_EVIDENCE}, l AS (SELECT subject, relevance, unnest(list_concat(['all', 'kind', 'tier', 'sentiment', 'model', 'domain'], list_transform(coalesce(categories, []), lambda c: 'category'))) AS section, unnest(list_concat(['all', kind, coalesce(tier, 'none'), sentiment, model, domain], coalesce(categories, []))) AS label FROM ev) SELECT section, label, count(*) AS n, count(DISTINCT subject) AS subjects, round(avg(relevance), 3) AS relevance FROM l GROUP BY 1, 2")
def evidence_sections(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id")
    tier = F.when(k % 4 == 0, "A").when(k % 4 == 1, "B").when(k % 4 == 2, "C")
    categories = F.when(k % 3 == 0, F.array(F.lit("award"), F.col("event_type"))).when(k % 3 == 1, F.array(F.lit("news")))
    mood = F.when(F.col("value") < 20, "negative").when(F.col("value") < 60, "neutral").otherwise("positive")
    mark = lambda m, c: F.concat(F.lit(m), c.cast("string"))
    rows = e.select((F.col("user_id") % 40).alias("subject"), F.col("event_type").alias("kind"), tier.alias("tier"), categories.alias("categories"), mood.alias("sentiment"), mark("m", k % 2).alias("model"), mark("d", F.col("user_id") % 9).alias("domain"), F.round("value", 2).alias("relevance"))
    return reports.evidence_sections(rows)


_DIMS = {"country_id": "country", "program_id": "program", "category": "category_definition", "org_id": "organization"}


@query("canonicalization_counters", "SELECT dimension, created, exact, CASE WHEN dimension = 'organization' THEN (SELECT count(*) FROM cand) ELSE 0 END AS candidates FROM (" + " UNION ALL ".join(f"SELECT '{v}' AS dimension, count(DISTINCT {c}) AS created, count({c}) - count(DISTINCT {c}) AS exact FROM recognitions" for c, v in _DIMS.items()) + ")", "recognitions", "pred", "cand")
def canonicalization_counters(spark, d):
    return reports.canonicalization_counters(recognitions(spark, d), _DIMS, _cand(spark, d).withColumn("dimension", F.lit("organization")))


@query("person_report", """SELECT 'p' || p_partkey AS person_id, p_name AS name, s_name AS organization, n AS recognitions, first_year, last_year FROM part JOIN (SELECT l_partkey, count(*) AS n, min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1 GROUP BY 1) ON l_partkey = p_partkey
 LEFT JOIN supplier ON s_suppkey = p_partkey""")
def person_report(spark, d):
    mark = lambda c: F.concat(F.lit("p"), F.col(c).cast("string")).alias("person_id")
    people = table(spark, d, "part").select(mark("p_partkey"), F.col("p_name").alias("name"), F.col("p_partkey").alias("org_id"))
    won = table(spark, d, "lineitem").where("l_linenumber = 1").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(mark("l_partkey"), F.year("o_orderdate").alias("year"))
    return reports.person_report(people, table(spark, d, "supplier").select(F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("name")), won)


_DISCOVER = """led AS (SELECT 'm' || o_orderkey AS mention, o_custkey AS org_id FROM orders), mp AS (SELECT 'm' || o_orderkey AS left_mention, 'm' || (o_orderkey + 1) AS right_mention, round((o_orderkey % 97) / 97.0, 4) AS similarity FROM orders), gen AS (SELECT DISTINCT least(a.org_id, b.org_id) AS left_id, greatest(a.org_id, b.org_id) AS right_id
 FROM mp JOIN led a ON a.mention = left_mention JOIN led b ON b.mention = right_mention WHERE a.org_id % 3 = 0 AND a.org_id <> b.org_id), disc AS (SELECT least(a.org_id, b.org_id) AS left_id, greatest(a.org_id, b.org_id) AS right_id, max(similarity)::DOUBLE AS similarity FROM mp JOIN led a ON a.mention = left_mention JOIN led b ON b.mention = right_mention WHERE a.org_id <> b.org_id GROUP BY 1, 2),
 found AS (SELECT disc.*, (left_id, right_id) IN (SELECT left_id, right_id FROM gen) AS generated FROM disc)"""


def _discoverable(spark, d):
    o = table(spark, d, "orders")
    mark = lambda c: F.concat(F.lit("m"), c.cast("string"))
    ledger = o.select(mark(F.col("o_orderkey")).alias("mention"), F.col("o_custkey").alias("org_id"))
    mentions = o.select(mark(F.col("o_orderkey")).alias("left_mention"), mark(F.col("o_orderkey") + 1).alias("right_mention"), F.round(F.col("o_orderkey") % 97 / 97.0, 4).cast("double").alias("similarity"))
    sides = mentions.join(ledger.select(F.col("mention").alias("left_mention"), F.col("org_id").alias("a")), "left_mention").join(ledger.select(F.col("mention").alias("right_mention"), F.col("org_id").alias("b")), "right_mention")
    made = sides.where("a % 3 = 0 AND a <> b").select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id"))
    return reports.discoverable(ledger, mentions, made)


@query("discoverable_pairs", f"WITH {_DISCOVER} SELECT * FROM found")
def discoverable_pairs(spark, d):
    return _discoverable(spark, d)


@query("gap_sample", f"WITH {_DISCOVER} SELECT left_id, right_id, similarity FROM found WHERE NOT generated ORDER BY similarity DESC, left_id, right_id LIMIT 40")
def gap_sample(spark, d):
    """The report's sample of 40: the limit is the operator."""
    return reports.gap_sample(_discoverable(spark, d))


@query("candidate_sample", f"WITH {_DISCOVER} SELECT left_id, a.c_name AS left_name, right_id, b.c_name AS right_name, similarity FROM found JOIN customer a ON a.c_custkey = left_id JOIN customer b ON b.c_custkey = right_id WHERE generated ORDER BY similarity DESC, left_id, right_id LIMIT 25")
def candidate_sample(spark, d):
    """The report's sample of 25: the limit is the operator."""
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("org_id"), F.col("c_name").alias("name"))
    return reports.candidate_sample(_discoverable(spark, d).where("generated"), names, 25)


@query("coverage_worst_first", "SELECT 'u' || user_id AS subject, count(*) AS n, count(*) FILTER (WHERE value >= 50) AS good FROM events GROUP BY 1 ORDER BY good, n, subject LIMIT 60")
def coverage_worst_first(spark, d):
    """The report's 60 subjects: the limit is the operator."""
    rows = table(spark, d, "events").groupBy(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("subject")).agg(F.count("*").alias("n"), F.count_if(F.col("value") >= 50).alias("good"))
    return reports.worst_first(rows)


@query("version_scan", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN '1.1.0' WHEN 1 THEN '1.0.0' WHEN 2 THEN '0.9' END AS version, page_id % 4 = 0 AS current FROM pages")
def version_scan(spark, d):
    k = F.col("page_id") % 4
    rows = table(spark, d, "pages").select("page_id", F.when(k == 0, "1.1.0").when(k == 1, "1.0.0").when(k == 2, "0.9").alias("version"))
    same, other = reports.versioned(rows, "1.1.0")
    return same.withColumn("current", F.lit(True)).unionByName(other.withColumn("current", F.lit(False)))


@query("backfill_from_join", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'set' END, CASE WHEN o_custkey % 5 <> 0 THEN c_name END) AS org_key FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def backfill_from_join(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, "set").alias("org_key"))
    source = table(spark, d, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("org_key"))
    return reports.backfilled(rows, source.union(source), "id", "org_key").select("o_orderkey", "org_key")


@query("names_most_used", "SELECT org_id, key, n FROM (SELECT s AS org_id, p_brand AS key, count(*) AS n, row_number() OVER (PARTITION BY s ORDER BY count(*) DESC, p_brand) AS r FROM (SELECT p_size AS s, p_brand FROM part) GROUP BY 1, 2) WHERE r = 1")
def names_most_used(spark, d):
    return reports.names_most_used(table(spark, d, "part").select(F.col("p_size").alias("org_id"), F.col("p_brand").alias("key")))


@query("nan_to_null", "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events")
def nan_to_null(spark, d):
    value = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, d, "events").select("event_id", evaluation.finite(value).alias("value"))
