"""Queries of entity resolution: blocking, features, splits, scoring, evaluation, benchmarks."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import similarity as sim
from plumbline.functions.text import feature_key, norm_key
from plumbline.operators import blocking, scoring
from plumbline.sources.tables import table

QUERIES, SQL = {}, {}
CTE = {
    # 64 two-word part names with three made variants of each
    "orgs": """orgs AS (SELECT min(id) AS id, key, key AS name FROM (SELECT p_partkey AS id, p_name AS key FROM part UNION ALL SELECT p_partkey + 1000000, p_name || ' and ' || lower(p_type) FROM part
 UNION ALL SELECT p_partkey + 2000000, lower(p_type) || ' ' || p_name FROM part UNION ALL SELECT p_partkey + 3000000, left(p_name, 1) || left(split_part(p_name, ' ', 2), 1) FROM part) GROUP BY key)""",
    "gram": "gram AS (SELECT id, key, name, list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS g FROM orgs)",
}


def query(name: str, sql: str | None = None, *ctes: str):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = (f"WITH {', '.join(CTE[c] for c in ctes)} " if ctes else "") + sql
        return f

    return add


def orgs(spark, d):
    p, kind = table(spark, d, "part"), F.lower("p_type")
    parts = [
        p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("key")),
        p.select(F.col("p_partkey") + 1000000, F.concat("p_name", F.lit(" and "), kind)),
        p.select(F.col("p_partkey") + 2000000, F.concat(kind, F.lit(" "), "p_name")),
        p.select(F.col("p_partkey") + 3000000, F.concat(F.left("p_name", F.lit(1)), F.left(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(1)))),
    ]
    rows = parts[0]
    for x in parts[1:]:
        rows = rows.union(x)
    return rows.groupBy(norm_key(F.col("key")).alias("key")).agg(F.min("id").alias("id")).withColumn("name", F.col("key"))


_SIM = "len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g)))"
_TRI = f"SELECT least(a.key, b.key) AS left_key, greatest(a.key, b.key) AS right_key, round({_SIM}, 4) AS similarity FROM gram a JOIN gram b ON a.key < b.key WHERE {_SIM} >= 0.4 - 1e-12"


@query("trigram_block", _TRI, "orgs", "gram")
def trigram_block(spark, d):
    return blocking.trigram_pairs(orgs(spark, d), 0.4).select("left_key", "right_key", F.round("similarity", 4).alias("similarity"))


_TOKENS = "tok AS (SELECT id, key, unnest(list_filter(string_split(key, ' '), lambda t: length(t) >= 4)) AS token FROM orgs)"


@query("rare_tokens")
def rare_tokens(spark, d):
    return blocking.token_frequency(orgs(spark, d)).where("df <= 300")


SQL["rare_tokens"] = f"WITH {CTE['orgs']}, {_TOKENS} SELECT token, count(*) AS df FROM tok GROUP BY token HAVING count(*) <= 300"


def _units(spark, d):
    """A name for every part; each unit's name stands in three of them, and longer groups share a word that is not rare."""
    k = F.col("p_partkey")
    return table(spark, d, "part").select(k.alias("id"), F.concat(F.lit("unit"), (k - k % 3).cast("string"), F.lit(" of works"), (k - k % 8).cast("string"), F.lit(" p"), k.cast("string")).alias("key"))


@query("rare_token_block", """WITH tok AS (SELECT id, key, unnest(list_filter(string_split(key, ' '), lambda t: length(t) >= 4)) AS token FROM (SELECT p_partkey AS id, 'unit' || (p_partkey - p_partkey % 3) || ' of works' || (p_partkey - p_partkey % 8) || ' p' || p_partkey AS key FROM part)),
 rare AS (SELECT token FROM tok GROUP BY token HAVING count(*) <= 5) SELECT DISTINCT least(a.key, b.key) AS left_key, greatest(a.key, b.key) AS right_key FROM tok a JOIN tok b ON a.token = b.token AND a.id < b.id JOIN rare ON rare.token = a.token""")
def rare_token_block(spark, d):
    return blocking.rare_token_pairs(_units(spark, d)).select("left_key", "right_key")


_INI = "ini AS (SELECT key, unnest(list_distinct([array_to_string(list_transform(w, lambda t: left(t, 1)), ''), array_to_string(list_transform(list_filter(w, lambda t: t NOT IN ('for', 'the', 'of', 'and', 'a', 'an', 'to', 'in', 'at', 'on', 'by')), lambda t: left(t, 1)), '')])) AS ini FROM (SELECT key, string_split(key, ' ') AS w FROM orgs) WHERE len(w) >= 2)"
_ACR = "SELECT DISTINCT least(o.key, i.key) AS left_key, greatest(o.key, i.key) AS right_key FROM orgs o JOIN ini i ON o.key = i.ini WHERE regexp_full_match(o.key, '[a-z]{2,7}')"


@query("acronym_block")
def acronym_block(spark, d):
    return blocking.acronym_pairs(orgs(spark, d)).select("left_key", "right_key")


SQL["acronym_block"] = f"WITH {CTE['orgs']}, {_INI} {_ACR}"
_SIG = "list_sort(list_filter(string_split(key, ' '), lambda t: t NOT IN ('for', 'the', 'of', 'and', 'a', 'an', 'to', 'in', 'at', 'on', 'by')))"


@query("reordered_block", f"SELECT a.key AS left_key, b.key AS right_key FROM (SELECT key, {_SIG} AS s FROM orgs) a JOIN (SELECT key, {_SIG} AS s FROM orgs) b ON a.s = b.s AND a.key < b.key WHERE len(a.s) >= 2", "orgs")
def reordered_block(spark, d):
    return blocking.reordered_pairs(orgs(spark, d)).select("left_key", "right_key")


@query("and_variant_block", "SELECT a.key AS left_key, a.key || ' x and y' AS right_key FROM orgs a WHERE false UNION ALL SELECT left_key, right_key FROM (SELECT least(p, q) AS left_key, greatest(p, q) AS right_key FROM (SELECT DISTINCT lower(p_brand) AS b FROM part) CROSS JOIN LATERAL (SELECT b || ' x and y' AS p, b || ' x y' AS q))", "orgs")
def and_variant_block(spark, d):
    b = table(spark, d, "part").select(F.lower("p_brand").alias("b")).distinct()
    rows = b.select(F.concat("b", F.lit(" x and y")).alias("key")).union(b.select(F.concat("b", F.lit(" x y")))).withColumn("id", F.xxhash64("key"))
    return blocking.and_variant_pairs(rows).select("left_key", "right_key")


@query("abbrev_block", "SELECT least(p, q) AS left_key, greatest(p, q) AS right_key FROM (SELECT DISTINCT lower(p_brand) || ' tech intl' AS p, lower(p_brand) || ' technologies intl' AS q FROM part)")
def abbrev_block(spark, d):
    b = table(spark, d, "part").select(F.lower("p_brand").alias("b")).distinct()
    rows = b.select(F.concat("b", F.lit(" tech intl")).alias("key")).union(b.select(F.concat("b", F.lit(" technologies intl")))).withColumn("id", F.xxhash64("key"))
    return blocking.abbreviation_pairs(rows).select("left_key", "right_key")


_RARE = "SELECT DISTINCT least(a.key, b.key), greatest(a.key, b.key) FROM tok a JOIN tok b ON a.token = b.token AND a.key < b.key JOIN rare ON rare.token = a.token"
_RARES = "rare AS (SELECT token FROM tok GROUP BY token HAVING count(*) <= 5)"
_UNION = f"SELECT left_key, right_key, array_to_string(list_sort(list(DISTINCT reason)), ',') AS reasons FROM (SELECT left_key, right_key, 'trigram' AS reason FROM ({_TRI}) UNION ALL SELECT *, 'acronym' FROM ({_ACR}) UNION ALL SELECT *, 'rare_token' FROM ({_RARE})) GROUP BY 1, 2"


@query("blocker_union")
def blocker_union(spark, d):
    return blocking.generate(orgs(spark, d)).select("left_key", "right_key", F.array_join("reasons", ",").alias("reasons"))


SQL["blocker_union"] = f"WITH {CTE['orgs']}, {CTE['gram']}, {_TOKENS}, {_RARES}, {_INI} {_UNION}"


_CASES = f"SELECT left_key, right_key, array_to_string(list_sort(list(DISTINCT reason)), '+') AS pattern FROM (SELECT a.key AS left_key, b.key AS right_key, 'reordered' AS reason FROM (SELECT key, {_SIG} AS s FROM orgs) a JOIN (SELECT key, {_SIG} AS s FROM orgs) b ON a.s = b.s AND a.key < b.key WHERE len(a.s) >= 2 UNION ALL SELECT *, 'acronym' FROM ({_ACR}) UNION ALL SELECT a.key, b.key, 'and_variant' FROM (SELECT key, list_filter(string_split(key, ' '), lambda t: t <> 'and') AS s FROM orgs) a JOIN (SELECT key, list_filter(string_split(key, ' '), lambda t: t <> 'and') AS s FROM orgs) b ON a.s = b.s AND a.key < b.key) GROUP BY 1, 2"


@query("hard_cases", f"WITH {CTE['orgs']}, {_INI} {_CASES}")
def hard_cases(spark, d):
    return blocking.hard_cases(orgs(spark, d)).select("left_key", "right_key", "pattern")


@query("possible_duplicates", f"SELECT count(*) AS pairs FROM ({_TRI.replace('0.4', '0.55')})", "orgs", "gram")
def possible_duplicates(spark, d):
    return blocking.possible_duplicates(orgs(spark, d), 0.55)


def _features(spark, d):
    o = orgs(spark, d)
    return blocking.with_features(blocking.generate(o), o, rare_tokens=blocking.rare_tokens(o))


_G = "list_distinct(list_transform(range(1, length(p) - 1), lambda i: substr(p, i, 3)))"


def _jac(x: str, y: str) -> str:
    return f"len(list_intersect({x}, {y}))::DOUBLE / (len({x}) + len({y}) - len(list_intersect({x}, {y})))"


@query("features")
def features(spark, d):
    f = _features(spark, d)
    four = [F.round(c, 4).alias(c) for c in ("trigram_similarity", "token_jaccard", "length_ratio", "normalized_token_overlap", "despaced_trigram_similarity", "prefix_overlap", "suffix_match", "acronym_x_trigram", "acronym_x_jaccard")]
    return f.select("left_key", "right_key", "blocked_by_trigram", "blocked_by_rare_token", "blocked_by_acronym", "is_acronym_expansion", F.col("shared_rare_token_count").cast("long").alias("shared_rare_token_count"), *four)


_FT = _TRI
SQL["features"] = f"""WITH {CTE['orgs']}, {CTE['gram']}, {_TOKENS}, {_RARES}, {_INI}, cand AS (SELECT left_key, right_key, list(DISTINCT reason) AS reasons FROM (SELECT left_key, right_key, 'trigram' AS reason FROM ({_FT}) UNION ALL SELECT *, 'acronym' FROM ({_ACR}) UNION ALL SELECT *, 'rare_token' FROM ({_RARE})) GROUP BY 1, 2),
 norm AS (SELECT *, array_to_string(list_filter(string_split(left_key, ' '), lambda t: t NOT IN ('a', 'an', 'the')), ' ') AS a, array_to_string(list_filter(string_split(right_key, ' '), lambda t: t NOT IN ('a', 'an', 'the')), ' ') AS b FROM cand),
 made AS (SELECT *, list_distinct(string_split(a, ' ')) AS ta, list_distinct(string_split(b, ' ')) AS tb, list_distinct(list_transform(range(1, length(a) + 2), lambda i: substr('  ' || a || ' ', i, 3))) AS ga, list_distinct(list_transform(range(1, length(b) + 2), lambda i: substr('  ' || b || ' ', i, 3))) AS gb,
  replace(a, ' ', '') AS da, replace(b, ' ', '') AS db FROM norm),
 more AS (SELECT *, list_distinct(list_transform(range(1, length(da) + 2), lambda i: substr('  ' || da || ' ', i, 3))) AS ha, list_distinct(list_transform(range(1, length(db) + 2), lambda i: substr('  ' || db || ' ', i, 3))) AS hb FROM made)
 SELECT *, round(CASE WHEN is_acronym_expansion THEN trigram_similarity ELSE 0 END, 4) AS acronym_x_trigram, round(CASE WHEN is_acronym_expansion THEN token_jaccard ELSE 0 END, 4) AS acronym_x_jaccard FROM (SELECT left_key, right_key, list_contains(reasons, 'trigram') AS blocked_by_trigram, list_contains(reasons, 'rare_token') AS blocked_by_rare_token, list_contains(reasons, 'acronym') AS blocked_by_acronym,
  EXISTS (SELECT 1 FROM ini WHERE (ini.key = a AND ini.ini = b AND regexp_full_match(b, '[a-z]{{2,7}}')) OR (ini.key = b AND ini.ini = a AND regexp_full_match(a, '[a-z]{{2,7}}'))) AS is_acronym_expansion,
  len(list_intersect(list_filter(list_intersect(ta, tb), lambda t: length(t) >= 4), (SELECT coalesce(list(token), []) FROM rare))) AS shared_rare_token_count, round({_jac('ga', 'gb')}, 4) AS trigram_similarity, round({_jac('ta', 'tb')}, 4) AS token_jaccard,
  round(least(length(a), length(b))::DOUBLE / greatest(length(a), length(b)), 4) AS length_ratio, round(len(list_intersect(ta, tb))::DOUBLE / least(len(ta), len(tb)), 4) AS normalized_token_overlap, round({_jac('ha', 'hb')}, 4) AS despaced_trigram_similarity,
  round(len(list_filter(range(1, least(length(a), length(b)) + 1), lambda i: left(a, i) = left(b, i)))::DOUBLE / greatest(length(a), length(b)), 4) AS prefix_overlap,
  round(len(list_filter(range(1, least(length(a), length(b)) + 1), lambda i: right(a, i) = right(b, i)))::DOUBLE / greatest(length(a), length(b)), 4) AS suffix_match FROM more)"""


@query("feature_key", "SELECT p_partkey, array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(replace(p_name || ' & the ' || lower(p_type), '&', ' and '), '[^a-z0-9_\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda t: t NOT IN ('a', 'an', 'the')), ' ') AS k FROM part")
def feature_key_query(spark, d):
    return table(spark, d, "part").select("p_partkey", feature_key(F.concat("p_name", F.lit(" & the "), F.lower("p_type"))).alias("k"))


def _pairs(spark, d):
    return table(spark, d, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("left_key"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("right_key"))


def _frac(salt: str) -> str:
    return f"CAST(CAST('0x' || left(sha256({salt}'c' || o_custkey || chr(0) || 'o' || o_orderkey), 16) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0"


def _split_query(name: str, salt: str | None, shares):
    text = f"'{salt}' || chr(0) || " if salt else ""
    edge, cases = 0.0, ""
    for n, s in shares[:-1]:
        edge += s
        cases += f"WHEN f < {edge!r} THEN '{n}' "

    @query(name, f"SELECT left_key, right_key, round(f, 6) AS fraction, CASE {cases}ELSE '{shares[-1][0]}' END AS split FROM (SELECT 'c' || o_custkey AS left_key, 'o' || o_orderkey AS right_key, {_frac(text)} AS f FROM orders)")
    def run(spark, d):
        f = sim.pair_fraction(F.col("left_key"), F.col("right_key"), salt)
        return _pairs(spark, d).select("left_key", "right_key", F.round(f, 6).alias("fraction"), sim.assigned_split(f, shares).alias("split"))


_split_query("hash_split_v1", None, sim.SPLIT_V1)
_split_query("hash_split_v2", "split_v2", sim.SPLIT_V2)


@query("split_ratio", f"SELECT split, count(*) AS n FROM (SELECT CASE WHEN f < 0.6 THEN 'train' WHEN f < 0.8 THEN 'calibration' ELSE 'evaluation' END AS split FROM (SELECT {_frac('')} AS f FROM orders)) GROUP BY split")
def split_ratio(spark, d):
    f = sim.pair_fraction(F.col("left_key"), F.col("right_key"))
    return _pairs(spark, d).groupBy(sim.assigned_split(f).alias("split")).agg(F.count("*").alias("n"))


def _probable(spark, d):
    return _pairs(spark, d).withColumn("probability", F.round(sim.pair_fraction(F.col("left_key"), F.col("right_key")), 6))


_PROB = f"SELECT 'c' || o_custkey AS left_key, 'o' || o_orderkey AS right_key, round({_frac('')}, 6) AS probability FROM orders"


@query("uncertainty_rank", f"SELECT left_key, right_key, probability FROM ({_PROB}) ORDER BY abs(probability - 0.5), left_key, right_key LIMIT 25")
def uncertainty_rank(spark, d):
    """The 25 most uncertain pairs: the limit is the operator."""
    return _probable(spark, d).orderBy(sim.uncertainty(F.col("probability")), "left_key", "right_key").limit(25)


_F2 = "CAST(CAST('0x' || left(sha256('queue' || chr(0) || left_key || chr(0) || right_key), 16) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0"


@query("select_queue", f"WITH p AS ({_PROB}), u AS (SELECT * FROM p ORDER BY abs(probability - 0.5), left_key, right_key LIMIT 14) SELECT left_key, right_key, probability, 'uncertainty' AS strategy FROM u UNION ALL (SELECT left_key, right_key, probability, 'random' FROM (SELECT *, {_F2} AS f FROM p WHERE (left_key, right_key) NOT IN (SELECT (left_key, right_key) FROM u)) ORDER BY f, left_key, right_key LIMIT 6)")
def select_queue(spark, d):
    """A queue of 20 pairs: the limit is the operator."""
    f = sim.pair_fraction(F.col("left_key"), F.col("right_key"), "queue")
    return scoring.selected_queue(_probable(spark, d), 20, 0.3, f).select("left_key", "right_key", "probability", "strategy")


_LAB = "SELECT *, quality = 1 AS y, (doc_id * 7919 % 10) < 7 AS p FROM labels"


@query("confusion_prf", f"""SELECT tp, fp, fn, tn, round(tp::DOUBLE / nullif(tp + fp, 0), 4) AS precision, round(tp::DOUBLE / nullif(tp + fn, 0), 4) AS recall,
 round(2 * (tp::DOUBLE / nullif(tp + fp, 0)) * (tp::DOUBLE / nullif(tp + fn, 0)) / nullif(tp::DOUBLE / nullif(tp + fp, 0) + tp::DOUBLE / nullif(tp + fn, 0), 0), 4) AS f1, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 4) AS accuracy
 FROM (SELECT count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp, count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE NOT y AND NOT p) AS tn FROM ({_LAB}))""")
def confusion_prf(spark, d):
    return table(spark, d, "labels").agg(*scoring.confusion(F.col("quality") == 1, F.col("doc_id") * 7919 % 10 < 7))


@query("provenance_breakdown", f"SELECT reason, count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp, count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE NOT y AND NOT p) AS tn FROM (SELECT *, unnest(CASE WHEN toxic = 1 THEN ['trigram', 'acronym'] ELSE ['trigram'] END) AS reason FROM ({_LAB})) GROUP BY reason")
def provenance_breakdown(spark, d):
    merge = lambda c: F.when(c, "merge").otherwise("distinct")
    rows = table(spark, d, "labels").select(F.when(F.col("toxic") == 1, F.array(F.lit("trigram"), F.lit("acronym"))).otherwise(F.array(F.lit("trigram"))).alias("reasons"), merge(F.col("quality") == 1).alias("label"), merge(F.col("doc_id") * 7919 % 10 < 7).alias("predicted_label"))
    return scoring.provenance(rows).select("reason", "tp", "fp", "fn", "tn")


_PY = "SELECT (doc_id * 7919 % 1000) / 1000.0::DOUBLE AS p, quality AS y FROM labels"


def _predicted(spark, d):
    return table(spark, d, "labels").select((F.col("doc_id") * 7919 % 1000 / 1000.0).alias("p"), F.col("quality").alias("y"))


@query("brier", f"SELECT round(avg((p - y) * (p - y)), 4) AS brier, count(*) AS n FROM ({_PY})")
def brier(spark, d):
    return _predicted(spark, d).agg(F.round(scoring.brier(F.col("p"), F.col("y")), 4).alias("brier"), F.count("*").alias("n"))


@query("reliability_bins", f"SELECT b::INTEGER AS bin, coalesce(n, 0) AS n, mean_p, observed FROM range(10) r(b) LEFT JOIN (SELECT least(floor(p * 10), 9)::INTEGER AS bin, count(*) AS n, round(avg(p), 4) AS mean_p, round(avg(y), 4) AS observed FROM ({_PY}) GROUP BY 1) ON bin = b")
def reliability_bins(spark, d):
    return scoring.reliability(_predicted(spark, d))


@query("class_counts", "SELECT split, count(*) FILTER (WHERE quality = 1) AS merge, count(*) FILTER (WHERE quality = 0) AS \"distinct\" FROM (SELECT *, 's' || (doc_id % 3) AS split FROM labels) GROUP BY split")
def class_counts(spark, d):
    rows = table(spark, d, "labels").select(F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")).alias("split"), F.when(F.col("quality") == 1, "merge").otherwise("distinct").alias("label"))
    return scoring.class_counts(rows)


_GOLD = "SELECT 'k' || (doc_id % 40) AS left_key, 'm' || doc_id AS right_key, CASE quality WHEN 1 THEN 'merge' ELSE 'distinct' END AS label FROM labels"


def _gold(spark, d):
    return table(spark, d, "labels").select(F.concat(F.lit("k"), (F.col("doc_id") % 40).cast("string")).alias("left_key"), F.concat(F.lit("m"), F.col("doc_id").cast("string")).alias("right_key"), F.when(F.col("quality") == 1, "merge").otherwise("distinct").alias("label"), "doc_id")


@query("recall_eval", """SELECT merges, found, gap AS blocking_gap, gone AS missing_org, round(100.0 * found / nullif(found + gap, 0), 2) AS achievable_pct, round(100.0 * found / nullif(merges, 0), 2) AS overall_pct, distinct_surfaced, marginal FROM (
 SELECT count(*) FILTER (WHERE quality = 1) AS merges, count(*) FILTER (WHERE quality = 1 AND doc_id % 3 = 0) AS found, count(*) FILTER (WHERE quality = 1 AND doc_id % 3 <> 0 AND doc_id % 5 <> 0) AS gap, count(*) FILTER (WHERE quality = 1 AND doc_id % 3 <> 0 AND doc_id % 5 = 0) AS gone,
 count(*) FILTER (WHERE quality = 0 AND doc_id % 3 = 0) AS distinct_surfaced, count(*) FILTER (WHERE quality = 1 AND doc_id % 3 = 0) AS marginal FROM labels)""")
def recall_eval(spark, d):
    gold = _gold(spark, d)
    candidates = gold.where("doc_id % 3 = 0").select("left_key", "right_key", F.array(F.lit("trigram")).alias("reasons"))
    keys = gold.select(F.col("left_key").alias("key")).union(gold.where("doc_id % 5 <> 0").select("right_key"))
    return scoring.blocker_recall(gold.drop("doc_id"), candidates, keys)


@query("contamination", f"SELECT left_key, right_key FROM ({_GOLD} WHERE doc_id % 2 = 0) INTERSECT SELECT left_key, right_key FROM ({_GOLD} WHERE doc_id % 7 = 0)")
def contamination(spark, d):
    g = _gold(spark, d)
    return scoring.contamination(g.where("doc_id % 2 = 0"), g.where("doc_id % 7 = 0"))


@query("frozen_digest", f"SELECT sha256(array_to_string(list_sort(list(left_key || chr(0) || right_key || chr(0) || label || chr(10))), '')) AS digest, count(*) AS n FROM ({_GOLD})")
def frozen_digest(spark, d):
    return scoring.digest(_gold(spark, d))


@query("benchmark_verify", "SELECT count(*) FILTER (WHERE doc_id % 2 = 0 AND doc_id % 3 = 0 AND doc_id % 5 = 0) AS relabelled, count(*) FILTER (WHERE doc_id % 2 = 0 AND doc_id % 3 <> 0) AS dropped, count(*) FILTER (WHERE doc_id % 2 <> 0 AND doc_id % 3 = 0) AS reserved_new, count(*) FILTER (WHERE doc_id % 2 = 0 AND doc_id % 3 = 0 AND doc_id % 5 <> 0) AS unchanged FROM labels")
def benchmark_verify(spark, d):
    g = _gold(spark, d)
    now = g.where("doc_id % 3 = 0").withColumn("label", F.when(F.col("doc_id") % 5 == 0, F.when(F.col("label") == "merge", "distinct").otherwise("merge")).otherwise(F.col("label")))
    return scoring.verified(g.where("doc_id % 2 = 0"), now)


@query("review_eligible", f"SELECT left_key, right_key FROM ({_GOLD}) WHERE left_key NOT IN ('k1', 'k2') AND right_key NOT IN (SELECT right_key FROM ({_GOLD} WHERE doc_id % 4 = 1))")
def review_eligible(spark, d):
    g = _gold(spark, d)
    losers = spark.createDataFrame([("k1",), ("k2",)], "loser_key string")
    return scoring.eligible(g.select("left_key", "right_key"), losers, g.where("doc_id % 4 = 1"))


@query("choose_winner", "SELECT doc_id, CASE WHEN quality < toxic THEN 'b' ELSE 'a' END AS winner, CASE WHEN quality < toxic THEN 'a' ELSE 'b' END AS loser FROM labels")
def choose_winner(spark, d):
    from plumbline.operators.canonical import chosen_winner

    w, x = chosen_winner(F.lit("a"), F.col("quality"), F.lit("b"), F.col("toxic"))
    return table(spark, d, "labels").select("doc_id", w.alias("winner"), x.alias("loser"))


_FIXED = scoring.Scorer({"n_chars": 0.8, "k": -0.5}, 0.25, {"n_chars": 1500.0}, {"n_chars": 900.0}, 1.966, 0.386)


@query("score_linear", "SELECT doc_id, round(1 / (1 + exp(-(1.966 * (0.25 + 0.8 * ((n_chars - 1500.0) / 900.0) - 0.5 * (doc_id % 3)) + 0.386))), 6) AS probability FROM documents")
def score_linear(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", (F.col("doc_id") % 3).alias("k"))
    return docs.select("doc_id", _FIXED.probability().alias("probability"))


@query("score_fit")
def score_fit(spark, d):
    """Fits and calibrates a scorer on the labelled documents and scores them all."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("doc_id", F.log1p("n_chars").alias("size"), (F.col("lang") == "en").cast("double").alias("english"), F.col("quality").alias("label"))
    f = sim.pair_fraction(F.col("doc_id").cast("string"), F.lit("doc"))
    split = docs.withColumn("split", sim.assigned_split(f))
    model = scoring.fit(split.where("split = 'train'"), ("size", "english"), ("english",))
    model = scoring.calibrated(model, split.where("split = 'calibration'"))
    return split.select("doc_id", "split", F.round(model.probability(), 3).alias("probability"))
