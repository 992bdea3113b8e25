"""Queries over the fact table: rollups, views, gates, reports, rates, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.similarity import wilson
from plumbline.functions.trust import entity_reasons, entity_score
from plumbline.operators import canonical, gates, rollups
from plumbline.sources.tables import RECOGNITIONS_SQL, recognitions, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql if "recognitions" not in sql else f"WITH {RECOGNITIONS_SQL}\n{sql}"
        return f

    return add


_LEVELS = ", ".join(f"count(*) FILTER (WHERE level = '{x}') AS {x}" for x in rollups.LEVELS)
_PRESTIGE = "round(sum(CASE level " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rollups.PRESTIGE.items()) + " ELSE 0.0 END)::DOUBLE, 1) AS prestige_score"
_ORG = f"""SELECT org_id, org_name, count(*) AS total_recognitions, {_LEVELS}, min(year) AS first_win_year, max(year) AS latest_win_year,
 count(DISTINCT year) AS active_years, count(DISTINCT category) AS category_diversity, count(DISTINCT country_id) AS country_spread,
 count(DISTINCT (program_id, year)) AS editions_entered, {_PRESTIGE}, round(count(*)::DOUBLE / nullif(count(DISTINCT year), 0), 2) AS avg_wins_per_active_year
 FROM recognitions GROUP BY org_id, org_name"""


@query("org_stats", _ORG)
def org_stats(spark, d):
    return rollups.organization_stats(recognitions(spark, d))


@query("category_stats", "SELECT category, count(*) AS total_recognitions, count(DISTINCT org_id) AS distinct_recipients, count(DISTINCT year) AS active_years, min(year) AS first_year, max(year) AS latest_year FROM recognitions GROUP BY category")
def category_stats(spark, d):
    return rollups.category_stats(recognitions(spark, d))


@query("country_stats", "SELECT country_id, country, count(*) AS total_recognitions, count(DISTINCT org_id) AS distinct_recipients, count(DISTINCT category) AS category_diversity, min(year) AS first_year, max(year) AS latest_year FROM recognitions GROUP BY country_id, country")
def country_stats(spark, d):
    return rollups.country_stats(recognitions(spark, d))


@query("program_stats", "SELECT program_id, count(*) AS total_recognitions, count(DISTINCT year) AS editions, count(DISTINCT org_id) AS distinct_recipients, min(year) AS first_year, max(year) AS latest_year FROM recognitions GROUP BY program_id")
def program_stats(spark, d):
    return rollups.program_stats(recognitions(spark, d))


@query("timeline_stats", """SELECT year, count(*) AS total_recognitions, count(*) FILTER (WHERE level = 'gold') AS gold, count(*) FILTER (WHERE level = 'silver') AS silver,
 count(*) FILTER (WHERE level = 'bronze') AS bronze, count(*) FILTER (WHERE level = 'finalist') AS finalist, count(DISTINCT org_id) AS distinct_recipients, count(DISTINCT country_id) AS distinct_countries,
 count(DISTINCT category) AS distinct_categories, count(DISTINCT program_id) AS distinct_editions FROM recognitions WHERE year IS NOT NULL GROUP BY year""")
def timeline_stats(spark, d):
    return rollups.timeline_stats(recognitions(spark, d))


@query("org_roles", "SELECT DISTINCT org_id, CASE WHEN level = 'finalist' THEN 'entrant' ELSE 'recipient' END AS role FROM recognitions")
def org_roles(spark, d):
    return recognitions(spark, d).select("org_id", F.when(F.col("level") == "finalist", "entrant").otherwise("recipient").alias("role")).distinct()


_LINKS = """links AS (SELECT node_id, 'country' AS entity_type, country AS entity_id FROM recognitions UNION ALL SELECT node_id, 'program', CAST(program_id AS VARCHAR) FROM recognitions
 UNION ALL SELECT node_id, 'category_definition', category FROM recognitions UNION ALL SELECT node_id, 'organization', CAST(org_id AS VARCHAR) FROM recognitions),
trust AS (SELECT entity_type, entity_id, n, round(greatest(0.0, least(1.0, CASE WHEN entity_type = 'organization' THEN 0.70 ELSE 0.85 END::DOUBLE + CASE WHEN n >= 10 THEN 0.10 WHEN n >= 3 THEN 0.05 WHEN n = 2 THEN 0.0 ELSE -0.30 END::DOUBLE)), 4) AS score
 FROM (SELECT entity_type, entity_id, count(*) AS n FROM links GROUP BY ALL))"""


def _links(spark, d):
    return canonical.ledger(recognitions(spark, d), {"country": "country", "program_id": "program", "category": "category_definition", "org_id": "organization"})


def _trust(links):
    n = links.groupBy("entity_type", "entity_id").agg(F.count("*").alias("n"))
    return n.withColumn("score", entity_score(F.col("entity_type"), F.col("n"))).withColumn("reasons", entity_reasons(F.col("entity_type"), F.col("n")))


def _with_links(body: str) -> str:
    return f"WITH {RECOGNITIONS_SQL}, {_LINKS} {body}"


@query("entity_links")
def entity_links(spark, d):
    return _links(spark, d)


SQL["entity_links"] = _with_links("SELECT * FROM links")


@query("fact_confidence")
def fact_confidence(spark, d):
    return _trust(_links(spark, d)).select("entity_type", "entity_id", "n", "score", F.array_join("reasons", " | ").alias("reasons"))


SQL["fact_confidence"] = _with_links("""SELECT entity_type, entity_id, n, score, CASE WHEN entity_type = 'organization' THEN 'free-text entity (organization) — trust leans on corroboration'
 ELSE 'controlled-vocabulary dimension (' || entity_type || ')' END || ' | ' || CASE WHEN n >= 10 THEN 'well-corroborated: appears in ' || n || ' recognitions' WHEN n >= 3 THEN 'corroborated: appears in ' || n || ' recognitions'
 WHEN n = 2 THEN 'appears in 2 recognitions' ELSE 'singleton — appears in only 1 recognition (unverified)' END AS reasons FROM trust""")


@query("recognition_confidence")
def recognition_confidence(spark, d):
    links = _links(spark, d)
    return rollups.recognition_confidence(links, _trust(links).select("entity_type", "entity_id", "score"))


SQL["recognition_confidence"] = _with_links("""SELECT node_id, round(min(score), 4) AS min_score, round(avg(score), 4) AS avg_score, count(*) AS n_dimensions,
 CASE WHEN min(score) >= 0.85 THEN 'high' WHEN min(score) >= 0.65 THEN 'medium' ELSE 'low' END AS band FROM links JOIN trust USING (entity_type, entity_id) GROUP BY node_id""")


@query("confidence_report")
def confidence_report(spark, d):
    t = _trust(_links(spark, d))
    band = F.when(F.col("score") >= 0.85, "high").when(F.col("score") >= 0.65, "medium").otherwise("low")
    return t.groupBy("entity_type", band.alias("band")).agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("avg_score"), F.count_if(F.col("n") == 1).alias("singletons"))


SQL["confidence_report"] = _with_links("""SELECT entity_type, CASE WHEN score >= 0.85 THEN 'high' WHEN score >= 0.65 THEN 'medium' ELSE 'low' END AS band, count(*) AS n, round(avg(score), 4) AS avg_score,
 count(*) FILTER (WHERE trust.n = 1) AS singletons FROM trust GROUP BY 1, 2""")


@query("confidence_tail")
def confidence_tail(spark, d):
    return rollups.top(_trust(_links(spark, d)).select("entity_type", "entity_id", "n", "score"), 8, F.asc("score"), F.asc("n"), F.asc("entity_type"), F.asc("entity_id"))


SQL["confidence_tail"] = _with_links("SELECT entity_type, entity_id, n, score FROM trust ORDER BY score, n, entity_type, entity_id LIMIT 8")


@query("report_by_level", "SELECT level, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM recognitions GROUP BY level")
def report_by_level(spark, d):
    n = recognitions(spark, d).groupBy("level").agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))  # a row per level


@query("report_topk", f"SELECT org_id, org_name, total_recognitions, prestige_score FROM ({_ORG.replace('FROM recognitions', 'FROM recognitions')}) ORDER BY prestige_score DESC, org_id LIMIT 15")
def report_topk(spark, d):
    return rollups.top(rollups.organization_stats(recognitions(spark, d)), 15, F.desc("prestige_score"), F.asc("org_id")).select("org_id", "org_name", "total_recognitions", "prestige_score")


@query("report_scalars", """SELECT count(*) AS recognitions, count(DISTINCT org_id) AS organizations, count(DISTINCT country_id) AS countries, count(DISTINCT category) AS categories,
 count(DISTINCT (program_id, year)) AS editions, min(year) AS first_year, max(year) AS latest_year FROM recognitions""")
def report_scalars(spark, d):
    return recognitions(spark, d).agg(F.count("*").alias("recognitions"), F.countDistinct("org_id").alias("organizations"), F.countDistinct("country_id").alias("countries"), F.countDistinct("category").alias("categories"), F.countDistinct("program_id", "year").alias("editions"), F.min("year").alias("first_year"), F.max("year").alias("latest_year"))


@query("program_year_rollup", "SELECT program_id, year, count(*) AS n FROM recognitions GROUP BY ROLLUP (program_id, year)")
def program_year_rollup(spark, d):
    """An extension: subtotals by program and year."""
    return recognitions(spark, d).rollup("program_id", "year").agg(F.count("*").alias("n"))


@query("gates", """SELECT 'no duplicate node_ids' AS gate, CAST(count(*) - count(DISTINCT node_id) AS DOUBLE) AS value, count(*) = count(DISTINCT node_id) AS passed FROM recognitions
 UNION ALL SELECT 'no recognitions without an entrant', 0.0, true UNION ALL SELECT 'no orphan parties', (SELECT count(*)::DOUBLE FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)), (SELECT count(*) = 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
 UNION ALL SELECT 'program coverage', 100.0, true UNION ALL SELECT 'organization coverage', 100.0, true UNION ALL SELECT 'country coverage', 100.0, true
 UNION ALL SELECT 'level known', round(100.0 * count(*) FILTER (WHERE level <> 'other') / count(*), 4), true FROM recognitions
 UNION ALL SELECT 'parse completeness', round(100.0 * count(*) FILTER (WHERE trim(html) <> '' AND trim(url) <> '') / count(*), 4), 100.0 * count(*) FILTER (WHERE trim(html) <> '' AND trim(url) <> '') / count(*) > 99 FROM pages
 UNION ALL SELECT 'no orphaned merge winners', 0.0, true UNION ALL SELECT 'alias covers all merge losers', 0.0, true""")
def gates_query(spark, d):
    facts = recognitions(spark, d)
    parsed = table(spark, d, "pages").select(((F.trim("html") != "") & (F.trim("url") != "")).alias("complete"))
    none = spark.createDataFrame([], "loser_key string, winner_key string, decision string")
    orgs = table(spark, d, "customer").select(F.lower("c_name").alias("norm_key"))
    alias = spark.createDataFrame([], "alias_key string")
    return gates.checked(gates.standard_gates(facts, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("node_id")), parsed, none, orgs, alias))


_QUEUE = "queue AS (SELECT o_orderkey AS node_id, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status, o_orderkey % 5 AS attempts FROM orders)"


def _queue(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("node_id"), F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed").alias("status"), (F.col("o_orderkey") % 5).alias("attempts"))


@query("acquisition_status", f"WITH {_QUEUE} SELECT count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'fetching') AS fetching, count(*) FILTER (WHERE status = 'done') AS done, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) AS queued, (SELECT count(*) FROM pages) AS reported, false AS complete FROM queue")
def acquisition_status(spark, d):
    return rollups.queue_status(_queue(spark, d), table(spark, d, "pages").agg(F.count("*").alias("reported")))


@query("harvest_gate", f"WITH {_QUEUE} SELECT 'queue is not empty' AS gate, count(*)::DOUBLE AS value, count(*) > 0 AS passed FROM queue UNION ALL SELECT 'all reported ids queued', count(DISTINCT node_id)::DOUBLE, count(DISTINCT node_id) >= 100 FROM queue UNION ALL SELECT 'no duplicate ids', (count(*) - count(DISTINCT node_id))::DOUBLE, count(*) = count(DISTINCT node_id) FROM queue")
def harvest_gate(spark, d):
    return gates.checked(gates.harvest_gates(_queue(spark, d), 100))


@query("fetch_gate", f"WITH {_QUEUE} SELECT 'nothing pending' AS gate, count(*) FILTER (WHERE status = 'pending')::DOUBLE AS value, count(*) FILTER (WHERE status = 'pending') = 0 AS passed FROM queue UNION ALL SELECT 'nothing in flight', 0.0, true UNION ALL SELECT 'nothing failed', count(*) FILTER (WHERE status = 'failed')::DOUBLE, count(*) FILTER (WHERE status = 'failed') = 0 FROM queue UNION ALL SELECT 'fetched all reported', count(*) FILTER (WHERE status = 'done')::DOUBLE, count(*) FILTER (WHERE status = 'done') >= 100 FROM queue")
def fetch_gate(spark, d):
    return gates.checked(gates.fetch_gates(_queue(spark, d), 100))


@query("queue_settle", f"""WITH {_QUEUE} SELECT q.node_id, CASE WHEN q.node_id % 3 = 2 OR q.status = 'done' THEN q.status WHEN q.node_id % 3 = 0 THEN 'done' WHEN attempts + 1 >= 4 THEN 'failed' ELSE 'pending' END AS status,
 CAST(attempts + CASE WHEN q.node_id % 3 = 2 OR q.status = 'done' THEN 0 ELSE 1 END AS BIGINT) AS attempts FROM queue q""")
def queue_settle(spark, d):
    from plumbline.sources.state import settled

    q = _queue(spark, d)
    outcome = q.where("node_id % 3 <> 2 and status <> 'done'").select("node_id", (F.col("node_id") % 3 == 0).alias("ok"))
    return settled(q, outcome)


@query("queue_claim", f"WITH {_QUEUE} SELECT node_id, 'fetching' AS status, attempts FROM queue WHERE status = 'pending' ORDER BY node_id LIMIT 8")
def queue_claim(spark, d):
    """The claim of a worker: its limit is the operator."""
    from plumbline.sources.state import claimed

    return claimed(_queue(spark, d), 8)


@query("fetch_rate_lag", """SELECT source, ts, fetched, fetched - lag(fetched) OVER w AS gained, round((fetched - lag(fetched) OVER w) * 1e6 / nullif(epoch_us(ts) - lag(epoch_us(ts)) OVER w, 0), 2) AS rate_per_s
 FROM (SELECT event_type AS source, ts, event_id AS fetched FROM events) WINDOW w AS (PARTITION BY source ORDER BY ts)""")
def fetch_rate_lag(spark, d):
    return rollups.fetch_rate(table(spark, d, "events").select(F.col("event_type").alias("source"), "ts", F.col("event_id").alias("fetched")))


@query("latest_run", "SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY user_id")
def latest_run(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max("ts").alias("ts"))


@query("coverage_scan_except", "(SELECT 'only_customers' AS side, c_nationkey AS k FROM customer EXCEPT SELECT 'only_customers', s_nationkey FROM supplier WHERE s_acctbal > 5000) UNION ALL (SELECT 'only_suppliers', s_nationkey FROM supplier WHERE s_acctbal > 5000 EXCEPT SELECT 'only_suppliers', c_nationkey FROM customer)")
def coverage_scan_except(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"))
    s = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    return c.subtract(s).select(F.lit("only_customers").alias("side"), "k").unionByName(s.subtract(c).select(F.lit("only_suppliers").alias("side"), "k"))


@query("org_context", """SELECT org_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories, array_to_string(list_sort(list(DISTINCT level)), ',') AS levels FROM recognitions GROUP BY org_id""")
def org_context(spark, d):
    sets = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return recognitions(spark, d).groupBy("org_id").agg(F.count("*").alias("n"), sets("category").alias("categories"), sets("level").alias("levels"))


@query("orphan_parties", "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority <> '5-LOW') GROUP BY l_orderkey")
def orphan_parties(spark, d):
    high = table(spark, d, "orders").where("o_orderpriority <> '5-LOW'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").select("l_orderkey").join(high, "l_orderkey", "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("systematic_sample", "SELECT node_id, org_id FROM (SELECT node_id, org_id, row_number() OVER (PARTITION BY year ORDER BY node_id) AS rn FROM recognitions) WHERE rn % 50 = 1")
def systematic_sample(spark, d):
    """Every fiftieth recognition of a year: the sample is the operator."""
    rn = F.row_number().over(Window.partitionBy("year").orderBy("node_id"))
    return recognitions(spark, d).withColumn("rn", rn).where("rn % 50 = 1").select("node_id", "org_id")


@query("stratified_sample", """SELECT level, node_id FROM (SELECT level, node_id, row_number() OVER (PARTITION BY level ORDER BY sha256(CAST(node_id AS VARCHAR))) AS rn FROM recognitions) WHERE rn <= 20""")
def stratified_sample(spark, d):
    """Twenty recognitions of each level in hash order: the sample is the operator."""
    rn = F.row_number().over(Window.partitionBy("level").orderBy(F.sha2(F.col("node_id").cast("string"), 256)))
    return recognitions(spark, d).withColumn("rn", rn).where("rn <= 20").select("level", "node_id")


@query("mode_key", "SELECT org_id, min(category) AS category, max(n) AS n FROM (SELECT org_id, category, n, max(n) OVER (PARTITION BY org_id) AS top FROM (SELECT org_id, category || ':' || level AS category, count(*) AS n FROM recognitions GROUP BY ALL)) WHERE n = top GROUP BY org_id")
def mode_key(spark, d):
    """Commonest value per organisation; ties go to the smaller one."""
    n = recognitions(spark, d).groupBy("org_id", F.concat_ws(":", "category", "level").alias("category")).agg(F.count("*").alias("n"))
    return n.groupBy("org_id").agg(F.min_by("category", F.struct(-F.col("n"), "category")).alias("category"), F.max("n").alias("n"))


@query("median_density", "SELECT program_id, median(n)::DOUBLE AS median_n FROM (SELECT program_id, org_id, count(*) AS n FROM recognitions GROUP BY ALL) GROUP BY program_id")
def median_density(spark, d):
    return recognitions(spark, d).groupBy("program_id", "org_id").agg(F.count("*").alias("n")).groupBy("program_id").agg(F.median("n").alias("median_n"))


_W = "(p + 1.9208 / n - 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n)"


@query("wilson", f"SELECT category, k, n, round(greatest(0.0, {_W}), 4) AS low, round(least(1.0, {_W.replace('- 1.96', '+ 1.96')}), 4) AS high FROM (SELECT category, k, n, k::DOUBLE / n AS p FROM (SELECT category, count(*) FILTER (WHERE level = 'gold') AS k, count(*) AS n FROM recognitions GROUP BY category))")
def wilson_query(spark, d):
    k = recognitions(spark, d).groupBy("category").agg(F.count_if(F.col("level") == "gold").alias("k"), F.count("*").alias("n"))
    low, high = wilson(F.col("k"), F.col("n"))
    return k.select("category", "k", "n", F.round(low, 4).alias("low"), F.round(high, 4).alias("high"))


@query("slugify_unique", """SELECT norm_key, name, n_rows, CASE WHEN rn = 1 THEN base ELSE base || '-' || rn END AS slug FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY first_seq, norm_key) AS rn FROM (
 SELECT norm_key, min_by(name, seq) AS name, min(seq) AS first_seq, count(*) AS n_rows, replace(norm_key, ' ', '-') AS base FROM (SELECT lower(p_name) AS norm_key, p_name AS name, p_partkey AS seq FROM part UNION ALL SELECT replace(lower(p_name), ' ', '-'), replace(p_name, ' ', '-'), p_partkey + 1000000 FROM part) GROUP BY norm_key))""")
def slugify_unique(spark, d):
    from plumbline.functions.text import norm_key

    p = table(spark, d, "part").select("p_name", F.col("p_partkey").alias("seq"))
    both = p.union(p.select(F.replace("p_name", F.lit(" "), F.lit("-")), F.col("seq") + 1000000))
    return canonical.dimension(both, norm_key(F.col("p_name")), F.col("p_name"), F.col("seq")).select("norm_key", "name", "n_rows", "slug")


#: Chains of up to 99 parts, and ten cycles of three.
_CHAIN = """RECURSIVE dec AS (SELECT 'part ' || p_partkey AS loser_key, 'part ' || (p_partkey - 1) AS winner_key FROM part WHERE p_partkey % 100 <> 0 UNION ALL SELECT 'ring ' || i || ' ' || j, 'ring ' || i || ' ' || ((j + 1) % 3) FROM range(10) a(i), range(3) b(j)),
 walk AS (SELECT loser_key, winner_key AS stop, [loser_key] AS seen FROM dec UNION ALL SELECT walk.loser_key, dec.winner_key, list_append(seen, walk.stop) FROM walk JOIN dec ON dec.loser_key = walk.stop WHERE NOT list_contains(seen, walk.stop)),
 closed AS (SELECT loser_key, arg_max(stop, len(seen)) AS canonical_key FROM walk GROUP BY 1)"""


def _decisions(spark, d):
    key = lambda c: F.concat(F.lit("part "), c.cast("string"))
    chains = table(spark, d, "part").where("p_partkey % 100 <> 0").select(key(F.col("p_partkey")).alias("loser_key"), key(F.col("p_partkey") - 1).alias("winner_key"))
    ring = spark.range(30).selectExpr("concat('ring ', id div 3, ' ', id % 3)", "concat('ring ', id div 3, ' ', (id % 3 + 1) % 3)")
    return chains.union(ring)


@query("merge_closure", f"WITH {_CHAIN} SELECT * FROM closed")
def merge_closure(spark, d):
    return canonical.merge_closure(_decisions(spark, d))


@query("alias_table", f"WITH {_CHAIN} SELECT loser_key AS alias_key, canonical_key, 'part-' || p_partkey AS slug FROM closed JOIN part ON canonical_key = 'part ' || p_partkey")
def alias_table(spark, d):
    orgs = table(spark, d, "part").select(F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("norm_key"), F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("slug"))
    return canonical.aliases(canonical.merge_closure(_decisions(spark, d)), orgs)


@query("canonical_orgs", """SELECT coalesce(w, key) AS key, count(*) AS n_rows, min(c_custkey) AS first_seq FROM (SELECT c_custkey, replace(lower(c_mktsegment), '-', ' ') AS key FROM customer) LEFT JOIN (SELECT min(k) AS l, max(k) AS w FROM (SELECT DISTINCT replace(lower(c_mktsegment), '-', ' ') AS k FROM customer)) ON l = key GROUP BY 1""")
def canonical_orgs(spark, d):
    """Customers by segment, with the first segment merged into the last."""
    from plumbline.functions.text import norm_key, strip_legal_form

    rows = table(spark, d, "customer").select(strip_legal_form(norm_key(F.concat("c_mktsegment", F.lit(", Inc.")))).alias("key"), F.col("c_custkey").alias("seq"))
    merged = rows.agg(F.min("key").alias("loser_key"), F.max("key").alias("winner_key"))
    closed = canonical.resolved(rows, canonical.merge_closure(merged), "key")
    return closed.groupBy(F.col("canonical_key").alias("key")).agg(F.count("*").alias("n_rows"), F.min("seq").alias("first_seq"))
