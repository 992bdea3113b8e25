"""Queries over pages, people, similar names and the normalisation experiments."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions import text
from plumbline.functions.html import parse_detail, parse_post
from plumbline.functions.people import extract_person, parsed_role
from plumbline.operators import blocking, evidence, people
from plumbline.plans.matching_plans import CTE, _SIM, orgs
from plumbline.sources.tables import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("parse_detail", "SELECT s_suppkey, s_name AS organization_name, CAST(2000 + s_suppkey % 25 AS VARCHAR) AS year, 'Gold ' || s_nationkey AS award, s_name || ', CEO' AS nomination_title, true AS complete FROM supplier")
def parse_detail_query(spark, d):
    """Detail pages made from suppliers, read back by the parser."""
    cell = lambda label, value: F.concat(F.lit(f"<tr><th>{label}:</th><td> "), value, F.lit(" </td></tr>"))
    year = (2000 + F.col("s_suppkey") % 25).cast("string")
    html = F.concat(F.lit("<html><h3>other</h3><h5>"), "s_name", F.lit(", CEO</h5><table>"), cell("Organization Name", F.col("s_name")), cell("YEAR", year), cell("Award", F.concat(F.lit("Gold "), F.col("s_nationkey").cast("string"))), F.lit("<tr><td>lone</td></tr></table></html>"))
    got = table(spark, d, "supplier").select("s_suppkey", parse_detail(html).alias("r")).select("s_suppkey", "r.organization_name", "r.year", "r.award", "r.nomination_title")
    return got.withColumn("complete", text.is_complete(F.col("organization_name"), F.col("year"), F.col("award")))


@query("parse_post", "SELECT page_id, 'Post ' || page_id AS title, 'A. Writer' AS author, 'seen at ' || url || ' here' AS clean_text, CASE WHEN starts_with(url, 'http') THEN url ELSE '' END AS links FROM pages")
def parse_post_query(spark, d):
    html = F.concat(F.lit('<meta property="og:title" content="Post '), F.col("page_id").cast("string"), F.lit('"><meta name="author" content="A. Writer"><div class="wide post-body">seen   at <a href="'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('">'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('</a>\n here <a href="/rel"></a></div>'))
    got = table(spark, d, "pages").select("page_id", parse_post(html).alias("p"))
    return got.select("page_id", "p.title", "p.author", "p.clean_text", F.array_join("p.links", " ").alias("links"))


_NAME = "upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2)"


def _titles(spark, d):
    k = F.col("p_partkey") % 4
    name = F.initcap("p_name")
    title = F.when(k == 0, F.concat(F.lit("Dr. "), name, F.lit(", CEO and Founder"))).when(k == 1, F.concat(name, F.lit(" SPHR - Manager"))).when(k == 2, F.concat(name, F.lit(" Group, Berlin"))).otherwise(F.lower(name))
    return table(spark, d, "part").select(F.col("p_partkey").alias("rec_id"), title.alias("title"), F.col("p_brand").alias("org_key"), F.when(k == 3, "Company of the Year").otherwise("Executive of the Year").alias("award"))


@query("extract_person", f"SELECT p_partkey AS rec_id, CASE WHEN p_partkey % 4 < 2 THEN {_NAME} END AS name, CASE p_partkey % 4 WHEN 0 THEN 'CEO and Founder' WHEN 2 THEN 'Berlin' END AS role FROM part")
def extract_person_query(spark, d):
    return _titles(spark, d).select("rec_id", extract_person(F.col("title")).alias("name"), parsed_role(F.col("title")).alias("role"))


@query("people_resolve", f"SELECT name, org_key, max(CASE WHEN k = 0 THEN 'CEO and Founder' END) AS role, CASE WHEN count(*) = 1 THEN 0.55 WHEN count(*) < 4 THEN 0.68 ELSE 0.80 END::DOUBLE AS confidence, count(*) AS n FROM (SELECT {_NAME} AS name, p_brand AS org_key, p_partkey % 4 AS k FROM part WHERE p_partkey % 4 < 2) GROUP BY 1, 2")
def people_resolve(spark, d):
    found = people.resolved_people(people.personal(_titles(spark, d)))
    return found.select("name", "org_key", "role", F.col("confidence").cast("double").alias("confidence"), F.size("rec_ids").cast("long").alias("n"))


@query("similar_top5", f"WITH {CTE['orgs']}, {CTE['gram']} SELECT key, other, round(s, 4) AS similarity FROM (SELECT a.key, b.key AS other, {_SIM} AS s, row_number() OVER (PARTITION BY a.key ORDER BY round({_SIM}, 9) DESC, b.key) AS rn FROM gram a JOIN gram b ON a.key <> b.key WHERE {_SIM} >= 0.4 - 1e-12) WHERE rn <= 5")
def similar_top5(spark, d):
    """The five most similar names of each name above the floor: the limit is the operator."""
    pairs = blocking.trigram_pairs(orgs(spark, d), 0.4)
    sides = F.array(F.struct(F.col("left_key").alias("key"), F.col("right_key").alias("other")), F.struct(F.col("right_key").alias("key"), F.col("left_key").alias("other")))
    both = pairs.select(F.explode(sides).alias("p"), "similarity").select("p.key", "p.other", "similarity")
    rn = F.row_number().over(Window.partitionBy("key").orderBy(F.desc(F.round("similarity", 9)), "other"))
    return both.withColumn("rn", rn).where("rn <= 5").select("key", "other", F.round("similarity", 4).alias("similarity"))


@query("similarity_bands", f"WITH {CTE['orgs']}, {CTE['gram']} SELECT CAST(floor(s * 10 + 1e-9) AS BIGINT) AS band, count(*) AS n FROM (SELECT {_SIM} AS s FROM gram a JOIN gram b ON a.key < b.key WHERE {_SIM} >= 0.4 - 1e-12) GROUP BY 1")
def similarity_bands(spark, d):
    return blocking.trigram_pairs(orgs(spark, d), 0.4).groupBy(F.floor(F.col("similarity") * 10 + 1e-9).alias("band")).agg(F.count("*").alias("n"))


@query("org_norm_experiment", """SELECT count(*) AS records, count(DISTINCT before) AS before_keys, count(DISTINCT after) AS after_keys, count(*) FILTER (WHERE before <> after) AS changed FROM (
 SELECT n || ' ' || f AS before, n AS after FROM (SELECT replace(lower(p_brand), '#', ' ') AS n, CASE p_partkey % 3 WHEN 0 THEN 'inc' WHEN 1 THEN 'gmbh' ELSE 'co ltd' END AS f FROM part))""")
def org_norm_experiment(spark, d):
    k = F.col("p_partkey") % 3
    name = F.concat("p_brand", F.when(k == 0, ", Inc.").when(k == 1, " GmbH").otherwise(" Co., Ltd."))
    keys = table(spark, d, "part").select(text.norm_key(name).alias("before")).withColumn("after", text.strip_legal_form(F.col("before")))
    return keys.agg(F.count("*").alias("records"), F.countDistinct("before").alias("before_keys"), F.countDistinct("after").alias("after_keys"), F.count_if(F.col("before") != F.col("after")).alias("changed"))


@query("cross_form_merges", "SELECT replace(lower(p_brand), '#', ' ') AS after, count(DISTINCT p_partkey % 3) AS variants, count(*) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey % 3) >= 2")
def cross_form_merges(spark, d):
    """Keys that several legal forms of one name fall into."""
    k = F.col("p_partkey") % 3
    name = F.concat("p_brand", F.when(k == 0, ", Inc.").when(k == 1, " GmbH").otherwise(" Co., Ltd."))
    keys = table(spark, d, "part").select(text.norm_key(name).alias("before")).withColumn("after", text.strip_legal_form(F.col("before")))
    return keys.groupBy("after").agg(F.countDistinct("before").alias("variants"), F.count("*").alias("n")).where("variants >= 2")


@query("query_expansion", "SELECT 'c' || n_nationkey AS subject, q AS query, a::INTEGER AS angle FROM nation, LATERAL (SELECT unnest([n_name || ' awards', n_name || ' news', n_name || ' awards']) AS q, unnest([0, 1, 2]) AS a) WHERE a < 2")
def query_expansion(spark, d):
    subjects = table(spark, d, "nation").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("subject"), F.col("n_name").alias("name"))
    return evidence.expanded_queries(subjects, ["{name} awards", "{name} news", "{name} awards"])


@query("ranked_subjects", "(SELECT 'organization' AS kind, 's' || c_custkey AS subject, c_name AS name, count(*) AS recognitions FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL ORDER BY recognitions DESC, subject LIMIT 10) UNION ALL (SELECT 'person', 'p' || p_partkey, p_name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL ORDER BY n DESC, 'p' || p_partkey LIMIT 5)")
def ranked_subjects(spark, d):
    """The most recognised subjects: the limits are the operator."""
    named = lambda df, mark, key, name: df.groupBy(F.concat(F.lit(mark), F.col(key).cast("string")).alias("slug"), F.col(name).alias("name")).agg(F.count("*").alias("recognitions"))
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    p = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return evidence.ranked_subjects(named(o, "s", "c_custkey", "c_name"), named(p, "p", "p_partkey", "p_name"), 10, 5)
