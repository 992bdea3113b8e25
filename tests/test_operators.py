"""Operators against small tables and brute force."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators import blocking, canonical, evidence, linking, people, rollups, scoring
from plumbline.sources import state, tables
from plumbline.streaming import telemetry


def test_trigram_join_is_exact(spark):
    names = [a + b for a, b in itertools.product(("north ", "nort ", "acme ", "acmes ", ""), ("labs", "lab", "laboratory", "holdings", "x"))]
    orgs = spark.createDataFrame([(i, n.strip(), n.strip()) for i, n in enumerate(names)], "id long, key string, name string").where("key <> ''")

    def grams(s):
        return {p[i : i + 3] for w in s.split() for p in [f"  {w} "] for i in range(len(p) - 2)}

    for t in (0.3, 0.4, 0.55):
        want = {tuple(sorted((a, b))) for a, b in itertools.combinations({n.strip() for n in names} - {""}, 2) if len(grams(a) & grams(b)) / len(grams(a) | grams(b)) >= t - 1e-12}
        assert {(r["left_key"], r["right_key"]) for r in blocking.trigram_pairs(orgs, t).collect()} == want


def test_acronyms(spark):
    orgs = spark.createDataFrame([(1, "ibm"), (2, "international business machines"), (3, "acm"), (4, "association for computing machinery"), (5, "b2b"), (6, "idc")], "id long, key string")
    assert {(r["left_key"], r["right_key"]) for r in blocking.acronym_pairs(orgs).collect()} == {("ibm", "international business machines"), ("acm", "association for computing machinery")}


def test_merge_pairs(spark):
    a = spark.createDataFrame([("a", 1, "b", 2, "trigram")], "left_key string, left_id long, right_key string, right_id long, reason string")
    b = spark.createDataFrame([("a", 1, "b", 2, "rare_token")], a.schema)
    assert [tuple(r) for r in blocking.merged_pairs(a, b).select("left_key", "right_key", F.array_join("reasons", ",")).collect()] == [("a", "b", "rare_token,trigram")]


def test_closure_and_cycle(spark):
    d = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("t", "x")], "loser_key string, winner_key string")
    assert dict(tuple(r) for r in canonical.merge_closure(d).collect()) == {"a": "c", "b": "c", "x": "x", "y": "y", "t": "x"}


def test_closure_of_long_chains_and_cycles(spark):
    rows = [(f"k{k}", f"k{k + 1}") for k in range(200)] + [(f"c{k}", f"c{(k + 1) % 7}") for k in range(7)] + [(f"t{k}", f"t{k + 1}" if k < 30 else "c3") for k in range(31)] + [("self", "self"), ("many", "b"), ("many", "a"), (None, "a"), ("n", None)]
    got = [tuple(r) for r in canonical.merge_closure(spark.createDataFrame(rows, "loser_key string, winner_key string")).collect()]
    want = {f"k{k}": "k200" for k in range(200)} | {f"c{k}": f"c{k}" for k in range(7)} | {f"t{k}": "c3" for k in range(31)} | {"self": "self", "many": "a"}
    assert len(got) == len(want) and dict(got) == want
    assert canonical.merge_closure(spark.createDataFrame([], "loser_key string, winner_key string")).count() == 0


def test_slugs_pass_over_many_taken_numbers(spark):
    rows = [("x", 0)] + [(f"x {k}", k) for k in range(2, 14)] + [("x" + " -" * k, 100 + k) for k in range(1, 6)] + [("x 02", 50)]
    got = {r["norm_key"]: r["slug"] for r in canonical.with_slugs(spark.createDataFrame([(k, k, n) for k, n in rows], "norm_key string, name string, first_seq int")).collect()}
    assert len(got) == len(rows) == len(set(got.values())) and got["x"] == "x" and got["x 13"] == "x-13" and got["x 02"] == "x-02"
    assert {got["x" + " -" * k] for k in range(1, 6)} == {f"x-{n}" for n in range(14, 19)}


def test_slugs_stay_unique(spark):
    rows = spark.createDataFrame([("john smith", "John Smith", 1), ("john-smith", "John-Smith", 2), ("john smith 2", "x", 3), ("john smith-2", "y", 4)], "norm_key string, name string, first_seq int")
    slugs = {r["norm_key"]: r["slug"] for r in canonical.with_slugs(rows).collect()}
    assert len(set(slugs.values())) == 4 and slugs["john smith"] == "john-smith" and slugs["john smith 2"] == "john-smith-2"


def test_people(spark):
    rows = spark.createDataFrame([(1, "John Smith, CEO", "a"), (2, "John Smith, CFO", "a"), (3, "John Smith, CTO", "b"), (4, "Leadership for all", "b")], "rec_id long, title string, org_key string")
    found = {r["slug"]: (r["org_key"], float(r["confidence"]), r["role"], r["rec_ids"]) for r in people.resolved_people(rows).collect()}
    assert found == {"john-smith": ("a", 0.68, "CEO", [1, 2]), "john-smith-2": ("b", 0.55, "CTO", [3])}


def test_mentions(spark):
    vocab = linking.vocabulary(
        spark.createDataFrame([(1, "iba", "International Business Awards")], "id long, slug string, name string"),
        spark.createDataFrame([(2, "cs", "Customer Service Team"), (3, "sales", "Sales")], "id long, slug string, name string"),
        spark.createDataFrame([(4, "ibm", "IBM"), (5, "acme-co", "Acme Widgets")], "id long, slug string, name string"),
    )
    texts = spark.createDataFrame([(1, "At the 2013 International Business Awards, Acme Widgets' Customer Service Team and IBM Sales won.")], "doc_id long, text string")
    found = linking.mentions(texts, vocab)
    assert {r["entity_slug"] for r in found.collect()} == {"iba", "cs", "acme-co"}
    editions = spark.createDataFrame([(1, 2013, "iba-2013")], "program_id long, year int, slug string")
    assert [r["entity_slug"] for r in linking.edition_edges(found, texts, editions).collect()] == ["iba-2013"]


@pytest.mark.parametrize("text,name,kind,url,want", [
    ("we visited acme today", "Acme Holdings Inc", "organization", None, True), ("nothing here", "Acme Inc", "organization", "https://acme.com/x", True), ("nothing", "Acme", "organization", "https://b.com", False),
    ("Dr Jose Ozdemir spoke", "José Özdemir", "person", None, True), ("he ran", "Emma He", "person", None, False), ("Frost is cold", "Robert Frost", "person", None, True), ("x", "", "person", None, True),
])
def test_name_gate(spark, text, name, kind, url, want):
    row = spark.createDataFrame([(text, name, kind, url)], "text string, name string, kind string, url string")
    assert evidence.folded_subjects(row).select(evidence.subject_mentioned(F.col("kind")).alias("v")).first()["v"] is want


def test_scorer_fits_and_calibrates(spark):
    rows = spark.range(400).select((F.col("id") % 20 / 20.0).alias("x"), ((F.col("id") * 7) % 3 == 0).cast("int").alias("b"), (F.col("id") % 20 + (F.col("id") * 7) % 3 > 11).cast("int").alias("label"))
    one, two = scoring.fit(rows, ("x", "b"), ("b",)), scoring.fit(rows, ("x", "b"), ("b",))
    assert one == two and one.weights["x"] > 0
    model = scoring.calibrated(one, rows)
    ranked = rows.select(one.decision().alias("d"), model.probability().alias("p")).orderBy("d").collect()
    assert all(a["p"] <= b["p"] for a, b in zip(ranked, ranked[1:]))


def test_contamination_raises(spark):
    frozen = spark.createDataFrame([("a", "b", "merge")], "left_key string, right_key string, label string")
    with pytest.raises(scoring.Contaminated):
        scoring.assert_clean(frozen, frozen)
    scoring.assert_clean(frozen.where("false"), frozen)


def test_select_queue(spark):
    pairs = spark.createDataFrame([(f"a{i}", "b", i / 100) for i in range(100)], "left_key string, right_key string, probability double")
    queue = scoring.selected_queue(pairs, 10, 0.3, F.col("probability")).collect()
    assert [sum(r["strategy"] == s for r in queue) for s in ("uncertainty", "random")] == [7, 3] and len({r["left_key"] for r in queue}) == 10


def test_frozen_registry(spark):
    registry = spark.createDataFrame([("v1", "{}"), ("v2", None)], "model_version string, metrics_summary string")
    state.guard_frozen(registry, "v2")
    with pytest.raises(state.FrozenVersion):
        state.guard_frozen(registry, "v1")


def test_label_corpus(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text(json.dumps({"key_a": "b", "key_b": "a", "label": "merge"}) + "\n")
    (tmp_path / "two.jsonl").write_text(json.dumps({"key_a": "a", "key_b": "b", "label": "distinct"}) + "\n" + json.dumps({"key_a": "c", "key_b": "d", "label": "merge"}) + "\n")
    (tmp_path / "corpus.json").write_text(json.dumps({"components": [{"file": "one.jsonl"}, {"file": "two.jsonl"}, {"file": "gone.jsonl"}]}))
    rows, missing = tables.label_corpus(spark, str(tmp_path / "corpus.json"))
    assert missing == ["gone.jsonl"]
    assert {tuple(r) for r in rows.select("left_key", "right_key", "label", "_component").collect()} == {("a", "b", "merge", "one.jsonl"), ("c", "d", "merge", "two.jsonl")}


def test_sitemap(spark):
    xml = spark.createDataFrame([('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://a/1 </loc></url></urlset>',), ("<sitemapindex><sitemap><loc>https://a/s.xml</loc></sitemap></sitemapindex>",)], "xml string")
    assert {tuple(r) for r in tables.sitemap_locations(xml).collect()} == {(False, "https://a/1"), (True, "https://a/s.xml")}


def test_raw_pages_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("u", "<p>é</p>", "detail"), ("v", "x", "blog")], "url string, html string, page_type string")
    pages.select("url", "page_type", tables.zipped("html").alias("body")).write.parquet(str(tmp_path / "raw"))
    assert [r["html"] for r in tables.raw_pages(spark, str(tmp_path / "raw"), "detail").collect()] == ["<p>é</p>"]


def test_refresh_derived(spark, data, tmp_path):
    made = rollups.refresh_derived(tables.recognitions(spark, data), str(tmp_path))
    assert list(made) == ["organization_stats", "category_stats", "country_stats", "program_stats", "timeline_stats"]
    assert spark.read.parquet(made["timeline_stats"]).count() > 0


def test_queue_machine_streams(spark, tmp_path):
    spark.createDataFrame([(1, False), (1, True), (2, False), (2, False), (2, False), (2, False), (3, False)], "node_id long, ok boolean").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("node_id long, ok boolean").parquet(str(tmp_path / "in"))
    rows = telemetry.run_to_end(telemetry.queue_states(stream), str(tmp_path / "out"), "update", str(tmp_path / "cp"))
    assert {r["node_id"]: (r["status"], r["attempts"]) for r in rows.collect()} == {1: ("done", 2), 2: ("failed", 4), 3: ("pending", 1)}


def test_incremental_scoring(spark, tmp_path):
    source = str(tmp_path / "in")
    for ids in ((1, 2), (2, 3)):
        spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id long").parquet(source)
        telemetry.incremental(stream, lambda df: df.withColumn("score", F.col("id") * 2), str(tmp_path / "out"), ["id"], str(tmp_path / "cp"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_gates_stop_a_stream_before_a_bad_batch(spark, tmp_path):
    from plumbline.operators.gates import Gate

    source = str(tmp_path / "in")
    gates = lambda b: [Gate("no negative ids", b, F.count_if(F.col("id") < 0), "=", 0)]
    run = lambda: telemetry.gated(telemetry.cursor_stream(spark, "id long", source, 1), gates, str(tmp_path / "out"), str(tmp_path / "cp"))
    spark.createDataFrame([(1,), (2,)], "id long").coalesce(1).write.mode("append").parquet(source)
    assert sorted(r["id"] for r in run().collect()) == [1, 2]
    spark.createDataFrame([(-3,)], "id long").coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="no negative ids"):
        run()
    assert sorted(r["id"] for r in spark.read.schema("id long").option("recursiveFileLookup", "true").parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_texts_enter_once_in_a_run(spark, tmp_path):
    source = str(tmp_path / "in")
    for texts in (("a", "b"), ("b", "c"), (None, "a")):
        spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("append").parquet(source)
    stream = telemetry.first_of_each_text(telemetry.cursor_stream(spark, "text string", source, 1), "text").select("text")
    got = telemetry.run_to_end(stream, str(tmp_path / "out"), "append", str(tmp_path / "cp")).collect()
    assert sorted(str(r["text"]) for r in got) == ["None", "a", "b", "c"]


def test_sampler_appends(spark, tmp_path):
    got = telemetry.sampled(spark, lambda ticks: ticks.select("timestamp", F.lit("queue").alias("what")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert got.columns == ["timestamp", "what"] and got.count() >= 1
