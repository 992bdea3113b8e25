"""WARC, URL reputation and nearest neighbours."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import neighbours, urls, warc
from plumbline.llm.common import scratch
from plumbline.llm.queries import QUERIES, table

PAGES = [(1, "http://a.b/1", "<p>é</p>", "x"), (2, "http://a.b/2", "<p>é</p>", "x"), (3, None, None, "x"), (4, "http://a.b/4\r\nX: y", "", "x"), (5, "u", "WARC/1.1\r\n\r\nfake\r\n\r\n" * 50_000, "x"), (None, "u", "<p>é</p>", "x"), (7, "u", "unique", "x"), (7, "u", "unique", "x")]
SCHEMA = "page_id long, url string, html string, digest string"


def b32(s):
    return base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()


def test_warc_round_trip(spark):
    folder = scratch(spark, "warc-test")
    manifest = warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), folder)
    records = warc.read_archives(manifest, folder, with_payload=True)
    assert {r["kind"]: r["count"] for r in records.groupBy("kind").count().collect()} == {"request": 8, "metadata": 8, "response": 6, "revisit": 2}
    rows = [(r["metadata"]["page_id"], r["response"]) for r in warc.transactions(records).collect()]
    got = sorted(((p, x["kind"], x["payload_bytes"], x["digest"] or x["declared"], x["refers_page"]) for p, x in rows), key=str)
    size = lambda s: len(s.encode())
    want = [(1, "response", size("<p>é</p>"), b32("<p>é</p>"), None), (2, "revisit", size("<p>é</p>"), b32("<p>é</p>"), 1), (3, "response", 0, b32(""), None), (4, "revisit", 0, b32(""), 3), (5, "response", size(PAGES[4][2]), b32(PAGES[4][2]), None), (None, "response", size("<p>é</p>"), b32("<p>é</p>"), None), (7, "response", 6, b32("unique"), None), (7, "response", 6, b32("unique"), None)]
    assert got == sorted(want, key=str)
    assert {bytes(x["payload"]) for p, x in rows if p == 5} == {PAGES[4][2].encode()}
    assert {x["target"] for p, x in rows if p in (3, 4)} == {None, "http://a.b/4%0D%0AX: y"}


def test_repeated_rows_are_read_as_often_as_written(spark):
    rows = [(7, "u", "same")] * 5 + [(7, "v", "same")] * 3 + [(7, "u", "other")] + [(8, "u", "same")] * 4 + [(9, None, "same")] + [(None, "n", "same")] * 2
    folder = scratch(spark, "warc-test")
    records = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), folder), folder)
    got = [(x["metadata"]["page_id"], x["request"]["target"], x["response"]["target"], x["response"]["kind"], x["response"]["digest"] or x["response"]["declared"], x["response"]["refers_page"]) for x in warc.transactions(records).collect()]
    want = [(p, u, u, "response" if p in (7, None) else "revisit", b32(h), None if p in (7, None) else 7) for p, u, h in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_revisit_of_a_record_that_is_not_there(spark):
    folder = scratch(spark, "warc-test")
    records = warc.read_archives(warc.write_archives(spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string"), folder), folder)
    first = records.where("kind = 'metadata' AND page_id = 1").first()["concurrent_to"]
    left = records.where((F.col("record_id") != first) & (F.coalesce("concurrent_to", F.lit("")) != first))
    got = warc.transactions(left).collect()
    assert [(r["metadata"]["page_id"], r["response"]["kind"], r["response"]["refers_page"]) for r in got] == [(2, "revisit", None)]


def test_empty_archive(spark):
    folder = scratch(spark, "warc-test")
    manifest = warc.write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert warc.transactions(warc.read_archives(manifest, folder)).count() == 0


def test_warc_query(spark, data):
    pages = {r["page_id"]: r["html"] for r in table(spark, data, "pages").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = {r["page_id"]: tuple(r)[1:] for r in QUERIES["op2_warc"](spark, data).collect()}
    assert got == {i: (len(h.encode()), b32(h), "response" if first[h] == i else "revisit", None if first[h] == i else first[h]) for i, h in pages.items()}


RULES = [urls.Rule("block", "com", "/en/"), urls.Rule("allow", "example.com", "/en/7"), urls.Rule("allow", "net", "/de/"), urls.Rule("block", "example.net", "/de/8"), urls.Rule("block", "org", "/es/")]


@pytest.mark.parametrize("url,host,path,rule", [
    ("https://WWW.Example.COM/en/71?x=/y#z", "www.example.com", "/en/71", "example.com/en/7"), ("http://a.example.com/en/8", "a.example.com", "/en/8", "com/en/"), ("http://x.net/de/8", "x.net", "/de/8", "net/de/"),
    ("http://m.example.net/de/80", "m.example.net", "/de/80", "example.net/de/8"), ("http://notexample.net/de/80", "notexample.net", "/de/80", "net/de/"), ("http://org/es/", "org", "/es/", "org/es/"), ("http://Ü.org?q=/es/", "Ü.org", "", None),
    ("a.org/es/", "", "", None), (None, "", "", None), ("x://h#f://g/es/", "h", "", None), ("http://myorg/es/1", "myorg", "/es/1", None),
])
def test_url_rules(spark, url, host, path, rule):
    df = spark.createDataFrame([(1, url)], "page_id long, url string")
    got = urls.judged(df, RULES, F.lit(0)).first()
    assert (got["host"], got["path"], got["rule"]) == (host, path, rule)
    assert got["verdict"] == ("allow" if rule is None else next(r.action for r in RULES if r.text == rule))


def test_urls_on_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (3, "http://"), (4, "http://a.com/en/x"), (4, "http://a.com/en/x"), (None, "http://b.org/es/")]
    df = spark.createDataFrame([(i, u, "h", "r", "v", 9) for i, u in rows], "page_id long, url string, host string, rule string, verdict string, n int")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged(df.select("page_id", "url", "n"), RULES, F.lit(0)).collect()]
    assert sorted(got, key=str) == sorted([(1, "", "", None, "allow")] * 2 + [(2, "", "", None, "allow"), (3, "", "", None, "allow")] + [(4, "a.com", "/en/x", "com/en/", "block")] * 2 + [(None, "b.org", "/es/", "org/es/", "block")], key=str)
    assert sorted(((r["page_id"], r["host"]) for r in urls.judged(df, RULES, F.lit(0)).select("page_id", "host").collect()), key=str) == sorted(((g[0], g[1]) for g in got), key=str)
    assert urls.judged(df.where("false"), RULES, F.lit(0)).count() == 0


def test_reputation_shrinks(spark):
    rows = [("good.a.com", 0)] * 400 + [("bad.b.com", 1)] * 60 + [("new.b.com", 1)] + [("new.a.com", 1)] + [("x.c.org", k % 10 == 0) for k in range(200)] + [("none.d.org", None)]
    df = spark.createDataFrame([(h, None if b is None else int(b)) for h, b in rows], "host string, bad int")
    got = {r["host"]: r for r in urls.reputation(df).collect()}
    assert got["bad.b.com"]["bound"] > 0.5 > got["new.a.com"]["rate"] and got["good.a.com"]["rate"] < 0.05
    assert got["new.b.com"]["rate"] > got["new.a.com"]["rate"]  # one outcome each, other domains
    assert 0 < got["none.d.org"]["rate"] < 1 and got["none.d.org"]["n"] == 0
    assert urls.reputation(df.where("false")).count() == 0


def test_neighbours_against_brute_force(spark):
    data = "/root/testdata/sf0.01"
    rows = table(spark, data, "embeddings").collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in QUERIES["op9_nearest_neighbours"](spark, data).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        s = v @ v[ids == q][0]
        s[ids == q] = -np.inf
        hits += len({f[1] for f in found} & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
        assert [f[0] for f in sorted(found)] == list(range(1, 21))
        assert all(abs(score - s[ids == i][0]) < 1e-12 for _, i, score in found)
    assert hits >= 0.97 * 20 * len(got)


def recall(spark, ids, v, asked, **kw):
    """Share of the true nearest that are found; checks ranks and scores on the way."""
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, df.where(F.col("vec_id").isin([int(x) for x in asked])), k=20, **kw).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in asked:
        s = v @ v[ids == q][0]
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(score == pytest.approx(s[ids == i][0], rel=1e-9, abs=1e-12) for _, i, score in found)
        best = [i for i in ids[np.lexsort((ids, -s))].tolist() if i != q][:20]
        hits += len({f[1] for f in found} & set(best))
    return hits / (20 * len(asked))


def test_neighbours_over_many_blocks(spark, capsys):
    r = np.random.default_rng(3)
    ids, v = np.arange(6000), r.standard_normal((6000, 64))
    found = recall(spark, ids, v, ids[::60], block=64 * 700)  # nine blocks
    with capsys.disabled():
        print(f" recall over nine blocks: {found:.4f}", end=" ")
    assert found >= 0.97


def test_repeated_vectors_and_ties_across_blocks(spark):
    v = np.tile([1.0, 2.0, 0.5], (300, 1))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(5, v[5].tolist())], "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:3] for r in neighbours.nearest(df, df.where("vec_id = 7 or vec_id = 0").distinct(), k=6, block=3 * 40).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 4), (0, 5, 5), (0, 6, 5), (7, 1, 0), (7, 2, 1), (7, 3, 2), (7, 4, 3), (7, 5, 4), (7, 6, 5)]


@pytest.mark.parametrize("size", [1e-200, 1e-310, 1e160, 1e300])
def test_vectors_of_extreme_length(spark, size):
    r = np.random.default_rng(5)
    v = r.standard_normal((525, 16))
    v[:25] *= size
    ids = np.arange(525)
    with np.errstate(all="ignore"):
        asked = ids[30::50]
        df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<double>")
        got = {}
        for x in neighbours.nearest(df, df.where(F.col("vec_id").isin([int(x) for x in asked])), k=20).collect():
            got.setdefault(x["query_id"], set()).add(x["vec_id"])
        hits = sum(len(got[q] & set([i for i in ids[np.lexsort((ids, -(v @ v[q])))].tolist() if i != q][:20])) for q in asked)
    assert hits >= 0.95 * 20 * len(asked)


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, [-1.0, 0.5]), (None, [1.0, 1.0]), (20, []), (30, [1.0, 2.0, 2.0]), (31, [2.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(r)[:4] for r in neighbours.nearest(df, df, k=2).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (1, 1, 0, 1.0), (1, 2, 2, 1.0), (2, 1, 0, 1.0), (2, 2, 1, 1.0), (9, 1, 0, -1.0), (9, 2, 1, -1.0), (30, 1, 31, 4.0), (31, 1, 30, 4.0)]
    assert neighbours.nearest(df.where("false"), df.where("false")).count() == 0


@pytest.mark.parametrize("size", [64, 100])
def test_estimates_lie_within_their_bounds(size):
    r = np.random.default_rng(7)
    v, turn = r.standard_normal((500, size)), neighbours.rotation(size)
    assert np.allclose(turn @ turn.T, np.eye(size))
    code, factor, length = neighbours.encode(v, turn)
    assert code.nbytes == 500 * 8 * -(-size // 64) and np.allclose(length, np.linalg.norm(v, axis=1))
    unit, _ = neighbours.lengths(r.standard_normal((50, size)))
    asked = neighbours.Asked(unit, turn)
    cosine = asked.cosines(0, 50, code, np.bitwise_count(code).sum(1, dtype=np.int64), factor)
    true = unit @ (v / length[:, None]).T
    error = 3 * (np.sqrt(1 - factor**2) / factor / np.sqrt(size - 1) + asked.step[:, None] / np.sqrt(12) / factor)
    assert (np.abs(cosine - true) <= error).mean() > 0.99 and abs((cosine - true).mean()) < 0.01
