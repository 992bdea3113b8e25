"""Golden examples of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions import language, similarity, text, trust, urls
from plumbline.functions.html import detail_of, listing_ids, main_text, post_of
from plumbline.functions.people import extract_person, parsed_role
from plumbline.streaming.telemetry import gap_control


def one(spark, expr, **columns):
    row = spark.createDataFrame([tuple(columns.values()) or (1,)], list(columns) or ["x"]) if all(v is not None for v in columns.values()) else spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    return row.select(expr.alias("v")).first()["v"]


KEYS = [("Türkiye", "turkiye"), ("Gold Prize® Award", "gold prize award"), ("IBM Corp.", "ibm corp"), ("  AT&T   Inc ", "at t inc"), ("I.B.M.", "i b m"), ("", ""), (None, ""), ("Foo™", "footm"), ("a_b-c", "a_b-c"), ("漢字 会社", "漢字 会社")]


def test_norm_key(spark):
    df = spark.createDataFrame([(k,) for k, _ in KEYS], "t string").select(text.norm_key(F.col("t")).alias("k"))
    assert [r["k"] for r in df.collect()] == [v for _, v in KEYS]
    assert [text.key_of(k) for k, _ in KEYS] == [v for _, v in KEYS]


@pytest.mark.parametrize("name,slug", [("AI & Customer Service", "ai-customer-service"), ("", "n-a"), ("--x--", "x")])
def test_slugify(spark, name, slug):
    assert one(spark, text.slugify(F.col("t")), t=name) == slug


def test_edition_slug(spark):
    assert one(spark, text.edition_slug(F.col("t"), F.lit(2024)), t="The Business Awards") == "the-business-awards-2024"


@pytest.mark.parametrize("name,own,left", [("IBM, Armonk, NY, USA", ["armonk", "ny", "united states"], "IBM"), ("Delta Air Lines, Asia Pacific", [], "Delta Air Lines, Asia Pacific"), ("NY", [], "NY"), ("A, , USA", [], "A")])
def test_location(spark, name, own, left):
    vocabulary = F.array(*(F.lit(v) for v in text.location_vocabulary()))
    keys = F.array(*(F.lit(o) for o in own)).cast("array<string>")
    assert one(spark, text.strip_location(F.col("t"), vocabulary, keys), t=name) == left


@pytest.mark.parametrize("key,core", [("cisco systems inc", "cisco systems"), ("foo co ltd", "foo"), ("acme l l c", "acme"), ("company", "company"), ("l l c", "l l c")])
def test_legal_form(spark, key, core):
    assert one(spark, text.strip_legal_form(F.col("t")), t=key) == core


@pytest.mark.parametrize("name,core,form", [
    ("Samsung Electronics Co., Ltd", "Samsung Electronics", "Co. Ltd"), ("USHEALTH Advisors, L.L.C.", "USHEALTH Advisors", "L.L.C."), ("LLC", "LLC", ""), ("Co Ltd", "Co", "Ltd"), ("", "", ""), (None, "", ""),
    ("A, B Inc. Group ,", "A, B Inc. Group", ""), ("  Foo GmbH, ", "Foo", "GmbH"), ("Été, S.A. Ltd", "Été, S.A.", "Ltd"),
])
def test_split_form(spark, name, core, form):
    got = one(spark, text.split_legal_form(F.col("t")), t=name)
    assert (got["core"], got["form"]) == (core, form)


def test_places_with_accents(spark):
    vocabulary = F.array(*(F.lit(v) for v in text.location_vocabulary(["São Tomé", "Türkiye"])))
    own = F.array(F.lit("sao paulo"))
    for name, left in (("Empresa Ação, São Paulo, São Tomé", "Empresa Ação"), ("Koç Holding, Türkiye", "Koç Holding"), ("São Paulo", "São Paulo"), ("A, Zürich", "A, Zürich")):
        assert one(spark, text.strip_location(F.col("t"), vocabulary, own), t=name) == left


def test_normalized_org(spark):
    vocabulary = F.array(*(F.lit(v) for v in text.location_vocabulary()))
    o = one(spark, text.normalized_org(F.col("t"), vocabulary, F.array(F.lit("san jose"), F.lit("ca"))), t="Cisco Systems, Inc., San Jose, CA")
    assert (o["key"], o["display"], o["form"]) == ("cisco systems", "Cisco Systems", "Inc.")


def test_collapse_tail(spark):
    assert one(spark, text.collapse_tail(F.col("t")), t="x y y y") == "x y"
    assert one(spark, text.collapse_tail(F.col("t")), t="y y") == "y"


def test_totals_and_math(spark):
    assert one(spark, text.parsed_total(F.col("t")), t="Displaying 1 - 60 of 82,654") == 82654
    for asked, value in (("17 + 3 =", 20), ("9 - 4 =", 5), ("6 x 7 =", 42), ("none", None)):
        assert one(spark, text.solved_math(F.col("t")), t=asked) == value


def test_html():
    page = "<h5>Ines Ruiz, CEO</h5><table><tr><th>Organization Name:</th><td>Acme</td></tr><tr><th>Year:</th><td>2020</td></tr><tr><th>Award:</th><td>Gold <b>Prize</b></td></tr><tr><td>lone</td></tr></table>"
    got = detail_of(page)
    assert (got["nomination_title"], got["organization_name"], got["year"], got["award"], got["city"]) == ("Ines Ruiz, CEO", "Acme", "2020", "GoldPrize", None)
    post = post_of('<meta property="og:title" content=" T "><meta name="author" content="A"><div class="x post-body">a <a href="https://e.x/1">b</a><a href="/rel">c</a></div>')
    assert post == {"title": "T", "author": "A", "clean_text": "a b c", "links": ["https://e.x/1"]}
    assert main_text("<nav>no</nav><p>yes  <b>it</b></p><script>x</script>") == "yes it"
    assert detail_of(None)["year"] is None and post_of("")["clean_text"] == ""


def test_listing(spark):
    html = '<a class="a-view-past-winner-details" rel="86016">x</a><a class="b a-view-past-winner-details" rel="86017">y</a><a class="a-view-past-winner-details" rel="z">q</a>'
    assert one(spark, listing_ids(F.col("t")), t=html) == ["86016", "86017"]


PEOPLE = [("Ines Ruiz, CEO and Founder", "Ines Ruiz"), ("Mr. Brian Ippolito, CEO", "Brian Ippolito"), ("Barry Tourigny SPHR GPHR, VP of X", "Barry Tourigny"), ("Steven T. Plochocki, CEO", "Steven T. Plochocki"), ("NLP Alliance Japan, Osaka, Japan", None), ("Leadership under impossible standards", None), (None, None), ("", None), ("Ludwig van der Berg - CEO", "Ludwig van der Berg"), ("Maria St. Clair, Head", "Maria St. Clair"), ("Acme Group Ltd, CEO", None), ("Anne-Marie O'Neil (Founder)", "Anne-Marie O'Neil"), ("J. R. Smith", None), ("“José Núñez”, Director", "José Núñez")]


@pytest.mark.parametrize("title,name", PEOPLE)
def test_person(spark, title, name):
    assert one(spark, extract_person(F.col("t")), t=title) == name


def test_role(spark):
    assert one(spark, parsed_role(F.col("t")), t="Ines Ruiz, CEO and Founder") == "CEO and Founder"
    assert one(spark, parsed_role(F.col("t")), t="Ines Ruiz") is None


@pytest.mark.parametrize("url,junk", [("https://a.b/topic/x", True), ("https://a.b/category/", True), ("https://a.b/Login", True), ("https://a.b/author/x", True), ("https://a.b/news/pages-of-history", False)])
def test_junk(spark, url, junk):
    assert one(spark, urls.is_junk_url(F.col("t")), t=url) is junk


@pytest.mark.parametrize("url,post", [("https://a.b/blog/x", True), ("https://a.b/blog/topic/x", False), ("https://a.b/blog", False), ("https://a.b/de/blog/x", False), ("https://a.b/", False)])
def test_post(spark, url, post):
    assert one(spark, urls.is_post(F.col("t")), t=url) is post


def test_language(spark):
    assert one(spark, language.detected_language(F.col("t")), t="これは日本語の文章です") == "cjk"
    assert one(spark, language.detected_language(F.col("t")), t="hi") == "und"
    assert one(spark, language.detected_language(F.col("t")), t=None) == "und"
    assert one(spark, language.detected_language(F.col("t")), t="Это русский текст") == "cyrillic"


def test_similarity(spark):
    assert one(spark, F.round(similarity.pg_similarity(F.lit("word"), F.lit("two words")), 4)) == 0.3636
    assert one(spark, similarity.prefix_overlap(F.lit(""), F.lit(""))) == 0.0
    assert one(spark, similarity.is_acronym(F.lit("acm"), F.lit("association for computing machinery"))) is True
    assert one(spark, similarity.is_acronym(F.lit("b2b"), F.lit("business to business"))) is False
    assert one(spark, similarity.despaced_similarity(F.lit("rhino runner"), F.lit("rhinorunner"))) == 1.0


def test_features_are_symmetric(spark):
    rows = spark.createDataFrame([("acme global", "acme holdings the"), ("ibm", "international business machines")], "a string, b string")
    reasons, rare = F.array(F.lit("trigram")), F.array(F.lit("acme"))
    one_way = rows.select(*similarity.pair_features(F.col("a"), F.col("b"), reasons, rare)).collect()
    assert one_way == rows.select(*similarity.pair_features(F.col("b"), F.col("a"), reasons, rare)).collect()
    assert one_way[0]["shared_rare_token_count"] == 1 and one_way[1]["is_acronym_expansion"]


def test_pair_fraction(spark):
    import hashlib

    want = int.from_bytes(hashlib.sha256(b"a\0b").digest()[:8], "big") / 2**64
    assert one(spark, similarity.pair_fraction(F.lit("a"), F.lit("b"))) == want


@pytest.mark.parametrize("n,score", [(1, 0.55), (2, 0.85), (3, 0.9), (10, 0.95)])
def test_trust(spark, n, score):
    assert one(spark, trust.entity_score(F.lit("country"), F.lit(n))) == score


def test_wilson(spark):
    low, high = similarity.wilson(F.lit(10), F.lit(80))
    assert 0.05 < one(spark, low) < 0.08 and 0.20 < one(spark, high) < 0.23
    low, high = similarity.wilson(F.lit(0), F.lit(0))
    assert (one(spark, low), one(spark, high)) == (0.0, 1.0)


def test_gap_control():
    assert gap_control([False], start=1.0) == 1.5
    assert gap_control([False] * 9) == 2.5
    assert gap_control([True] * 8, start=1.0) == pytest.approx(0.9)
