"""Every stage of the pipeline against a brute-force version of what it returns, and on odd inputs."""

import math

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import base_brute, brute_components, measures

from plumbline.llm import pii, quality, toxicity
from plumbline.llm.common import written
from plumbline.llm.queries import QUERIES, table

STAGE = dict(corpus_pipeline.STAGES)
CLASHES = "doc_id long, text string, lang string, __kept_id long, __quality_n_words long, score double, component string, class_id int"


@pytest.fixture(scope="module")
def docs(spark, data):
    return table(spark, data, "documents")


def as_dict(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def posteriors(votes):
    """Expectation-maximisation over documents, one by one: the model that the operator fits to counts of patterns."""
    k = len(votes[0])
    prior = {c: [8.0 * x / 3.5 for x in p] for c, p in ((0, (2.0, 1.0, 0.5)), (1, (0.5, 1.0, 2.0)))}
    q = [min(max(0.5 + sum(v) / (2 * k), 0.02), 0.98) for v in votes]
    for _ in range(100):
        odds = []
        for j in range(k):
            of = {c: [sum((x if c else 1 - x) for x, v in zip(q, votes) if v[j] == o) + prior[c][o + 1] for o in (-1, 0, 1)] for c in (0, 1)}
            odds.append([math.log(of[1][o] / sum(of[1])) - math.log(of[0][o] / sum(of[0])) for o in range(3)])
        base = math.log((sum(q) + 1) / (sum(1 - x for x in q) + 1))
        new = [1 / (1 + math.exp(-(base + sum(odds[j][v[j] + 1] for j in range(k))))) for v in votes]
        done = max(abs(a - b) for a, b in zip(q, new)) < 1e-12
        q = new
        if done:
            break
    return q


def test_quality_stage(spark, docs, data):
    texts = as_dict(docs)
    rows = QUERIES["op8_quality_rules"](spark, data)
    judged = {r["doc_id"]: r for r in rows.collect()}
    votes = {r["doc_id"]: [r[c] for c in quality.rules()] for r in quality.quality_posterior(docs).select("doc_id", *(v.alias(c) for c, v in quality.rules().items())).collect()}
    ids = sorted(texts)
    want = dict(zip(ids, posteriors([votes[i] for i in ids])))
    kept = set()
    for i in ids:
        n, *_, repeat = measures(texts[i])
        failed = n < 50 or 100 * repeat > 50 * n
        assert judged[i]["quality"] == pytest.approx(want[i], abs=1e-6) and judged[i]["base_failed"] == failed
        assert judged[i]["kept"] == (not failed and want[i] >= 0.1)
        if judged[i]["kept"]:
            kept.add(i)
    assert as_dict(STAGE["quality_rules"](spark, docs, data)) == {i: texts[i] for i in kept}


def test_toxicity_stage(spark, docs, data):
    labels = table(spark, data, "labels")
    model = toxicity.learnt(docs, labels, 40_000, 2, 4)
    texts = as_dict(docs)
    want = {}
    for i, t in texts.items():
        words = [w for w in pa.compute.ascii_split_whitespace(pa.array([t or ""])).flatten().to_pylist() if w]
        scores = model.word_scores(pa.array(words, pa.string())).tolist()
        sums = np.concatenate(([0.0], np.cumsum(scores)))
        best = max((sums[b] - sums[a] for a in range(len(words)) for b in range(a + 1, min(len(words), a + 60) + 1)), default=None) if len(words) < 400 else None
        p = float(model.probability(model.evidence(pa.array([t])))[0])
        if best is not None:  # the best of all windows is the best segment
            assert model.best_and_segments(pa.array([t]))[0][0] >= best - 1e-6
        if p < 0.3:
            want[i] = t
    assert as_dict(STAGE["toxicity"](spark, docs, data)) == want


def test_near_dedup_stage(spark, docs, data):
    texts = as_dict(docs)
    of = brute_components(list(texts.items()), 5)
    assert as_dict(STAGE["near_dedup"](spark, docs, data)) == {i: t for i, t in texts.items() if of[i] == i}


def test_personal_data_stage(spark, docs, data):
    texts = as_dict(docs)
    got = as_dict(STAGE["personal_data"](spark, docs, data))
    assert set(got) == set(texts)
    field = pii.trained_field()
    for i, t in texts.items():
        spans = [(k, a, b) for k, found in base_brute(t or "").items() for a, b in found] + pii.found(t or "", field)[1]
        out, end = "", 0
        for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            out += ((t[end:a] + f"<{k}>") if a >= end else "")
            end = max(end, b)
        assert got[i] == (None if t is None else out + t[end:])


def test_pipeline(spark, data, docs):
    seen = [docs.count()]
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = written(stage(spark, rows, data), f"test-{name}")
        assert rows.columns == docs.columns, name
        seen.append(rows.count())
    assert seen[0] > seen[1] >= seen[2] >= seen[3] == seen[4] > 0.5 * seen[0]
    pieces = STAGE["packing"](spark, rows, data)
    assert pieces.select("doc_id").distinct().count() == seen[4]
    assert sorted(map(tuple, corpus_pipeline.run(spark, data).select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, pieces.select("doc_id", "piece", "ids_crc32").collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows(spark, data, name):
    word = lambda k: "".join(chr(97 + k // 26**j % 26) for j in range(4))
    long = " ".join(f"{word(2 * k)} of {word(2 * k + 1)} and the" for k in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "short"), (5, long), (6, long), (6, long), (None, long), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1, 2, 0.5, "c", 3) for i, t in rows], CLASHES)
    got = STAGE[name](spark, df, data)
    if name == "packing":
        assert {r["doc_id"] for r in got.collect()} == {1, 2, 3, 4, 5, 6, None}
    else:
        assert got.columns == df.columns
        ids = sorted((r["doc_id"] for r in got.collect()), key=str)
        want = {"quality_rules": [5, 6, 6, None], "toxicity": [1, 2, 3, 4, 5, 6, 6, None, None], "near_dedup": [1, 2, 3, 4, 5, None, None], "personal_data": [1, 2, 3, 4, 5, 6, 6, None, None]}
        assert ids == sorted(want[name], key=str)
    assert STAGE[name](spark, df.where("false"), data).count() == 0


def test_stages_keep_clean_documents(spark):
    data = "/root/testdata/sf0.01"
    docs = table(spark, data, "documents")
    labels = table(spark, data, "labels")
    kept = STAGE["quality_rules"](spark, docs, data)
    assert kept.join(labels.where("quality = 0"), "doc_id").count() == 0
    clean = written(kept.join(labels.where("quality = 1 and toxic = 0").select("doc_id"), "doc_id", "left_semi").select(*docs.columns), "test-clean")
    assert STAGE["toxicity"](spark, kept, data).join(clean.select("doc_id"), "doc_id", "left_semi").count() >= 0.98 * clean.count()
    assert STAGE["personal_data"](spark, docs, data).where(F.col("text").rlike(r"[a-z]\.[0-9]+@mail")).count() == 0
