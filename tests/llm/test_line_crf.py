"""The line field: sums against enumeration, gradient against differences, held-out accuracy, odd rows."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from ionsift.llm import line_crf as crf

from tests.llm.conftest import CLASHING, ODD

SMALL = "/root/testdata/sf0.001"


def test_chains_equal_enumeration():
    r = np.random.default_rng(1)
    bounds = np.array([0, 1, 4, 4, 9, 10])
    emission, transition = r.normal(size=10) * 3, r.normal(size=(2, 2))
    p, moves, total = crf.Chains(bounds).run(emission, transition)
    want_p, want_moves, want_total = np.zeros(10), np.zeros((2, 2)), 0.0
    for a, b in zip(bounds[:-1], bounds[1:]):
        weights = {}
        for y in itertools.product((0, 1), repeat=b - a):
            weights[y] = np.exp(np.dot(y, emission[a:b]) + sum(transition[i, j] for i, j in zip(y, y[1:])))
        z = sum(weights.values())
        want_total += np.log(z) if b > a else 0.0
        for y, w in weights.items():
            want_p[a:b] += np.array(y) * w / z
            for i, j in zip(y, y[1:]):
                want_moves[i, j] += w / z
    assert np.allclose(p, want_p) and np.allclose(moves, want_moves) and np.isclose(total, want_total)


def test_long_chains_stay_finite():
    emission = np.tile([40.0, -40.0, 0.1], 5000)
    p, _, total = crf.Chains(np.array([0, len(emission)])).run(emission, np.array([[0.0, -5.0], [-5.0, 0.0]]))
    assert np.isfinite(total) and np.all((p >= 0) & (p <= 1))


def test_quasi_newton_finds_the_minimum():
    a = np.diag([1.0, 10.0, 100.0])
    b = np.array([1.0, -2.0, 3.0])
    x = crf._least(lambda x: (0.5 * x @ a @ x - b @ x, a @ x - b), np.zeros(3), 200)
    assert np.allclose(a @ x, b, atol=0.05)


def features(texts):
    data = "".join(texts).encode()
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    return crf.line_features(np.frombuffer(data, np.uint8), offsets)


def test_features_of_lines():
    texts = ["One two two.\n\nONE!! 12", "", " \n\t", "é ü", "Same words here now\nsame words here now"]
    rows, lengths, bounds = features(texts)
    assert bounds.tolist() == [0, 2, 3, 4, 5, 7]
    of = dict(zip(crf.FEATURES, rows.T))
    assert lengths.tolist() == [10, 7, 1, 1, 2, 16, 16]
    assert np.allclose(of["distinct"][:2], [1.0, 1.0]) and np.allclose(of["upper"][1], 1.0)
    assert np.allclose(of["said_before"][5:], [0.0, 0.5]) and np.allclose(of["digits"][1], 2 / 7)
    assert of["ends_sentence"][:2].tolist() == [1, 0]
    alone = [features([t])[0] for t in texts]
    assert np.array_equal(np.concatenate(alone), rows)


def test_slope_of_the_loss_by_differences(monkeypatch):
    r = np.random.default_rng(2)
    rows = r.normal(size=(30, len(crf.FEATURES))).astype(np.float32)
    bounds = np.array([0, 3, 4, 10, 22, 30])
    caught = []

    def look(f, x, *rest):
        if len(x) > 2:
            x = r.normal(size=len(x)) * 0.3
            value, slope = f(x)
            for i in [0, 5, len(x) // 2, len(x) // 3 - 1, *range(-5, 0)]:
                e = np.zeros(len(x))
                e[i] = 1e-5
                caught.append((slope[i], (f(x + e)[0] - f(x - e)[0]) / 2e-5, i))
        return x

    monkeypatch.setattr(crf, "_least", look)
    crf.fitted(rows, np.ones(30), bounds, np.array([1, 0, 1, 0, 1]))
    # The first fit leaves the transitions at rest.
    checked = [(a, b) for k, (a, b, i) in enumerate(caught) if k >= len(caught) // 2 or i not in (-1, -2)]
    assert np.allclose(*zip(*checked), atol=1e-4)


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = crf.op12_quality_crf(spark, sf).join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert len(bad) > 50
    assert (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean() > 0.97
    assert (good >= 0.3).mean() > 0.99 and (bad >= 0.3).mean() < 0.1


def test_odd_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(7, 17)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    plain = crf.scored(docs(ODD), labels).collect()
    assert len(plain) == len(ODD) and all(0 <= r["score"] <= 1 for r in plain)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in plain)
    wide = crf.scored(docs(ODD, **CLASHING), labels).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["score"])
    assert sorted(map(tuple, plain), key=str) == sorted(map(tuple, wide), key=str) and key
    same = {r["score"] for r in plain if r["doc_id"] in (7, 8, 9)}
    assert len(same) == 1


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in crf.scored(docs([(1, "a b"), (2, None)]), none).collect()} == {0.5}
    one_kind = spark.createDataFrame([(i, 1, 0) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    assert len({r["score"] for r in crf.scored(docs([(1, "a b"), (2, None)]), one_kind).collect()}) == 1
    assert crf.scored(docs([(1, "a")]).where("false"), none).collect() == []


def test_labels_language_and_source_do_not_count(spark):
    sf_docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    a = crf.scored(sf_docs, labels)
    b = crf.scored(sf_docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")), labels.withColumn("toxic", F.lit(1)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
