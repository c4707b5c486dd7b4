"""Ranked search against a plain scorer over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ionsift.llm import ranked as r

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(FOLD))


def expected(docs, items, top=10):
    bags = [(i, Counter(split(t))) for i, t in docs if i is not None and split(t)]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in set(items):
        found = []
        for doc_id, bag in bags:
            m = 100 - 75 + (75 * sum(bag.values()) * n_docs) // total
            score = 0
            for w in split(text):
                if w in bag:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * ((1_000_000_000 * bag[w]) // (1000 * bag[w] + 8 * m))
            if score > 0:
                found.append((-score, doc_id))
        out += [(item, k + 1, d, -s) for k, (s, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, parts=3, **options):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    asked = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(x) for x in r.ranked(table, asked, **options).collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(120)] + ["É", "é", "漢字", "A1", "x_y", "don't"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 10, 40, 300])))) for i in range(n)]
    docs += [(i + n, docs[0][1]) for i in range(20)] + [docs[3], docs[3]]  # copies: ties, and ids that stand twice
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 8, 30])))) for k in range(40)]
    return docs, items


def test_equals_plain_scores(spark):
    docs, items = corpus(1, 400)
    assert run(spark, docs, items) == expected(docs, items)


def test_batches_and_passes_do_not_matter(spark, monkeypatch):
    docs, items = corpus(2, 300)
    monkeypatch.setattr(r, "ITEMS_PER_PASS", 15)
    monkeypatch.setattr(r, "TERMS_PER_PASS", 60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "23")
    try:
        assert run(spark, docs, items, top=3) == expected(docs, items, 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_terms():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(0x80), rng.randrange(0x80, 0x2FF), 0x3000, 0x1F600])) for _ in range(40))
        assert [t.decode() for t in r.terms(text)] == split(text)


def test_no_new_accumulators_once_the_bound_is_out_of_reach():
    """Few documents hold the rare term; the common one then only adds to those."""
    n = 2000
    lists = [[0, 1] if i < 20 else [1] for i in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array([10] * n), pa.array(lists, pa.list_(pa.int32())), pa.array([[1] * len(x) for x in lists], pa.list_(pa.int64()))],
        names=["doc_id", "n", "terms", "tfs"],
    )
    postings = r.Postings(batch, n, 10 * n)
    found, scores = postings.search(r.Query(0, np.array([0, 1]), np.array([5000, 3])), 0)
    assert found.tolist() == list(range(20)) and len(set(scores.tolist())) == 1
    # A floor that others have reached keeps a whole batch from opening any.
    assert len(postings.search(r.Query(0, np.array([1]), np.array([3])), 10**12)[0]) in (0, n)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,"), (None, "alpha alpha"), (4, "Alpha beta"), (4, "alpha"), (5, "x" * 70_000), (6, "beta " * 30_000)]
    items = [(1, "alpha"), (1, "alpha"), (1, "beta"), (2, None), (3, "none of these"), (None, "alpha beta"), (5, "x" * 70_000)]
    got = run(spark, docs, items)
    assert got == expected(docs, items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    wide = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("TEXT"), F.lit(2).alias("q"), F.lit("z").alias("term"))
    asked = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit(1).alias("doc_id"), F.lit(3).alias("rank"))
    assert sorted((tuple(x) for x in r.ranked(wide, asked).collect()), key=str) == got


def test_query_equals_plain_scores(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(x) for x in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted((tuple(x) for x in r.op13_ranked_search(spark, sf).collect()), key=str) == expected(docs, items)
