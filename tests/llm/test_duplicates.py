import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from ionsift.llm import common, components, hashing, minhash, suffix_dedup
from tests.llm.conftest import CLASHING, ODD, SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union(dict):
    def root(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_groups(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    groups, holders = Union(), defaultdict(list)
    for k, (i, s) in enumerate(sets):
        groups.root(i)
        for x in s:
            holders[x].append(k)
    for k, (i, s) in enumerate(sets):
        common_ = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j > k:
                    common_[j] += 1
        for j, n in common_.items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                groups.join(i, sets[j][0])
    return groups


def check_near(got, rows):
    groups = brute_groups(rows)
    assert len(got) == len(rows)
    sizes = defaultdict(list)
    for i, t in rows:
        sizes[i].append(len(shingles(t)))
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (groups.root(r.doc_id), groups.root(r.doc_id) == r.doc_id)


def test_near_duplicates_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SMALL).collect()]
    check_near(minhash.op9_minhash_dedup(spark, SMALL).collect(), rows)


def test_near_duplicates_odd_texts(docs):
    bridge = "one two three four five six seven eight nine ten"
    rows = ODD + [(20, bridge), (21, bridge), (21, "a wholly different text that stands alone here"), (22, "A wholly different text that stands alone here")]
    check_near(minhash.near_duplicates(docs(rows, **CLASHING)).collect(), rows)
    assert minhash.near_duplicates(docs([])).count() == 0


def test_near_duplicates_of_a_wide_family(docs):
    """Copies at all distances of a base: links must survive false candidates, chains and group centres."""
    random.seed(5)
    base = [f"w{random.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(random.choice([1, 2, 3, 4, 5, 6, 8])):
            words[random.randrange(len(words))] = f"x{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    check_near(minhash.near_duplicates(docs(rows)).collect(), rows)


def test_sketches_estimate_similarity():
    random.seed(1)
    for n, share in ((3, 0.5), (40, 0.6), (2000, 0.75)):
        agree = []
        for k in range(30):
            both = int(n * 2 * share / (1 + share))
            x = hashing.mix(np.arange(2 * n - both, dtype=np.uint64), 100 + k)
            a, b = np.sort(x[:n]), np.sort(x[n - both :])
            real = both / (2 * n - both)
            s = minhash.sketches([a, b])
            assert (s != np.uint64(2**64 - 1)).all()
            agree.append((s[0] == s[1]).mean() - real)
        assert abs(np.mean(agree)) < 0.05


def test_word_hashes_in_parts_equal_the_whole():
    text = ("Some words, and\tmore \x0b words " * 300).encode() + b"x" * 500 + b" end"
    data = np.frombuffer(text, np.uint8)
    whole = hashing.word_hashes(data, np.array([0, len(data)]))
    parts = hashing.word_hashes(data, np.array([0, len(data)]), at_most=64)
    assert len(whole[0]) == len(text.split()) and (whole[0] == parts[0]).all()


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(220)] + [(900 + i, 901 + i) for i in range(40)]
    edges += [(2000, 3000 + i) for i in range(300)] + [(7, 7), (None, 3)]
    groups = Union()
    for a, b in edges:
        if a is not None and a != b:
            groups.join(a, b)
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted((i, groups.root(i)) for i in groups)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_take_few_tasks_whatever_is_dealt_out(spark, monkeypatch):
    """A cluster that deals every key out to many partitions costs a step of few edges no more tasks."""
    edges = spark.createDataFrame([(i + 1, i) for i in range(30)], "a long, b long")
    plain = type(edges).repartition
    monkeypatch.setattr(type(edges), "repartition", lambda df, n, *columns: plain(df, max(64, n), *columns))
    stepped = components._few_steps(edges, 30)
    assert stepped.rdd.getNumPartitions() <= components.FEW_TASKS
    assert {(r.node, r.component) for r in components.components(edges).collect()} == {(i, 0) for i in range(31)}


def test_every_pair_is_confirmed_or_refused_once(spark):
    """Refused pairs by far beyond the limit: each comes to its turn, and the search ends."""
    edges = [(a, b) for a in range(9) for b in range(a + 1, 9)]
    pairs = spark.createDataFrame(edges, "a long, b long")
    none = spark.createDataFrame([], "a long, b long")
    nowhere = spark.createDataFrame([], "node long, component long")
    for real in ([], [(3, 7), (7, 8)]):
        asked = []

        def verify(batch):
            assert len(asked) < 40, "the search does not end"
            rows = [tuple(r) for r in batch.collect()]
            asked.append(rows)
            return spark.createDataFrame([r for r in rows if r in real], "a long, b long")

        links, found = components._confirmed(pairs, none, nowhere, verify, 4)
        every = [r for rows in asked for r in rows]
        assert len(every) == len(set(every)) and set(real) <= set(every)
        if not real:
            assert set(every) == set(edges)
        else:
            assert sorted(map(tuple, found.collect())) == [(3, 3), (7, 3), (8, 3)]
        assert sorted(map(tuple, links.collect())) == real


def brute_cut(rows, width=100):
    """By (doc_id, start), as the contract says; rows of one id with different texts are told apart by the caller."""
    seen, out = set(), {}
    for i, t in sorted(((i, t or "") for i, t in rows if i is not None)):
        data = t.encode()
        covered, last = bytearray(len(data)), 0
        for p in range(len(data) - width + 1):
            g = data[p : p + width]
            if g in seen:
                s = max(p, last)
                covered[s : p + width] = b"\1" * (p + width - s)
                last = p + width
            else:
                seen.add(g)
        kept = bytes(c for c, v in zip(data, covered) if not v)
        out[i] = (len(data), sum(covered), sum(1 for x in bytes(covered).split(b"\0") if x), hashlib.sha256(kept).hexdigest())
    return out


def cut_of(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_passages_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SMALL).collect()]
    assert cut_of(suffix_dedup.op5_suffix_dedup(spark, SMALL)) == brute_cut(rows)


def test_passages_at_every_border(docs):
    random.seed(8)
    word = lambda n: "".join(random.choice("abcdé ") for _ in range(n))
    shared = [word(n) for n in (99, 100, 101, 130, 260, 700)]
    rows = [(i, word(random.randrange(60)) + random.choice(shared)[random.randrange(3) :] + word(random.randrange(200))) for i in range(80)]
    rows += [(100, shared[-1][50:]), (101, shared[-1][:-1] + "x" + shared[-1]), (102, shared[1]), (103, shared[1]), (104, "é" * 60)]
    assert cut_of(suffix_dedup.repeated_passages(docs(rows, parts=5))) == brute_cut(rows)


def test_passages_odd_texts(docs):
    rows = [(i, t) for i, t in ODD if i != 15 and i is not None] + [(40, "ab" * 5000), (41, "z" + "ab" * 400), (42, None)]
    assert cut_of(suffix_dedup.repeated_passages(docs(rows, **CLASHING))) == brute_cut(rows)
    assert suffix_dedup.repeated_passages(docs([])).count() == 0


def test_passages_of_repeated_and_missing_ids(docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, "head " + text), (None, text), (None, text)]
    got = sorted((r.doc_id or -1, r.n_removed) for r in suffix_dedup.repeated_passages(docs(rows)).collect())
    assert got == [(-1, 0), (-1, 0), (1, 0), (1, 0), (2, len(text))]


def test_very_long_text_is_taken_in_parts(docs, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "SLICE", 512)
    random.seed(4)
    text = "".join(random.choice("abc ") for _ in range(6000))
    runs = suffix_dedup._all_runs(pa.array([text]), 100, 24)
    positions = sorted((s + k) for s, n in zip(runs[3], runs[5]) for k in range(n))
    assert positions == list(range(len(text) - 99))


def test_kept_text_drops_cut_characters(docs):
    rows = [(1, "é" * 80), (2, "x" + "é" * 70 + "y")]
    got = {r.doc_id: r.kept for r in suffix_dedup.repeated_passages(docs(rows), keep="text").collect()}
    assert all("�" not in t for t in got.values())
