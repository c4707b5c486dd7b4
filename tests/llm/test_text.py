import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from ionsift.llm import common, line_dedup, quality, syncmers, toxicity
from tests.llm.conftest import CLASHING, ODD, SMALL

WORD = r"[^\x20\x09-\x0D]+"


def statistics(text):
    w = re.findall(WORD, text or "")
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_equal_brute_force(docs):
    more = [(30, "a b c d e f a b c d e f a b c d e"), (31, "q " * 5), (32, "q " * 6), (33, "x\n y\nx\n y\n\n \n#*"), (34, "a b c d e a b c d e")]
    got = quality.statistics(docs(ODD + more, **CLASHING)).select("doc_id", *COLUMNS).collect()
    want = [(i, *statistics(t)) for i, t in ODD + more]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_rules_are_learned_and_hold_out(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = [(i, "this is a plain text with some %d words in it and none of them is odd " % i * 1) for i in range(100, 400)]
    bad = [(1000 + i, " ".join(f"w{j}{i}###" for j in range(30))) for i in range(150)]
    known = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(101, None, 0)], labels.schema)
    got = {r.doc_id: r for r in quality.judged(docs(good + bad + ODD), known).collect()}
    assert all(got[i].kept for i, _ in good) and not any(got[i].kept or got[i].base_failed for i, _ in bad)
    assert got[8].base_failed and not got[8].kept


@pytest.mark.parametrize("share", [0.005, 0.01, 0.02])
def test_rare_kinds_of_bad_rows_are_learned(spark, share):
    """Bad rows apart from the good ones on one continuous statistic only, fitted on some rows and judged on others."""
    import random

    rng = random.Random(int(share * 1000))

    def rows(n, first):
        out = []
        for i in range(n):
            bad = int(rng.random() < share)
            repeated = rng.uniform(0.12, 0.14) if bad else min(0.11, abs(rng.gauss(0.03, 0.02)))
            out.append((first + i, 10_000, int(rng.gauss(52_000, 4_000)), int(abs(rng.gauss(0, 300))), rng.randrange(5), int(repeated * 10_000), 60, bad))
        return out

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, bad int"
    rules = quality.learn(spark.createDataFrame(rows(20_000, 0), schema))
    unseen = spark.createDataFrame(rows(20_000, 10**6), schema).withColumn("kept", quality.verdict(rules))
    n = {(r.bad, r.kept): r["count"] for r in unseen.groupBy("bad", "kept").count().collect()}
    assert n.get((1, False), 0) >= 0.9 * (n.get((1, False), 0) + n.get((1, True), 0))
    assert n.get((0, False), 0) <= 0.01 * n[0, True]


def test_a_rule_that_fails_does_not_end_the_list(spark):
    """One statistic tempts with bad rows that do not hold out; a rarer kind is found all the same."""
    import random

    rng = random.Random(7)
    out = []
    for i in range(12_000):
        prunes = zlib.crc32(str(i).encode()) % 3 == 2
        odd, rare = rng.random() < 0.03, rng.random() < 0.01
        symbols = 900 if odd else 5
        bad = int(rare or (odd and not prunes))  # the tempting kind is bad only where rules are grown
        out.append((i, 1000, 5000, symbols, 0, 150 if rare else rng.randrange(100), 20, bad))
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, bad int"
    rules = quality.learn(spark.createDataFrame(out, schema))
    assert any(c.feature == "repeat_share" and c.above for rule in rules for c in rule)
    assert not any(c.feature == "symbol_share" for rule in rules for c in rule[:1])


def test_rules_without_labels_or_rows(spark, docs):
    none = spark.read.parquet(f"{SMALL}/labels.parquet").limit(0)
    rows = quality.judged(docs([(1, "a b c d e f g h i j k"), (2, "a")]), none).collect()
    assert {r.doc_id: r.kept for r in rows} == {1: True, 2: False}
    assert quality.judged(docs([]), none).count() == 0


def test_rule_query_on_the_whole_table(spark):
    rows = {r.doc_id: r for r in quality.op2_quality_rules(spark, SMALL).collect()}
    for r in common.documents(spark, SMALL).collect():
        want = statistics(r.text)
        assert tuple(rows[r.doc_id][c] for c in COLUMNS) == want
        assert rows[r.doc_id].base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def xx(*values):
    """Spark's xxhash64: each value hashed with the hash of those before it as the seed."""
    import xxhash

    seed = 42
    for v in values:
        size, v = (4, v[1]) if isinstance(v, tuple) else (8, v)
        data = v.encode() if isinstance(v, str) else v.to_bytes(size, "little", signed=True)
        seed = xxhash.xxh64(data, seed=seed & (2**64 - 1)).intdigest()
        seed -= 2**64 if seed >= 2**63 else 0
    return seed


def brute_syncmers(text, k=5, s=2):
    w = re.findall(WORD, text or "")
    if len(w) < k:
        return [(0, xx(" ".join(w)))] if w else []
    h = [xx(x) for x in w]
    m = [xx(h[i], h[i + 1]) for i in range(len(w) - 1)]
    out = []
    for i in range(len(w) - k + 1):
        inner = m[i : i + k - s + 1]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, xx(*h[i : i + k])))
    return out


def brute_fingerprint(text):
    found = brute_syncmers(text)
    if len(found) == 1:
        return [found[0][1]]
    return sorted({xx(h, g, ("int", q - p)) for (p, h), (q, g) in zip(found, found[1:])})


def test_syncmers_equal_brute_force_and_are_context_free(docs):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, t) for i, t in ODD if i is not None and i != 15] + [(50, passage), (51, "before it " + passage + " after")]
    got = {}
    for r in syncmers.anchors(docs(rows, **CLASHING)).collect():
        got.setdefault(r.doc_id, []).append((r.position, r.hash))
    assert {i: sorted(v) for i, v in got.items()} == {i: brute_syncmers(t) for i, t in rows if brute_syncmers(t)}
    shifted = {(p - 2, h) for p, h in got[51]}
    assert set(got[50]) <= shifted


def likeness(a, b):
    u = set(a) | set(b)
    return len(set(a) & set(b)) / len(u) if u else 1.0


def test_edited_fingerprints(docs):
    rows = [(i, t) for i, t in ODD if i != 15] + [(15, "same same")]
    order = sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0], reverse=True)
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(docs(rows, **CLASHING)).collect()}
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(order):
        following, text = order[(at + 1) % len(order)][1] or "", text or ""
        n = len(text)
        edited = text[: n - n // 3] + following[: n // 3]
        own, new, nxt = map(brute_fingerprint, (text, edited, following))
        string = lambda f: "".join(f"{h & (2**64 - 1):016x}" for h in f)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (string(own), string(new))
        assert r.near_edited == pytest.approx(likeness(own, new)) and r.near_next == pytest.approx(likeness(own, nxt))


def test_edited_fingerprints_of_repeated_ids_and_empty_tables(docs):
    assert syncmers.edited_fingerprints(docs(ODD)).count() == len(ODD)
    assert syncmers.edited_fingerprints(docs([])).count() == 0
    one = syncmers.edited_fingerprints(docs([(1, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0


def test_long_texts_are_fingerprinted_whole(docs):
    """One changed sentence in 6,000 words, and a shared passage of 60 words in texts of 3,000, leave their mark."""
    own = [[f"t{k}x{i}" for i in range(3000)] for k in range(2)]
    shared = [f"p{i}" for i in range(60)]
    long = [f"l{i}" for i in range(6000)]
    changed = long[:4000] + [f"c{i}" for i in range(12)] + long[4012:]
    texts = [" ".join(x) for x in (long, changed, own[0][:900] + shared + own[0][900:], own[1][:300] + shared + own[1][300:])]
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(docs([(4 - i, t) for i, t in enumerate(texts)])).collect()}
    assert got[4].fingerprint != got[3].fingerprint and 0.99 < got[4].near_next < 1
    assert 0 < got[2].near_next < 0.1
    for i, t in enumerate(texts):
        want, following = set(brute_fingerprint(t)), set(brute_fingerprint(texts[(i + 1) % 4]))
        assert got[4 - i].fingerprint == "".join(f"{h & (2**64 - 1):016x}" for h in sorted(want))
        assert got[4 - i].near_next == pytest.approx(len(want & following) / len(want | following))


def test_order_of_paragraphs_counts(docs):
    parts = [" ".join(f"p{k}w{i}" for i in range(60)) for k in range(4)]
    swapped = [parts[2], parts[0], parts[3], parts[1]]
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(docs([(2, "\n".join(parts)), (1, "\n".join(swapped))])).collect()}
    assert 0.8 < got[2].near_next < 1 and got[2].fingerprint != got[1].fingerprint


@pytest.mark.parametrize("coarse, rows", [(2, 1), (4, 3), (256, 2000)])
def test_neighbours_over_bucket_borders(docs, monkeypatch, coarse, rows):
    """Many ids, one id in half of the rows, ids with one row and rows without: the next text is the next one in order."""
    monkeypatch.setattr(syncmers, "COARSE", coarse)
    monkeypatch.setattr(syncmers, "PER_BUCKET", rows)
    table = [(i * i, f"text {i} with a few more words than five") for i in range(40)]
    table += [(100, f"hot id {i} and some words of its own") for i in range(40)] + [(None, f"no id {i} but words") for i in range(20)]
    table += [table[3], table[3], table[50]]
    order = sorted(set(table), key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), xx(r[1])))
    want = []
    for at, (i, text) in enumerate(order):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + order[(at + 1) % len(order)][1][:cut]
        want += [(i, hashlib.sha256(edited.encode()).hexdigest())] * table.count((i, text))
    got = [(r.doc_id, r.edited_sha256) for r in syncmers.edited_fingerprints(docs(table)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_fingerprint_query_has_no_python(spark):
    plan = syncmers.op1_document_fingerprints(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def normal(line):
    return " ".join(w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w)


def test_lines_keep_the_first_of_a_group(docs):
    words = [f"word{i}" for i in range(60)]
    long, other = " ".join(words), " ".join([*words[:17], "wird", *words[18:]])
    rows = [
        (1, "Hello, World!\nunique one\n\n" + long), (2, "hello world\n###\n" + other), (3, "HELLO WORLD"),
        (None, "hello world"), (4, None), (5, "tail\nhello  world\ntail\ntail"), (6, "tail"), (6, "tail"), (6, "other\ntail"),
    ]
    got = sorted(
        ((r.doc_id or -1), r.n_lines, r.n_removed, r.text)
        for r in line_dedup.without_repeated_lines(docs(rows, **CLASHING)).collect()
    )
    assert got == sorted(
        [
            (1, 4, 0, rows[0][1]), (2, 3, 2, "###"), (3, 1, 1, ""), (-1, 1, 0, "hello world"), (4, 1, 0, ""), (5, 4, 3, "tail"),
            (6, 1, 1, ""), (6, 1, 1, ""), (6, 2, 1, "other"),
        ]
    )


def test_lines_odd_texts_and_empty_table(docs):
    got = line_dedup.without_repeated_lines(docs(ODD)).collect()
    assert len(got) == len(ODD)
    assert next(r for r in got if r.doc_id == 11).n_removed == 50
    assert line_dedup.without_repeated_lines(docs([])).count() == 0


def test_exact_lines_on_the_whole_table(spark):
    """Every exact repeat goes; what goes beside is within the edit similarity of a line that stays."""
    rows = sorted(common.documents(spark, SMALL).collect(), key=lambda r: r.doc_id)
    seen, exact = set(), {}
    for r in rows:
        for line in r.text.split("\n"):
            if normal(line) in seen:
                exact[r.doc_id] = exact.get(r.doc_id, 0) + 1
            elif normal(line):
                seen.add(normal(line))
    got = {r.doc_id: r for r in line_dedup.without_repeated_lines(common.documents(spark, SMALL)).collect()}
    assert all(got[i].n_removed >= n for i, n in exact.items())
    assert sum(r.n_removed for r in got.values()) <= 1.3 * sum(exact.values())


def all_links(spark, norms, similarity=0.9):
    """Every pair of distinct lines within the edit similarity, by comparing each with all of like length."""
    from pyspark.sql import functions as F

    table = spark.createDataFrame(list(enumerate(norms)), "i long, t string").withColumn("n", F.length("t"))
    one, other = (table.toDF(*[f"{c}{x}" for c in "itn"]) for x in "ab")
    allowed = F.floor(F.greatest("na", "nb") * (1 - similarity) + 1e-9)
    like = (F.col("ia") < F.col("ib")) & (F.abs(F.col("na") - F.col("nb")) <= allowed)
    pairs = one.repartition(32).join(F.broadcast(other), like).where(F.expr(f"levenshtein(ta, tb, CAST(floor(greatest(na, nb) * {1 - similarity!r}D + 1e-9D) AS INT)) >= 0"))
    return [(r.ia, r.ib) for r in pairs.select("ia", "ib").collect()]


def lines_of(spark, sf):
    return sorted({normal(x) for r in common.documents(spark, sf).collect() for x in r.text.split("\n")} - {""})


def groups_of(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[top(a)] = top(b)
    return [top(i) for i in range(n)]


def keys_of(norms):
    """Keys and SimHash of each line."""
    data = np.frombuffer("\n".join(norms).encode(), np.uint8)
    edges = np.concatenate([[0], np.flatnonzero(data == 10) + 1, [len(data)]])
    full, _, chars, marks, keys, bounds = line_dedup.line_keys(data, edges)
    assert len(full) == len(norms) and chars.tolist() == [len(x) for x in norms]
    return [set(keys[i:j].tolist()) for i, j in zip(bounds[:-1], bounds[1:])], marks.tolist()


def test_fuzzy_lines_against_edit_similarity_alone(spark):
    """Of all pairs within the edit similarity, whatever their keys, at least nine of ten end in one group; no others do."""
    norms = lines_of(spark, "/root/testdata/sf0.01")
    links = all_links(spark, norms)
    assert len(links) > 200
    group = groups_of(len(norms), links)
    own, marks = keys_of(norms)
    table = spark.createDataFrame(list(enumerate(norms)), "doc_id long, text string")
    found = [(a, b) for a, b in links if own[a] & own[b] and (marks[a] ^ marks[b]).bit_count() <= line_dedup.DISTANCE]
    assert len(found) >= 0.95 * len(links)
    removed = sum(r.n_removed for r in line_dedup.without_repeated_lines(table).collect())
    whole, reached = (len(norms) - len(set(groups_of(len(norms), x))) for x in (links, found))
    assert removed == reached and reached >= 0.95 * whole and len(set(group)) == len(norms) - whole


def test_candidates_grow_with_the_lines(spark):
    """Ten times the lines: pairs that share a key grow far less than a hundredfold."""
    pairs = []
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        shared = Counter(k for keys in keys_of(lines_of(spark, sf))[0] for k in keys)
        pairs.append(sum(n * (n - 1) // 2 for n in shared.values()))
    assert pairs[1] <= 12 * max(pairs[0], 200)


def test_changed_words_leave_a_block_whole():
    """Fewer changed words than half the blocks never part two lines."""
    import random

    rng = random.Random(4)
    lines = []
    for i in range(300):
        words = [f"{rng.choice('abcdef')}word{rng.randrange(10**6)}" for _ in range(rng.choice([8, 13, 20, 30, 60, 120]))]
        blocks = 2 ** max(1, (len(words) // 6).bit_length())
        other = list(words)
        for k in rng.sample(range(len(words)), max(0, min(blocks // 2 - 1, 12))):
            other[k] = f"x{rng.randrange(10**6)}"
        lines += [" ".join(words), " ".join(other)]
    keys, _ = keys_of(lines)
    missed = sum(not keys[i] & keys[i + 1] for i in range(0, 600, 2))
    assert missed <= 15  # a block may hold too few words to become a key


def test_keys_do_not_hang_on_the_lines_around():
    import random

    rng = random.Random(3)
    lines = [" ".join(rng.choices(["é", "word", "漢字漢字", "a", "longer", "x1"], k=rng.choice([1, 2, 7, 30, 500]))) for _ in range(60)]
    keys, marks = keys_of(lines)
    for line, k, m in zip(lines, keys, marks):
        assert keys_of([line]) == ([k], [m])
    assert len(keys_of([" ".join(f"word{i}" for i in range(100_000))])[0][0]) <= 2 * line_dedup.KEYED


def test_simhash_equals_brute_force():
    import random

    rng = random.Random(1)
    runs = [[rng.getrandbits(64) for _ in range(n)] for n in [*range(1, 32), 40, 3, 1, 31]]
    starts = np.cumsum([0, *map(len, runs)])[:-1]
    got = line_dedup.simhashes(np.array([h for r in runs for h in r], np.uint64), starts)
    for run, value in zip(runs, got.tolist()):
        run = run[:31]
        assert value == sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in run) > len(run))


def test_words_of_a_line():
    import random

    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("aZ9 _-.,\t\r\x0b\n\u00a0\u3000éßΣ漢٣½²́’İ") for _ in range(30))
        got = [" ".join(x.split()) for x in line_dedup.normalised(text).split("\n")]
        assert got == [normal(x) for x in text.split("\n")], repr(text)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_similar_lines_equal_edit_distance():
    import random

    rng = random.Random(9)
    for _ in range(600):
        a = "".join(rng.choices("abc é漢", k=rng.randrange(40)))
        b = list(a)
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "a", "bc"])
        b = "".join(b) if rng.random() < 0.9 else "".join(rng.choices("abc", k=rng.randrange(40)))
        assert line_dedup.edit_distance(a, b) == distance(a, b)
        for bound in (0.9, 0.8, 0.5):
            want = distance(a, b) <= int(max(len(a), len(b)) * (1 - bound) + 1e-9)
            assert line_dedup.similar(a, b, bound) == want


def test_automaton_equals_edit_distance():
    import random

    random.seed(3)
    terms = ["idiot", "moron", "scum", "disgusting", "stupidity", "morose"]
    automaton = toxicity.Automaton(terms)
    words = ["".join(random.choice("idotmrnscuge") for _ in range(random.randint(1, 11))) for _ in range(3000)]
    for t in terms:
        for _ in range(200):
            w = list(t)
            for _ in range(random.randint(0, 3)):
                k = random.randrange(len(w) + 1)
                w[k : k + random.randint(0, 1)] = random.choice(["", "x", "o"])
            words.append("".join(w))
    for w in words:
        got = automaton.match(w)
        if any(w.startswith(t) for t in terms):
            assert got is not None and got[1] == 0 and w.startswith(terms[got[0]])
            continue
        close = [(distance(w, t), t) for t in terms if distance(w, t) <= automaton.allowed(t)]
        assert (got is None) == (not close), w
        if close:
            assert got[1] == min(d for d, _ in close)


def test_quoted_hits_are_told_apart():
    scanner = toxicity.Scanner(toxicity.Model(terms=["moron"], odds=[3.0]))
    assert [h[2] for h in scanner.hits('he said "you moron" and left')[1]] == [True]
    assert [h[1:3] for h in scanner.hits("you mor0n, go")[1]] == [(1, False)]


def test_scores_on_the_whole_table(spark):
    sf = SMALL.replace("0.001", "0.01")
    got = {r.doc_id: r for r in toxicity.op8_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == common.documents(spark, sf).count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(got[i].score, t) for i, t in labels.items() if got[i].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, t in held if t for b, u in held if not u]
    assert sum(pairs) / len(pairs) > 0.85
    assert not any(got[i].predicted for i, t in labels.items() if got[i].held_out and not t)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_scores_of_odd_texts_and_without_labels(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert toxicity.scored(docs(ODD, **CLASHING), labels.limit(0)).count() == len(ODD)
    assert toxicity.scored(docs([]), labels).count() == 0
