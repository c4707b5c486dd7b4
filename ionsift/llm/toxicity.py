"""Toxicity scores: a learned lexicon, found also misspelled by Levenshtein automata, weighed by context."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.session import settle

# Bounds of the fit: labelled rows of each class that it may use (those of least id hash), terms of the lexicon.
ROWS_PER_CLASS = 10_000
TERMS = 500
SHORTEST, LONGEST = 4, 14  # letters of a term
SUPPORT = 0.01  # share of the toxic training rows that must hold a term, and 3 rows at least
ODDS = 20.0  # times as frequent in toxic rows as in others
CONTEXT = 8  # words on either side of a hit
CONTEXT_BINS = 256
THRESHOLD = 0.7
_EDGE = ".,;:!?()[]{}|*#$%&<>-_~'\"`´‘’“”„«»‹›"
_QUOTES = "\"“”„«»‹›"
_FEATURES = 7


class Automaton:
    """All Levenshtein automata of a lexicon, walked at once: their product with the trie, made on demand.

    A state is a set of (trie node, errors so far); reading a letter matches it, replaces it, or
    takes it as surplus, and a trie letter may be skipped. States and their successors are kept once
    made, so a word costs a dictionary look-up a letter, and most die after a few.
    """

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.budget = [0]  # errors that some term below a node allows
        for k, term in enumerate(terms):
            node = 0
            self.budget[0] = max(self.budget[0], self.allowed(term))
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], self.allowed(term))
            self.ends[node] = k
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.exact: list[int] = []  # the term that a state ends without an error
        self.close: list[tuple[int, int] | None] = []  # the term it ends with least errors
        self.next: list[dict[str, int]] = []
        self.start = self._state({0: 0})
        self.dead = self._state({})

    @staticmethod
    def allowed(term: str) -> int:
        return 0 if len(term) < 5 else 1 if len(term) < 9 else 2

    def _state(self, least: dict[int, int]) -> int:
        queue = list(least.items())
        while queue:  # trie letters may be skipped
            node, errors = queue.pop()
            if least.get(node, 99) < errors:
                continue
            for child in self.children[node].values():
                if errors < self.budget[child] and errors + 1 < least.get(child, 99):
                    least[child] = errors + 1
                    queue.append((child, errors + 1))
        key = frozenset(least.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
            found = [(e, -len(self.terms[self.ends[n]]), self.ends[n]) for n, e in key if self.ends[n] >= 0]
            found = [f for f in found if f[0] <= self.allowed(self.terms[f[2]])]
            self.exact.append(next((k for e, _, k in found if e == 0), -1))
            self.close.append((min(found)[2], min(found)[0]) if found else None)
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        least: dict[int, int] = {}

        def reach(node: int, errors: int) -> None:
            if errors <= self.budget[node] and errors < least.get(node, 99):
                least[node] = errors

        for node, errors in self.states[state]:
            for letter, child in self.children[node].items():
                reach(child, errors + (letter != c))
            reach(node, errors + 1)
        self.next[state][c] = found = self._state(least)
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """The term a word begins with, or else the closest term it misspells, with the errors."""
        state, stem = self.start, -1
        for c in word:
            following = self.next[state].get(c)
            state = self._step(state, c) if following is None else following
            if self.exact[state] >= 0:
                stem = self.exact[state]
            if state == self.dead:
                break
        if stem >= 0:
            return stem, 0
        return self.close[state]


@dataclass
class Model:
    """What scoring needs: terms with their log odds, context log odds, and the weights of the features."""

    terms: list[str] = field(default_factory=list)
    odds: list[float] = field(default_factory=list)
    context: list[float] = field(default_factory=lambda: [0.0] * CONTEXT_BINS)
    mean: list[float] = field(default_factory=lambda: [0.0] * _FEATURES)
    scale: list[float] = field(default_factory=lambda: [1.0] * _FEATURES)
    weights: list[float] = field(default_factory=lambda: [0.0] * _FEATURES)
    bias: float = -3.0


def _bin(word: str) -> int:
    import zlib

    return zlib.crc32(word.encode()) % CONTEXT_BINS


class Scanner:
    """Finds the hits of a text; words already looked up are kept in a bounded cache."""

    CACHED = 300_000

    def __init__(self, model: Model):
        self.model, self.automaton = model, Automaton(model.terms)
        self.cache: dict[str, tuple[int, int] | None] = {}

    def _look(self, word: str) -> tuple[int, int] | None:
        found = self.automaton.match(word.strip(_EDGE))
        if len(word) <= 64:
            if len(self.cache) >= self.CACHED:
                self.cache.clear()
            self.cache[word] = found
        return found

    def hits(self, text: str) -> tuple[int, list[tuple[int, int, bool, list[str]]]]:
        """Number of words, and for each hit its term, errors, whether it is quoted, and the words around it."""
        words = text.lower().split()
        cache, missing = self.cache, object()
        found = {}
        for word in set(words):
            hit = cache.get(word, missing)
            if hit is missing:
                hit = self._look(word)
            if hit is not None:
                found[word] = hit
        out = []
        if found:
            for i, word in enumerate(words):
                if word in found:
                    near = words[max(0, i - CONTEXT) : i + CONTEXT + 1]
                    before = words[max(0, i - CONTEXT) : i]
                    inside = word[0] in _QUOTES or word.rstrip(".,;:!?")[-1:] in _QUOTES
                    inside = inside or sum(w.count(q) for w in before for q in _QUOTES) % 2 == 1
                    out.append((*found[word], inside, [w.strip(_EDGE) for w in near if w != word]))
        return len(words), out

    def features(self, text: str) -> list[float]:
        n, hits = self.hits(text)
        plain = [h for h in hits if not h[2]]
        exact = [h for h in plain if h[1] == 0]
        odds, context = self.model.odds, self.model.context
        around = [context[_bin(w)] for h in plain for w in h[3]]
        return [
            math.log1p(len(exact)),
            math.log1p(len(plain) - len(exact)),
            math.log1p(len(hits) - len(plain)),
            math.log1p(100.0 * len(exact) / n) if n else 0.0,
            max((odds[h[0]] for h in exact), default=0.0),
            math.log1p(len({h[0] for h in exact})),
            sum(around) / len(around) if around else 0.0,
        ]


def _terms_of(text: str) -> set[str]:
    """Beginnings of the words of a text."""
    out = set()
    for word in {w.strip(_EDGE) for w in text.lower().split()}:
        if len(word) >= SHORTEST:
            out.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
    return out


def _count_work(wanted: frozenset | None):
    """Rows with each term, of toxic rows (all terms) or of the others (those wanted)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found = _terms_of(text.as_py())
                counts.update(found if wanted is None else found & wanted)
        columns = [pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())]
        if counts:
            yield pa.RecordBatch.from_arrays(columns, names=["term", "n"])

    return work


def _lexicon(train: DataFrame, n_toxic: int, n_other: int) -> tuple[list[str], list[float]]:
    """Beginnings of words that mark toxic rows; each as long as its support lasts, none inside another.

    Terms that reach the support are few whatever the size of the corpus: a row holds boundedly many, and
    each must stand in a fixed share of at most ``ROWS_PER_CLASS`` rows.
    """
    least = max(3, math.ceil(SUPPORT * n_toxic))
    schema = "term string, n long"
    toxic = (
        train.where("toxic = 1").select("text").mapInArrow(_count_work(None), schema)
        .groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    )
    support = {r["term"]: r["n"] for r in toxic.collect()}
    others = train.where("toxic = 0").select("text").mapInArrow(_count_work(frozenset(support)), schema)
    clean = {r["term"]: r["n"] for r in others.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    odds = {
        t: math.log((n + 0.5) / (n_toxic + 1) / ((clean.get(t, 0) + 0.5) / (n_other + 1))) for t, n in support.items()
    }
    good = {t for t in support if odds[t] >= math.log(ODDS)}
    longer: dict[str, list[str]] = {}
    for t in good:
        longer.setdefault(t[:-1], []).append(t)
    chosen: list[str] = []
    covered: set[str] = set()
    for term in sorted(good, key=lambda t: (len(t), t)):
        if any(term[:k] in covered for k in range(SHORTEST, len(term) + 1)):
            continue
        covered.add(term)
        while further := [t for t in longer.get(term, []) if support[t] >= 0.95 * support[term]]:
            term = max(further, key=lambda t: (support[t], t))
        chosen.append(term)
    chosen = sorted(chosen, key=lambda t: (-odds[t] * support[t], t))[:TERMS]
    return chosen, [odds[t] for t in chosen]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; the last weight is the bias, which is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a NULL id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out, at most ``ROWS_PER_CLASS`` of each label.

    The rows are those of least id hash, so the choice is the same on every run; class frequencies come from
    all labels. Labels, language, source and ids are not among the features. Without both labels the
    model has no term and scores every text alike.
    """
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(remainder(F.col("doc_id")) != 1)
    )
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model()
    order = F.xxhash64("doc_id")
    some = known.where("toxic = 1").orderBy(order, "doc_id").limit(ROWS_PER_CLASS)
    some = some.unionByName(known.where("toxic = 0").orderBy(order, "doc_id").limit(ROWS_PER_CLASS))
    # At most 2 * ROWS_PER_CLASS ids, hence the broadcast.
    train = settle(docs.join(F.broadcast(some), "doc_id").select("doc_id", "text", "toxic"))
    counts = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return Model()
    terms, odds = _lexicon(train, counts[1], counts[0])
    model = Model(terms, odds)
    model.context = _context(train, model)
    rows = train.mapInArrow(_feature_work(model), "toxic int, features array<double>").collect()
    x = np.array([r["features"] for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    share = np.where(y == 1, totals[1] / counts[1], totals[0] / counts[0])
    weights, bias = _logistic((x - mean) / scale, y, share / share.mean())
    model.mean, model.scale, model.weights, model.bias = mean.tolist(), scale.tolist(), weights.tolist(), bias
    return model


def _context(train: DataFrame, model: Model) -> list[float]:
    """Log odds of the words around hits in toxic against other rows, by hashed word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        seen = np.zeros((2, CONTEXT_BINS), np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column(1), batch.column(2)):
                for hit in scanner.hits(text.as_py())[1]:
                    if not hit[2]:
                        for w in hit[3]:
                            seen[toxic.as_py(), _bin(w)] += 1
        bins = pa.array(np.tile(np.arange(CONTEXT_BINS, dtype=np.int32), 2))
        kinds = pa.array(np.repeat(np.arange(2, dtype=np.int32), CONTEXT_BINS))
        yield pa.RecordBatch.from_arrays([kinds, bins, pa.array(seen.reshape(-1))], names=["toxic", "bin", "n"])

    counts = np.zeros((2, CONTEXT_BINS))
    schema = "toxic int, bin int, n long"
    for r in train.mapInArrow(work, schema).groupBy("toxic", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["toxic"], r["bin"]] = r["n"]
    if not counts[0].sum() or not counts[1].sum():
        return [0.0] * CONTEXT_BINS  # no hits of both kinds to tell apart
    share = (counts + 1) / (counts.sum(axis=1, keepdims=True) + CONTEXT_BINS)
    return np.log(share[1] / share[0]).tolist()


def _feature_work(model: Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        for batch in batches:
            rows = [scanner.features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "features"]
            )

    return work


def _score_work(model: Model):
    mean, scale, weights = np.array(model.mean), np.array(model.scale), np.array(model.weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        for batch in batches:
            x = np.array([scanner.features(t.as_py()) for t in batch.column(1)]).reshape(-1, _FEATURES)
            z = ((x - mean) / scale) @ weights + model.bias
            score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return work


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from a score of 0.7): one row per input row.

    Whole texts are read once, in a map over the rows; one text at a time is held. A NULL or
    empty text has a score like any text without a hit; repeated rows are scored each; an empty table gives no row;
    other columns are ignored.
    """
    plain = common.texts(docs, id_col, text_col)
    model = fit(plain, labels)
    found = plain.mapInArrow(_score_work(model), "doc_id long, score double, predicted int")
    return found.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(*(common.read_table(spark, sf_dir, t) for t in ("documents", "labels")))
