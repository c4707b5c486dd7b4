"""Ranked lexical search: term at a time, rarest first, with a limit on new accumulators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.session import settle, settle_and_watch

TOP = 10
# Query items answered by one pass over the documents; no answer hangs on it. Bounds the terms that travel to the tasks.
ITEMS_PER_PASS = 5_000
TERMS_PER_PASS = 500_000

# Lower-cases A-Z; every other ASCII character that is no letter or digit ends a term. Bytes from 0x80 on belong to terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in order, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


@dataclass
class Query:
    """One item: its terms' numbers, rarest first, and their weights times their repeats."""

    number: int
    terms: np.ndarray
    weights: np.ndarray


def _term_work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Item number, term, repeats."""
    for batch in batches:
        numbers, words, counts = [], [], []
        for number, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found, n = np.unique(np.array(terms(text.as_py()), dtype=object), return_counts=True)
            numbers += [number] * len(found)
            words += list(found)
            counts += n.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(words, pa.binary()), pa.array(counts, pa.int64())], names=["q", "term", "n"]
        )


def _posting_work(vocabulary: dict[bytes, int]):
    """``doc_id``, number of terms, the wanted terms' numbers and how often each occurs: one row per document with a term."""
    size = max(len(vocabulary), 1)
    look = vocabulary.get

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, found, ends = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms(text.as_py())
                if words:
                    wanted = np.fromiter((k for k in map(look, words) if k is not None), np.int64)
                    ids.append(doc_id)
                    lengths.append(len(words))
                    found.append(wanted)
                    ends.append(len(wanted))
            if not ids:
                continue
            keys = np.repeat(np.arange(len(ids)), ends) * size + np.concatenate(found)
            pairs, counts = np.unique(keys, return_counts=True)
            offsets = np.searchsorted(pairs, np.arange(len(ids) + 1) * size).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(x.astype(t))) for x, t in ((pairs % size, np.int32), (counts, np.int64))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"]
            )

    return work


class Postings:
    """The documents of one batch, turned to lists by term: who has it, and what one unit of weight is worth there."""

    def __init__(self, batch: pa.RecordBatch, total_docs: int, total_terms: int):
        self.ids = batch.column(0).to_numpy(zero_copy_only=False)
        n = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        lists, tfs = batch.column(2), batch.column(3)
        owner = np.repeat(np.arange(len(self.ids)), np.diff(lists.offsets.to_numpy()))
        term = lists.flatten().to_numpy(zero_copy_only=False)
        tf = tfs.flatten().to_numpy(zero_copy_only=False)
        m = 100 - 75 + (75 * n * total_docs) // total_terms
        worth = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
        order = np.argsort(term, kind="stable")  # documents stay ascending within a term
        self.docs, self.worth = owner[order], worth[order]
        present, starts = np.unique(term[order], return_index=True)
        ends = np.append(starts[1:], len(term))
        self.of_term = {int(t): (int(a), int(b)) for t, a, b in zip(present, starts, ends)}
        most = np.maximum.reduceat(self.worth, starts) if len(starts) else np.zeros(0, np.int64)
        self.most = dict(zip(self.of_term, most.tolist()))

    def search(self, query: Query, floor: int, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that may be among the best ``top``: all whose score is above 0 and at least ``floor``.

        Terms come rarest first. A term opens accumulators for its documents as long as one that holds
        only the terms left could still reach the score of the ``top``-th best so far (or
        ``floor``, a score that ``top`` documents are known to have). From then on only the accumulators there
        are get updated, each with its exact score.
        """
        here = [(int(t), int(w)) for t, w in zip(query.terms, query.weights) if int(t) in self.of_term]
        left = np.append(np.cumsum([w * self.most[t] for t, w in here][::-1])[::-1], 0) if here else [0]
        scores = np.zeros(len(self.ids), np.int64)
        held: np.ndarray | None = None  # None: accumulators may still be opened
        for k, (t, w) in enumerate(here):
            a, b = self.of_term[t]
            docs, worth = self.docs[a:b], self.worth[a:b]
            if held is None and k:
                reached = floor
                if len(scores) > top and left[0] - left[k] > left[k] >= floor:  # else no score so far can decide
                    reached = max(reached, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
                if left[k] < reached:
                    held = np.flatnonzero(scores)
                    held = held[scores[held] + left[k] >= reached]
            if held is None:
                scores[docs] += w * worth
            else:
                at = np.searchsorted(docs, held)
                at[at == len(docs)] = 0
                hit = docs[at] == held
                scores[held[hit]] += w * worth[at[hit]]
        found = np.flatnonzero(scores) if held is None else held[scores[held] > 0]
        return found, scores[found]


def _search_work(queries: list[Query], total_docs: int, total_terms: int, top: int):
    """The best ``top`` of a task's documents for every query; what earlier batches reached limits the later ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q.number: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for q in queries}
        for batch in batches:
            postings = Postings(batch, total_docs, total_terms)
            for q in queries:
                ids, scores = best[q.number]
                floor = int(scores[top - 1]) if len(scores) >= top else 0
                found, reached = postings.search(q, floor, top)
                if len(found):
                    ids, scores = np.concatenate([ids, postings.ids[found]]), np.concatenate([scores, reached])
                    order = np.lexsort((ids, -scores))[:top]
                    best[q.number] = ids[order], scores[order]
        for number, (ids, scores) in best.items():
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), number)), pa.array(ids), pa.array(scores)], names=["q", "doc_id", "score"]
                )

    return work


def _weighted(items: list[tuple[int, int, int]], df: dict[int, int], total_docs: int) -> list[Query]:
    """Queries from (item, term, repeats), with the terms that some document holds."""
    grouped: dict[int, list[tuple[int, int, int]]] = {}
    for number, term, repeats in items:
        if df.get(term):
            grouped.setdefault(number, []).append((df[term], term, repeats))
    out = []
    for number, found in sorted(grouped.items()):
        found.sort()
        dfs = np.array([f[0] for f in found], float)
        weight = np.floor(1000 * np.log((2 * total_docs + 2) / (2 * dfs + 1))).astype(np.int64)
        keep = weight > 0
        weights = weight * np.array([f[2] for f in found])
        out.append(Query(number, np.array([f[1] for f in found])[keep], weights[keep]))
    return out


def ranked(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the best ``top`` documents of every item, scores above 0 only.

    The items are taken in passes of bounded size. A pass reads the whole texts once and writes, for each
    document, its length and how often it holds the terms asked for; the counts over all documents
    come from that table. Then every task goes through its documents, batch by batch and term at a time (see
    ``Postings.search``), and hands on its best ``top`` of each item, so no list of postings
    meets in one place. Scores are exact 64-bit integers; ties go to the smaller doc_id.

    A text that is NULL or has no term counts nowhere. Rows without doc_id are no documents; a doc_id that stands in
    several rows is ranked for each. Items of one id and text are one; an item without terms, or with terms that no
    document holds, has no row; an item without id keeps its NULL. Other columns are ignored.
    """
    plain = common.texts(docs, id_col, text_col).where("doc_id IS NOT NULL")
    asked = common.texts(items, item_col, item_text).select(F.col("doc_id").alias("item_id"), "text").distinct()
    # Numbers only tell the items of a pass apart.
    numbered = settle(asked.withColumn("q", F.monotonically_increasing_id()))
    wanted = settle(numbered.select("q", "text").mapInArrow(_term_work, "q long, term binary, n long"))
    answers = None
    for low, high in _passes(wanted):
        part = wanted.where(F.col("q").between(low, high))
        rows = part.collect()  # at most TERMS_PER_PASS, or those of one item
        vocabulary = {term: k for k, term in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        postings, seen = settle_and_watch(
            plain.mapInArrow(_posting_work(vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"),
            terms=F.sum("n"),
        )
        if not seen["rows"]:
            break
        counted = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        df = {r["term"]: r["df"] for r in counted.collect()}  # at most one row a term of the pass
        queries = _weighted([(r["q"], vocabulary[bytes(r["term"])], r["n"]) for r in rows], df, seen["rows"])
        work = _search_work(queries, seen["rows"], seen["terms"], top)
        best = settle(postings.mapInArrow(work, "q long, doc_id long, score long"))
        answers = best if answers is None else answers.unionByName(best)
    if answers is None:
        answers = plain.sparkSession.createDataFrame([], "q long, doc_id long, score long")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "doc_id")
    first = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(numbered.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def _passes(wanted: DataFrame) -> list[tuple[int, int]]:
    """Ranges of item numbers with at most so many items and terms, an item alone if it has more."""
    counted = wanted.groupBy("q").agg(F.count(F.lit(1)).alias("n")).orderBy("q")
    out: list[list[int]] = []
    items = words = 0
    for r in counted.toLocalIterator():  # two numbers an item, in order, one partition at a time
        if not out or items + 1 > ITEMS_PER_PASS or words + r["n"] > TERMS_PER_PASS:
            out.append([r["q"], r["q"]])
            items = words = 0
        out[-1][1] = r["q"]
        items, words = items + 1, words + r["n"]
    return [(a, b) for a, b in out]


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents WHERE doc_id IS NOT NULL
), item_terms AS (
    SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term
), lengths AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id
), totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), postings AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, totals GROUP BY term, docs
), scored AS (
    SELECT i.item_id, p.doc_id,
           sum(i.repeats * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 75 + (75 * l.n * t.docs) // t.terms))))::BIGINT AS score
    FROM item_terms i JOIN postings p ON p.term = i.term JOIN weights w ON w.term = i.term
    JOIN lengths l ON l.doc_id = p.doc_id, totals t
    GROUP BY i.item_id, p.doc_id
), placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""
