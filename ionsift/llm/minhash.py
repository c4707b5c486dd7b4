"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.llm.components import attach, components, linked, shared_keys, with_sides
from ionsift.llm.hashing import mix, shingle_sets, slices, word_hashes
from ionsift.session import settle, settle_and_watch

BINS = 128
ROWS = 4  # coordinates of a band: 32 bands find a pair of similarity 0.75 but for 5 in a million
MARK = 2048  # coordinates of the finer sketch of candidates, one bit of each
SLICE = 1 << 21  # bytes of text hashed at a time
_U = np.uint64
_EMPTY = _U(2**64 - 1)
_FRACTION = 52  # bits of a value below its round; the 12 above pick the bin, so up to 2048 bins


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """Fast similarity sketches, one row of ``bins`` coordinates for each non-empty set.

    In round i every element is hashed afresh to a bin and a value, which counts as i plus a
    fraction; each bin keeps its smallest. In the first ``bins`` rounds the bin is random, in the
    next ``bins`` rounds it is the round's own, so every coordinate is filled at the end. A set
    takes part until all its bins are full: one round for large sets. Two sets agree in a
    coordinate with the probability of their Jaccard similarity, with the concentration of
    independent coordinates.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), bins), _EMPTY, _U)
    flat = out.reshape(-1)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, _U)
    owner = np.repeat(np.arange(len(sets)), sizes)
    active = np.flatnonzero(sizes > 0)
    looks = {n << k for k in range(bins.bit_length() + 1) for n in (2, 3)} | {1}
    for i in range(2 * bins):
        if not len(active):
            break
        g = mix(elements, 1000 + i)
        value = (_U(i) << _U(_FRACTION)) | (g & _U((1 << _FRACTION) - 1))
        at = ((g >> _U(_FRACTION)) % _U(bins)).astype(np.int64) if i < bins else i - bins
        np.minimum.at(flat, owner * bins + at, value)
        # Rounds beyond the last one needed change nothing, so full sets are looked for now and then only.
        if i + 1 not in looks:
            continue
        still = (out[active] == _EMPTY).any(axis=1)
        if not still.all():
            keep = np.zeros(len(sets), bool)
            active = active[still]
            keep[active] = True
            chosen = keep[owner]
            elements, owner = elements[chosen], owner[chosen]
    return out


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates; keys of different bands differ."""
    n, bins = sketch.shape
    factors = mix(np.arange(1, rows + 1, dtype=_U), 17) | _U(1)
    sums = (sketch.reshape(n, bins // rows, rows) * factors).sum(axis=2, dtype=_U)
    return mix(sums + mix(np.arange(bins // rows, dtype=_U), 19))


def _sketch_work(bins: int, rows: int, width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(1), SLICE):
                sets = shingle_sets(*word_hashes(data, offsets), width)
                sizes = np.array([len(s) for s in sets], np.int64)
                low = np.array([mix(s, 23).sum(dtype=_U) for s in sets], _U)
                high = np.array([mix(s, 29).sum(dtype=_U) for s in sets], _U)
                keys = band_keys(sketches(sets, bins), rows)
                counts = np.where(sizes > 0, keys.shape[1], 0)
                starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(keys[sizes > 0].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(sizes),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        lists,
                    ],
                    names=["doc_id", "n_shingles", "low", "high", "bands"],
                )

    return work


def sketch_documents(docs: DataFrame, bins: int = BINS, rows: int = ROWS, width: int = 5) -> DataFrame:
    """``doc_id``, ``n_shingles``, a 128-bit digest of the shingle set, and its band keys."""
    schema = "doc_id long, n_shingles long, low long, high long, bands array<long>"
    return docs.mapInArrow(_sketch_work(bins, rows, width), schema)


def marks(sets: list[np.ndarray], bins: int = MARK) -> np.ndarray:
    """One bit of each coordinate of a finer sketch, 64 to a number."""
    bits = sketches(sets, bins) & _U(1)
    shifts = np.arange(64, dtype=_U)
    return (bits.reshape(len(sets), bins // 64, 64) << shifts).sum(axis=2, dtype=_U)


def alike(one: Column, other: Column, percent: int, bins: int = MARK) -> Column:
    """Whether the marks agree in as many coordinates as those of a link do, less 4.5 standard deviations.

    So it misses 3 of a million links at the very bound, and fewer above it.
    """
    p = (1 + percent / 100) / 2
    least = math.floor(bins * p - 4.5 * math.sqrt(bins * p * (1 - p)))
    # Written out, the sum makes a method of generated code too long for the JVM to compile.
    counts = F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(counts, F.lit(0), lambda sum_, n: sum_ + n) <= bins - least


def _mark_work(width: int):
    """Texts of candidates with the digest of their set, which is their node, and their marks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(0), SLICE):
                sets = shingle_sets(*word_hashes(data, offsets), width)
                nodes = np.array([mix(s, 23).sum(dtype=_U) for s in sets], _U).view(np.int64)
                packed = marks(sets).view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(packed.reshape(-1)), packed.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), batch.column(0).slice(first, end - first), lists.cast(pa.list_(pa.int64()))],
                    names=["node", "text", "mark"],
                )

    return work


class _Sets:
    """Shingle sets of texts, the latest kept up to a number of bytes."""

    HELD = 64 << 20

    def __init__(self, width: int):
        self.width, self.known, self.size = width, {}, 0

    def of(self, node: int, text: pa.Scalar) -> np.ndarray:
        found = self.known.get(node)
        if found is None:
            data = np.frombuffer(text.as_buffer(), np.uint8)
            found = shingle_sets(*word_hashes(data, np.array([0, len(data)])), self.width)[0]
            if self.size + found.nbytes > self.HELD:
                self.known, self.size = {}, 0
            self.known[node] = found
            self.size += found.nbytes
        return found


def _confirm(percent: int, width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(width)
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            nodes = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for at, ((a, b), one, other) in enumerate(zip(nodes, batch.column(2), batch.column(3))):
                small, large = sorted((sets.of(a, one), sets.of(b, other)), key=len)
                if len(small) and 100 * len(small) >= percent * len(large):
                    places = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[places] == small).sum())
                    keep[at] = 100 * both >= percent * (len(small) + len(large) - both)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"]
            )

    return work


def near_duplicates(
    docs: DataFrame,
    percent: int = 75,
    width: int = 5,
    bins: int = BINS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row per input row.

    Documents whose shingle sets have ``100 * intersection >= percent * union`` are linked;
    ``component_id`` is the smallest doc_id reachable. Equal sets are one node before anything is
    compared, so a group of copies of any size costs its rows. Nodes that share a band key are
    candidates; ``linked`` compares them with group centres first and lists pairs only across what
    is still apart, if a finer sketch does not rule them out. Every link is confirmed on the full sets of both texts.

    A NULL or empty text has no shingle and is linked with nothing; rows of one doc_id are one
    document; a row without doc_id is linked with nothing, has no component and is kept; an
    empty table gives no row; other columns are ignored.
    """
    plain = common.texts(docs, id_col, text_col)
    table = settle(sketch_documents(plain, bins, rows, width))
    known = table.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # The digest names the set: 64 of its 128 bits are the node, the others tell apart what shares them.
    sets = settle(known.groupBy("low", "high").agg(F.min("doc_id").alias("doc"), F.first("bands").alias("bands")))
    shared = shared_keys(sets.select(F.col("low").alias("node"), F.explode("bands").alias("key")))
    wanted = shared.select(F.col("node").alias("low")).distinct().join(sets.select("low", "doc"), "low")
    wanted = wanted.select(F.col("doc").alias("wanted")).distinct().hint("shuffle_hash")
    # The texts of candidates only, read by every round of verification.
    texts = plain.join(wanted, plain["doc_id"] == wanted["wanted"]).select("text")
    held = settle(texts.mapInArrow(_mark_work(width), "node long, text string, mark array<long>"))

    def verify(pairs: DataFrame) -> DataFrame:
        full = with_sides(pairs, held.select("node", "text"), ["text"]).select("a", "b", "text_a", "text_b")
        return full.mapInArrow(_confirm(percent, width), "a long, b long")

    mark = held.select("node", "mark").dropDuplicates(["node"])
    found = linked(shared, verify, mark, lambda a, b: alike(a, b, percent))
    placed = known.select("doc_id", F.col("low").alias("node")).join(found, "node", "left")
    placed = settle(placed.select("doc_id", F.coalesce("component", "node").alias("component")))
    labelled = attach(placed, "component", label=F.min("doc_id"))
    spans = labelled.groupBy("doc_id").agg(F.min("label").alias("component_id"), F.max("label").alias("_high"))
    per_doc, seen = settle_and_watch(spans, apart=F.count(F.when(F.col("component_id") < F.col("_high"), 1)))
    per_doc = per_doc.drop("_high")
    if seen["apart"]:  # a doc_id whose rows lie in several components joins them
        edges = labelled.select(F.col("doc_id").alias("a"), F.col("label").alias("b"))
        joined = settle(components(edges)).withColumnsRenamed({"node": "doc_id", "component": "component_id"})
        per_doc = joined.unionByName(per_doc.join(joined.select("doc_id"), "doc_id", "left_anti"))
    return table.select("doc_id", "n_shingles").join(per_doc, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read_table(spark, sf_dir, "documents"))
