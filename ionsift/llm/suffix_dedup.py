"""Repeated passages: every byte covered by a long string that also starts earlier is removed.

Positions are named (ranked) by the strings that start there, over growing lengths, and drop out as soon as
their name is unique; what still shares a name past the threshold is a repeat. To keep the first round
small, positions are first gathered in runs around content-defined anchors:

* The anchor of a position is the leftmost ``SEED``-byte string of least hash within the
  ``width`` bytes that start there. It hangs on these bytes alone, so equal strings have equal
  anchors at equal distance, and neighbouring positions share one: about one run in 39 bytes.
* Round 1 names runs by their anchor's string. A run with a unique name holds no repeat.
  Of runs with equal whole text (all strings of the run) all but the first are repeats as a whole.
* Only firsts whose anchor also stands in other texts go on: runs are split into blocks of 16
  positions at equal distance from the anchor, named by the 85 bytes that all strings of the block share,
  and what is still shared is named by single strings of 100 bytes.

Names are 64-bit hashes (two of them together decide equality of runs); nothing is compared in pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.llm.hashing import Rolling, mix, slices
from ionsift.session import settle

WIDTH = 100  # bytes of a string that counts as a repeat
SEED = 24  # bytes of an anchor
BLOCK = 16  # positions of a block
SLICE = 1 << 21
_U = np.uint64
_INDEX_BITS = 23
# A place is one long: position, 16 bits of a hash of the text (for rows that share a doc_id), distance of
# the anchor, number of positions; the number is 0 for a stretch already known to be repeated.
_POSITION, _TEXT, _ANCHOR = 30, 14, 7


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def _runs(data: np.ndarray, offsets: np.ndarray, width: int, seed: int):
    """Runs of positions with one anchor: name, whole-text hash, text number, start, anchor distance, size."""
    if len(data) < width:
        return None
    rolled = Rolling(31).of(data)
    names = rolled.windows(seed)
    low = _U((1 << _INDEX_BITS) - 1)
    packed = (mix(names) & ~low) | np.arange(len(names), dtype=_U)
    anchors = (_sliding_min(packed, width - seed + 1) & low).astype(np.int64)
    late = np.zeros(len(data) + 1, np.int32)  # positions whose string would cross the border of two texts
    np.add.at(late, np.maximum(offsets[1:] - width + 1, offsets[:-1]), 1)
    np.add.at(late, offsets[1:], -1)
    at = np.flatnonzero(np.cumsum(late)[: len(anchors)] == 0)
    if not len(at):
        return None
    anchor = anchors[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    start, anchor = at[first], anchor[first]
    whole = mix(rolled.hash(start, start + size - 1 + width)) + mix(((anchor - start) * 1000 + size).astype(_U), 3)
    row = np.searchsorted(offsets, start, "right") - 1
    return names[anchor], whole, row, start - offsets[row], anchor - start, size


def _all_runs(texts: pa.Array, width: int, seed: int):
    found = []
    for first, end, data, offsets in slices(texts, SLICE):
        step = len(data) if end - first > 1 or len(data) <= 2 * SLICE else SLICE
        for base in range(0, max(len(data), 1), max(step, 1)):  # a very long text is taken in overlapping parts
            part = data[base : base + step + width - 1]
            runs = _runs(part, offsets if step == len(data) else np.array([0, len(part)]), width, seed)
            if runs:
                name, whole, row, start, anchor, size = runs
                found.append((name, whole, row + first, start + base, anchor, size))
    return [np.concatenate(c) for c in zip(*found)] if found else None


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Touching stretches of one text as one; rows come ordered by text and start."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return row[first], start[first], np.maximum.reduceat(end, first) if len(first) else end


def _anchor_work(width: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = _all_runs(batch.column(2), width, seed)
            if runs is None:
                continue
            name, whole, row, start, anchor, size = runs
            docs, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            place = (start << _POSITION) | (salt[row] << _TEXT) | (anchor << _ANCHOR) | size
            doc = docs[row]
            if (np.diff(docs) < 0).any():
                order = np.lexsort((place, doc))
                name, whole, row, start, size, place, doc = [
                    x[order] for x in (name, whole, row, start, size, place, doc)
                ]
            # Of equal runs within the batch only the first goes on; the others are repeats already.
            # So a passage that stands in a third of all texts is one row a batch.
            both = mix(name, 41) ^ whole
            order = np.argsort(both, kind="stable")
            ordered = both[order]
            new = np.ones(len(order), bool)
            new[1:] = ordered[1:] != ordered[:-1]
            group = np.cumsum(new) - 1
            firsts = order[np.flatnonzero(new)][group]
            repeat = np.zeros(len(order), bool)
            repeat[order] = (doc[order] != doc[firsts]) | (place[order] != place[firsts])
            sure = np.flatnonzero(repeat)
            sure = sure[np.lexsort((start[sure], row[sure]))]
            r, s, e = _merged(row[sure], start[sure], start[sure] + size[sure] - 1 + width)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([name[~repeat], mix(docs[r].astype(_U) + mix(s.astype(_U)), 43)]).view(np.int64)),
                    pa.array(np.concatenate([whole[~repeat].view(np.int64), e - s])),
                    pa.array(np.concatenate([doc[~repeat], docs[r]])),
                    pa.array(np.concatenate([place[~repeat], (s << _POSITION) | (salt[r] << _TEXT)])),
                ],
                names=["name", "whole", "id", "place"],
            )

    return work


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Substrings one after the other, and their offsets."""
    offsets = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return data[index], offsets


def _blocks(data, start, anchor, size, block: int, width: int):
    """Split runs into blocks of positions at equal distance from the anchor.

    ``start`` and ``anchor`` are places in ``data``. Returns the run of each block, its start and size, the
    hash of what all its possible strings share, and that of its whole text.
    """
    end = start + size - 1
    low, high = (anchor - end) // block, (anchor - start) // block
    count = high - low + 1
    run = np.repeat(np.arange(len(start)), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[run]
    first = np.maximum(start[run], anchor[run] - (number * block + block - 1))
    last = np.minimum(end[run], anchor[run] - number * block)
    rolled = Rolling(37).of(data)
    core_start = anchor[run] - number * block
    core = mix(rolled.hash(core_start, core_start - block + 1 + width) + mix(number.astype(_U), 47))
    whole = mix(rolled.hash(first, last + width)) + mix(((anchor[run] - first) * 1000 + last - first).astype(_U), 53)
    return run, first, last - first + 1, core, whole


_BLOCK_FIELDS = ["name", "whole", "id", "place", "bytes"]


def _block_work(width: int, block: int):
    """Texts with the places of their open runs to blocks, with the bytes of each block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from of_text(batch.column(0)[row].as_py(), batch.column(1)[row], batch.column(2)[row])

    def of_text(doc_id, text, places):
        buffer = text.as_buffer()
        data = np.frombuffer(buffer, np.uint8)
        place = np.sort(places.values.to_numpy())
        for at in range(0, len(place), 4096):
            some = place[at : at + 4096]
            begin, size = some >> _POSITION, some & 127
            anchor = begin + ((some >> _ANCHOR) & 127)
            held, offsets = _gather(data, begin, size - 1 + width)
            shift = offsets[:-1] - begin
            run, first, n, core, whole = _blocks(held, offsets[:-1], anchor + shift, size, block, width)
            out, ends = _gather(held, first, n - 1 + width)
            begin_of = first - shift[run]
            salt = (some[run] >> _TEXT) & 0xFFFF
            where = (begin_of << _POSITION) | (salt << _TEXT) | ((anchor[run] - begin_of) << _ANCHOR) | n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core.view(np.int64)),
                    pa.array(whole.view(np.int64)),
                    pa.array(np.full(len(run), doc_id, np.int64)),
                    pa.array(where),
                    pa.Array.from_buffers(pa.binary(), len(run), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)]),
                ],
                names=_BLOCK_FIELDS,
            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in work(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= 20_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return merged


def _single_work(width: int):
    """Blocks to their single strings, named by two hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(2)
            data = np.frombuffer(texts.buffers()[2], np.uint8)
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            place, docs = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            size = place & 127
            run = np.repeat(np.arange(len(size)), size)
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = offsets[:-1][run] + step
            one, other = Rolling(59).of(data).hash(at, at + width), Rolling(61).of(data).hash(at, at + width)
            begin = (place[run] >> _POSITION) + step
            where = (begin << _POSITION) | (((place[run] >> _TEXT) & 0xFFFF) << _TEXT) | 1
            arrays = [mix(one).view(np.int64), mix(other).view(np.int64), docs[run], where]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=_BLOCK_FIELDS[:4])

    return work


def _cut_work(keep: str):
    """Texts with their repeated stretches to what is left."""

    def left_of(text: pa.Scalar, stretches: pa.Scalar) -> tuple[int, int, bytes]:
        data = text.as_buffer().to_pybytes()
        parts, at, n = [], 0, 0
        if stretches.is_valid:
            start, end = (stretches.values.field(i).to_numpy() for i in (0, 1))
            order = np.argsort(start, kind="stable")
            start, end = start[order], np.maximum.accumulate(end[order])
            new = np.ones(len(start), bool)
            new[1:] = start[1:] > end[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(start)) - 1
            n = len(first)
            for s, e in zip(start[first].tolist(), end[last].tolist()):
                parts.append(data[at:s])
                at = e
        parts.append(data[at:])
        return len(data), n, b"".join(parts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [left_of(*row) for row in zip(batch.column(1), batch.column(2))]
            out = {
                "doc_id": batch.column(0),
                "n_bytes": pa.array([n for n, _, _ in rows], pa.int64()),
                "n_removed": pa.array([n - len(left) for n, _, left in rows], pa.int64()),
                "n_spans": pa.array([n for _, n, _ in rows], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(left).hexdigest() for _, _, left in rows], pa.string()),
            }
            if keep == "bytes":
                out["kept"] = pa.array([left for _, _, left in rows], pa.binary())
            elif keep == "text":
                out["kept"] = pa.array([left.decode("utf-8", "ignore") for _, _, left in rows], pa.string())
            if batch.num_columns > 3:
                out["rest"] = batch.column(3)
            yield pa.RecordBatch.from_pydict(out)

    return work


def _ranked(rows: DataFrame) -> DataFrame:
    """Whether an equal row stands earlier, and whether rows of the name differ; one shuffle by name."""
    dealt = rows.repartition(F.col("name"))
    equal = Window.partitionBy("name", "whole").orderBy("id", "place")
    named = Window.partitionBy("name")
    return dealt.withColumn("later", F.rank().over(equal) > 1).withColumn(
        "mixed", F.min("whole").over(named) < F.max("whole").over(named)
    )


def _salt(places: str) -> Column:
    return F.shiftright(places, _TEXT).bitwiseAND(0xFFFF)


def _stretches(rows: DataFrame, width: int, length: Column | None = None) -> DataFrame:
    """Bytes covered by the strings of the rows' positions.

    ``length`` is that of the rows' own bytes, for rows that have them: both readers of the blocks then need the
    same columns and share one shuffle.
    """
    start = F.shiftright("place", _POSITION)
    size = F.col("place").bitwiseAND(127)
    end = F.when(size == 0, start + F.col("whole")).otherwise(start + size + (width - 1))
    end = end if length is None else start + length
    return rows.select("id", _salt("place").alias("salt"), start.alias("start"), end.alias("end"))


def repeated_passages(
    docs: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "bytes",
    carry: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept``: one row per input row.

    ``keep`` gives what is left as "bytes", as "text" (without the bytes of a character that was cut in part) or
    not at all ("none"). With ``carry`` the ``rest`` of the row goes along.

    A byte is removed if a string of ``width`` bytes (UTF-8) that covers it also starts earlier: in a row with a
    smaller doc_id, or earlier in the same text. Matches never cross texts, overlaps count, and
    strings are judged on the input. The first of equal strings always stays.

    A NULL text is empty; a text shorter than ``width`` is left whole; a row without doc_id is
    neither compared nor cut. Rows with one doc_id and different texts are texts of their own,
    equal starts among them ordered by a hash of the text; fully equal rows are one text, and all are returned. An
    empty table gives no row; other columns are ignored.
    """
    if width > 127 or width < SEED + BLOCK:
        raise ValueError(f"width must be between {SEED + BLOCK} and 127")
    # Under another name, so that the optimizer leaves both copies of the shared shuffle alike.
    along = ["rest"] if carry else []
    plain = common.texts(docs, id_col, text_col, carry).select(
        F.col("doc_id").alias("id"), F.xxhash64("text").bitwiseAND(0xFFFF).alias("salt"), "text", *along
    )
    with_id = plain.where("id IS NOT NULL")
    runs = with_id.select("id", "salt", "text").mapInArrow(
        _anchor_work(width, SEED), "name long, whole long, id long, place long"
    )
    known = F.col("place").bitwiseAND(127) == 0
    ranked = settle(
        _ranked(runs)
        .where(F.col("later") | F.col("mixed") | known)
        .select("id", "place", F.when(known, F.col("whole")).alias("whole"), (F.col("later") | known).alias("repeat"))
    )
    open_ = (
        ranked.where("NOT repeat")
        .distinct()
        .groupBy("id", _salt("place").alias("salt"))
        .agg(F.collect_list("place").alias("places"))
    )
    # From here on one job: the shuffle of the texts serves both joins, that of the blocks both readers.
    blocks = (
        with_id.join(open_.hint("shuffle_hash"), ["id", "salt"])
        .select("id", "text", "places", *along)
        .mapInArrow(_block_work(width, BLOCK), "name long, whole long, id long, place long, bytes binary")
    )
    blocks = _ranked(blocks)
    singles = (
        blocks.where("NOT later AND mixed")
        .select("id", "place", "bytes")
        .mapInArrow(_single_work(width), "name long, whole long, id long, place long")
    )
    single = Window.partitionBy("name", "whole").orderBy("id", "place")
    singles = singles.repartition(F.col("name")).withColumn("later", F.rank().over(single) > 1)
    stretches = (
        _stretches(ranked.where("repeat"), width)
        .unionByName(_stretches(blocks.where("later"), width, F.octet_length("bytes")))
        .unionByName(_stretches(singles.where("later"), width))
    )
    per_text = stretches.groupBy("id", "salt").agg(F.collect_list(F.struct("start", "end")).alias("stretches"))
    wanted = ["id", "text", "stretches", *along]
    cut = with_id.join(per_text.hint("shuffle_hash"), ["id", "salt"], "left").select(*wanted)
    whole = plain.where("id IS NULL").withColumn("stretches", F.lit(None).cast(cut.schema["stretches"].dataType))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += {"bytes": ", kept binary", "text": ", kept string", "none": ""}[keep]
    schema += f", rest {plain.schema['rest'].dataType.simpleString()}" if carry else ""
    return cut.unionByName(whole.select(*wanted)).mapInArrow(_cut_work(keep), schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(common.read_table(spark, sf_dir, "documents"), keep="none")
