"""Bounded-space online packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.session import settle

SEQUENCE = 4096
OPEN_WINDOWS = 32  # open windows per partition: 32 * 4096 ids, half a MB
MERGE_WIDTH = 64  # partitions whose leftovers meet in one task of a merging round
CACHED_WORDS = 500_000  # bound of a worker's word cache
_ID = 4  # bytes of an id

OUT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_PACKED = OUT + ", ids binary, part long"
_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part"]


class WordIds:
    """Ids of texts by the tokenizers library, with the ids of words it has seen kept in a bounded cache.

    The pattern of the vocabulary drops white space and matches nothing across it, so the ids of a
    text are those of its blank-separated words in turn. Words of Latin-1 letters only are one
    piece each and go to the library's BPE model directly; anything else goes through its whole
    chain of normalizer, splitter and model.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # How the byte-level alphabet writes the letters of Latin-1, asked of the library.
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)}
        self.cache: dict[str, bytes] = {"": b""}

    @staticmethod
    def _pack(ids) -> bytes:
        return b"".join(i.to_bytes(_ID, "little") for i in ids)

    def _word(self, word: str, latin: bool) -> bytes:
        found = self.cache.get(word)
        if found is not None:
            return found
        if latin and word.isalpha():
            written = word if word.isascii() else word.translate(self.letters)
            found = self._pack(t.id for t in self.model.tokenize(written))
        elif latin and word[-1] in ".," and word[:-1].isalpha():
            found = self._word(word[:-1], True) + self._word(word[-1], False)
        else:
            found = self._pack(self.whole.encode(word, add_special_tokens=False).ids)
        if len(word) <= 64:
            if len(self.cache) >= CACHED_WORDS:
                self.cache = {"": b""}
            self.cache[word] = found
        return found

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if "<|" in text:  # may hold the string of a special token, which may hold anything
            return self._pack(self.whole.encode(text, add_special_tokens=False).ids)
        try:
            text.encode("latin-1")
            latin = True
            text = text.lower()  # lower-casing and composition are plain within Latin-1
        except UnicodeEncodeError:
            latin = False
        words = text.replace("\n", " ").split(" ")
        found = list(map(self.cache.get, words))
        if None in found:
            found = [self._word(w, latin) if f is None else f for w, f in zip(words, found)]
        return b"".join(found)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Windows:
    """A fixed number of open windows; pieces go to the best fit, the fullest is emitted when none fits."""

    def __init__(self, size: int, n_open: int):
        self.size, self.n_open = size, n_open
        self.open: list[tuple[int, list]] = []  # (ids so far, pieces)

    def place(self, piece: tuple) -> list | None:
        """Put a piece of at most ``size`` ids; the pieces of a window that had to be emitted, if any."""
        length, emitted = len(piece[2]) // _ID, None
        fits = [(used, k) for k, (used, _) in enumerate(self.open) if used + length <= self.size]
        if fits:
            used, k = max(fits)
            self.open[k][1].append(piece)
            if used + length == self.size:
                return self.open.pop(k)[1]
            self.open[k] = (used + length, self.open[k][1])
            return None
        if len(self.open) >= self.n_open:
            emitted = self.open.pop(max(range(len(self.open)), key=lambda k: self.open[k][0]))[1]
        if length == self.size:
            # Only reached with an emitted window when all are open: a full piece needs none of them.
            raise ValueError("full pieces are emitted by the caller")
        self.open.append((length, [piece]))
        return emitted


def _closed(pieces: list, sequence: int) -> Iterator[tuple]:
    at = 0
    for doc_id, start, ids, total in pieces:
        n = len(ids) // _ID
        yield (doc_id, start, n, zlib.crc32(ids), total, sequence, at, None, None)
        at += n


def _powers(n: int) -> Iterator[int]:
    """Powers of two that add up to n, the largest first."""
    for bit in reversed(range(n.bit_length())):
        if n >> bit & 1:
            yield 1 << bit


def _drained(windows: Windows, size: int) -> Iterator[list]:
    """The last windows, cut so that each is full or a power of two long: no padding."""
    pieces = [p for _, held in sorted(windows.open, key=lambda w: -w[0]) for p in held]
    total = sum(len(p[2]) for p in pieces) // _ID
    lengths = [size] * (total // size) + list(_powers(total % size))
    for room in lengths:
        held = []
        while room:
            doc_id, start, ids, whole = pieces.pop(0)
            n = min(room, len(ids) // _ID)
            held.append((doc_id, start, ids[: n * _ID], whole))
            if n * _ID < len(ids):
                pieces.insert(0, (doc_id, start + n, ids[n * _ID :], whole))
            room -= n
        yield held


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
    kinds = [pa.int64()] * 7 + [pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_FIELDS)


def _pack(pieces: Iterator[tuple], size: int, n_open: int, round_: int, last: bool) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    sequence = (round_ << 56) + (part << 32)
    windows, rows = Windows(size, n_open), []
    for piece in pieces:
        emitted = [piece] if len(piece[2]) == size * _ID else windows.place(piece)
        if emitted:
            rows.extend(_closed(emitted, sequence))
            sequence += 1
        if len(rows) >= 2000:
            yield _rows(rows)
            rows = []
    if last:
        for held in _drained(windows, size):
            rows.extend(_closed(held, sequence))
            sequence += 1
    else:
        for _, held in windows.open:
            rows.extend((d, s, len(ids) // _ID, None, t, None, None, ids, part) for d, s, ids, t in held)
    yield _rows(rows)


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int = 2,
    size: int = SEQUENCE,
    n_open: int = OPEN_WINDOWS,
    merge_width: int = MERGE_WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document, with its place in a sequence of at most ``size`` ids.

    Every task tokenizes its documents and packs them as they come: a document beyond ``size`` ids
    gives full sequences and a rest; a rest goes to the open window it fills best; when none has
    room the fullest window is emitted. What is left in the windows (``n_open`` of them per task)
    meets in rounds, ``merge_width`` tasks to one, until one task holds the last windows and cuts
    them into full sequences and powers of two. So a task never holds more than
    ``n_open * merge_width`` windows, and only the padding of emitted windows remains.

    A NULL or empty text is the end id alone; repeated rows and ids are packed each for itself; an
    empty table gives no row; other columns are ignored. Closed pieces are written once with their
    checksums, and only leftovers carry ids, so nothing is tokenized twice.
    """
    end = end_id.to_bytes(_ID, "little")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    ids = known.ids(text.as_py()) + end
                    total, key = len(ids) // _ID, doc_id.as_py()
                    for at in range(0, total, size):
                        yield key, at, ids[at * _ID : (at + size) * _ID], total

        yield from _pack(pieces(), size, n_open, 0, False)

    def again(round_: int, last: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # At most merge_width * n_open windows; the longest first, as best fit likes it.
            held = [
                tuple(row)
                for batch in batches
                for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")))
            ]
            held.sort(key=lambda p: (-len(p[2]), p[0] is None, p[0] or 0, p[1]))
            yield from _pack(iter(held), size, n_open, round_, last)

        return work

    table = settle(common.texts(docs, id_col, text_col).mapInArrow(first, _PACKED))
    closed, round_ = [table.where("ids IS NULL")], 0
    while True:
        left = table.where("ids IS NOT NULL").select("doc_id", "start", "ids", "doc_tokens", "part")
        top = left.agg(F.max("part")).first()[0]
        if top is None:
            break
        round_, groups = round_ + 1, -(-(top + 1) // merge_width)
        # Group g meets in task g alone, so a task holds merge_width tasks' windows and its number is the next round's part.
        met = left.repartitionById(groups, F.floor(F.col("part") / merge_width).cast("int"))
        table = settle(met.mapInArrow(again(round_, groups == 1), _PACKED))
        closed.append(table.where("ids IS NULL"))
        if groups == 1:
            break
    result = closed[0]
    for more in closed[1:]:
        result = result.unionByName(more)
    return result.select(*_FIELDS[:7])


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(
        common.read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
