"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ionsift.llm import common

# A text longer than this is encoded in pieces, so the memory of one call stays small.
PIECE_CHARS = 50_000

# Places where a match of the pattern certainly ends: every alternative that holds a letter or digit is a run
# of one class, so none goes on over a following blank or line break, nor from a letter to a digit.
_SAFE_END = re.compile(r"[^\W_](?=[ \n])|[A-Za-z](?=[0-9])")


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters whose encodings join to that of the whole.

    A text without a safe place after ``size`` characters stays in one piece from there on.
    """
    start = 0
    while len(text) - start > size:
        found = _SAFE_END.search(text, start + size)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The tiktoken encoding of a rank file, loaded once in each Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, path: str, pattern: str) -> list[int]:
    """Ids of a whole text, without special tokens; strings of special tokens are ordinary text."""
    known = encoding(path, pattern)
    if len(text) <= PIECE_CHARS:
        return known.encode_ordinary(text)
    return [i for piece in safe_pieces(text) for i in known.encode_ordinary(piece)]


def decode(ids: list[int], path: str, pattern: str) -> bytes:
    """The bytes of the ids; not decoded to a string, since an id may hold part of a character."""
    return encoding(path, pattern).decode_bytes(ids)


def _column_work(path: str, pattern: str, keep_ids: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoding(path, pattern)
        names = [str(i).encode() for i in range(known.n_vocab)]
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            for text in batch.column(1):
                ids = encode(text.as_py(), path, pattern)
                counts.append(len(ids))
                digests.append(hashlib.sha256(b" ".join(map(names.__getitem__, ids))).hexdigest())
                decoded.append(hashlib.sha256(known.decode_bytes(ids)).hexdigest())
                if keep_ids:
                    lists.append(ids)
            out = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(digests, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string()),
            }
            if keep_ids:
                out["ids"] = pa.array(lists, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    return work


def encode_documents(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row per input row: token count, digest of the ids, digest of the bytes decoded from them.

    A NULL text counts as empty (0 tokens); repeated rows give repeated results; an empty table
    gives an empty one; other columns are ignored. A map over the rows: nothing is shuffled and
    one text at a time is held. ``keep_ids`` adds the ids themselves.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""
    return common.texts(docs, id_col, text_col).mapInArrow(_column_work(path, pattern, keep_ids), schema)


def decode_documents(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` back to ``bytes``; NULL ids give no bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            back = [decode(ids.as_py() or [], path, pattern) for ids in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "bytes": pa.array(back, pa.binary())})

    return tokens.select("doc_id", "ids").mapInArrow(work, "doc_id long, bytes binary")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(
        common.read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
