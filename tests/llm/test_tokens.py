import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ionsift.llm import byte_bpe, common, packing
from tests.llm.conftest import CLASHING, ODD, SMALL

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(whole, text):
    ids = whole.encode_ordinary(text or "")
    digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    return len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_equals_the_library(docs, whole):
    got = byte_bpe.encode_documents(docs(ODD, **CLASHING), RANKS, P.PATTERN).collect()
    want = sorted((i or -1, *expected(whole, t)) for i, t in ODD)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_bpe_whole_table(spark, whole):
    got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.op3_byte_bpe(spark, SMALL).collect()}
    assert got == {r.doc_id: expected(whole, r.text) for r in common.documents(spark, SMALL).collect()}


def test_bpe_round_trip_and_empty(docs, spark):
    text = "naïve 漢字 — 'twas 3,000 🎈\n\n  end"
    ids = byte_bpe.encode_documents(docs([(1, text)]), RANKS, P.PATTERN, keep_ids=True)
    assert byte_bpe.decode_documents(ids, RANKS, P.PATTERN).first().bytes.decode() == text
    assert byte_bpe.encode_documents(docs([]), RANKS, P.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab1 \n\t'sé漢#\u00a0", max_size=80), st.integers(1, 20))
def test_safe_pieces_do_not_change_the_ids(text, size):
    whole = byte_bpe.encoding(RANKS, P.PATTERN)
    pieces = list(byte_bpe.safe_pieces(text, size))
    assert "".join(pieces) == text
    assert [i for p in pieces for i in whole.encode_ordinary(p)] == whole.encode_ordinary(text)


def check_packing(rows, texts, size=4096):
    library = Tokenizer.from_file(WORDS)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
    ids = [np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for _, t in texts]
    assert sum(r.length for r in rows) == sum(len(i) // 4 for i in ids)
    for (doc, _), held in zip(texts, ids):
        own = [r for r in pieces[doc, len(held) // 4]]
        assert {r.start for r in own} >= {0}
        copies = sum(1 for (d, _), h in zip(texts, ids) if d == doc and len(h) == len(held))
        assert sum(r.length for r in own) == copies * len(held) // 4
        if copies == 1:
            assert all(r.ids_crc32 == zlib.crc32(held[4 * r.start : 4 * (r.start + r.length)]) for r in own)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert 0 < at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / sum(r.length for r in rows) if rows else 0


def test_packing_odd_texts(docs):
    rows = packing.pack_documents(docs(ODD, **CLASHING), WORDS).collect()
    check_packing(rows, ODD)


def test_packing_whole_table_has_little_padding(spark):
    rows = packing.op4_packing(spark, SMALL).collect()
    assert check_packing(rows, [(r.doc_id, r.text) for r in common.documents(spark, SMALL).collect()]) < 0.03


def test_packing_merges_leftovers_in_rounds(docs):
    texts = [(i, f"word{i} " * (i * 37 % 90)) for i in range(300)]
    rows = packing.pack_documents(docs(texts, parts=12), WORDS, size=128, n_open=4, merge_width=3).collect()
    assert check_packing(rows, texts, 128) < 0.1
    assert len({r.sequence_id >> 56 for r in rows}) >= 3


def test_packing_empty_table(docs):
    assert packing.pack_documents(docs([]), WORDS).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_word_cache_equals_the_library(text):
    library = Tokenizer.from_file(WORDS)
    for _ in range(2):
        got = np.frombuffer(packing.word_ids(WORDS).ids(text), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids


def test_words_with_special_strings_and_case():
    library, known = Tokenizer.from_file(WORDS), packing.word_ids(WORDS)
    for text in ("a<|endoftext|>b", "ÀÉÎ ÇA, là. ªº µ", "İstanbul ΣΑΣ", "e\u0301 \u0301x", "I'll don't 'S 's", "x.,  ..,\xa0y\x85z\x1c"):
        assert np.frombuffer(known.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
