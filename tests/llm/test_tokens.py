"""Packing, token files and token counts against the tokenizer itself."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from fixtures import odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from goldthread.llm import pieces
from goldthread.llm.common import shared_path
from goldthread.llm.packing import cut_lengths, pack
from goldthread.llm.pieces import Pieces, load_tokenizer, packed_ids
from goldthread.llm.queries import WORD_BPE
from goldthread.llm.token_counts import count_tokens
from goldthread.llm.token_files import FrameReader, read_token_files, token_file_digest, write_token_files

TOKENIZER = load_tokenizer(WORD_BPE)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def packed(values):
    return np.array(values, "<u4").tobytes()


def texts_of(texts):
    return pa.array(texts, pa.large_string())


@settings(max_examples=250, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZzbr 1'.,;:!?\n\t\x0b\x1c\x85 \u3000éÉ́İßΣÿ÷×ñœ漢<|>endoftxsr🙂"), max_size=30), max_size=4))
def test_pieces_give_the_ids_of_the_library(texts):
    texts = [*texts, "<|endoftext|> it's", "don't stop. Don't! éa., x", "<|ENDOFTEXT|>", "a" * 300 + " " + "a" * 300]
    assert packed_ids(WORD_BPE, texts_of(texts)) == [packed(ids(t)) for t in texts]


def test_a_full_cache_changes_nothing():
    for counts in (True, False):
        small = Pieces(WORD_BPE, counts=counts, most=3)
        for text in ("a b c d", "e f g a", "a b c d e f g h", "h a", "", "größe Größe."):
            found, ends = small.of(texts_of([text, text]))
            assert ends.tolist() == [0, len(ids(text)), 2 * len(ids(text))] and (counts or found.tolist() == 2 * ids(text))
        assert len(small.table.key) <= 12


def test_long_texts_are_cut(monkeypatch):
    monkeypatch.setattr(pieces, "STRETCH", 20)
    for text in ("one two  three four, five. " * 9, "a" * 90, "x <|endoftext|> y <|endoftext|>z" * 3, "é" * 30 + " ß " * 30):
        for counts in (True, False):
            found, ends = Pieces(WORD_BPE, counts).of(texts_of([text]))
            assert ends.tolist() == [0, len(ids(text))] and (counts or found.tolist() == ids(text))


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(pieces.Hashed, "of", lambda self, starts, ends: np.zeros(len(starts), np.uint64))
    same = Pieces(WORD_BPE)
    for text in ("red green blue", "blue yellow red. red"):
        assert same.of(texts_of([text]))[0].tolist() == ids(text)


def test_given_lengths_are_used_first():
    given_ = pieces.counted(WORD_BPE, ["hello", ",", "größe", "x1", "hello"])
    both = Pieces(WORD_BPE, True, given_)
    text = "Hello, GRÖßE größe x1 y2"
    assert both.of(texts_of([text]))[1].tolist() == [0, len(ids(text))] and len(given_.key) == 4 and len(both.table.key) == 2


@pytest.mark.parametrize("seed_documents", [1, 10_000])
def test_counts(spark, seed_documents):
    docs = odd_documents(spark, "Hello, world! " * 1500, "<|startoftext|> x")
    got = count_tokens(docs, WORD_BPE, seed_documents=seed_documents)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(r.doc_id, len((r.text or "").encode()), len(ids(r.text)), len(ids(r.text)) > 2048) for r in docs.collect()]
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert any(w[3] for w in want)
    assert count_tokens(docs.limit(0), WORD_BPE).count() == 0


def test_token_files_round_trip(spark):
    docs = odd_documents(spark)
    path = shared_path(spark, "tokens")
    manifest = write_token_files(docs, path, WORD_BPE)
    read = read_token_files(spark, manifest, step=3).orderBy("part", "piece", "frame").collect()
    rows = docs.collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in read) == [(r.doc_id is not None, r.doc_id or 0) for r in read]
    assert Counter((r.doc_id, bytes(r.packed)) for r in read) == Counter((r.doc_id, packed([*ids(r.text), 1])) for r in rows)
    got = token_file_digest(docs, WORD_BPE).collect()
    want = Counter((r.doc_id, len(ids(r.text)) + 1, zlib.crc32(packed([*ids(r.text), 1]))) for r in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert token_file_digest(docs.limit(0), WORD_BPE).count() == 0


def test_a_reader_takes_single_documents_and_finds_damage(spark):
    docs = odd_documents(spark).coalesce(1)
    manifest = write_token_files(docs, shared_path(spark, "tokens"), WORD_BPE).collect()
    readers = [FrameReader(m.file) for m in manifest]
    found = [d for r in readers for d in r.document(5)]
    text = docs.filter("doc_id = 5").first().text
    assert [d.tolist() for d in found] == [[*ids(text), 1]] * 3
    assert sum(len(r.document(None)) for r in readers) == 2 and not any(r.document(-9) for r in readers)
    fs, path = pafs.LocalFileSystem(), manifest[0].file.removeprefix("file://")
    with fs.open_input_file(path) as file:
        data = bytearray(file.read())
    data[len(data) // 3] ^= 1
    with fs.open_output_stream(path) as out:
        out.write(bytes(data))
    with pytest.raises(Exception):
        damaged = FrameReader(manifest[0].file)
        [damaged.frame(i) for i in range(len(damaged.entries))]


@settings(deadline=None)
@given(st.integers(1, 50_000))
def test_cut_lengths_cover_the_document(n):
    pieces = cut_lengths(n)
    assert sum(pieces) == n and all(0 < p <= 4096 for p in pieces)
    assert all(p == 4096 // (4096 // p) for p in pieces if p >= 256) and sum(p < 256 for p in pieces) <= 1


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(spark, capacity):
    docs = odd_documents(spark)
    docs = docs.union(docs).union(docs)
    got = pack(docs, WORD_BPE, capacity=capacity, keep_ids=True).toPandas()
    want = Counter((None if r.doc_id is None else r.doc_id, tuple([*ids(r.text), 2])) for r in docs.collect())
    by_doc = Counter()
    for (doc, n), part in got.groupby(["doc_id", "doc_tokens"], dropna=False):
        assert part.length.sum() % n == 0
    for (doc, tokens), times in want.items():
        own = got[(got.doc_id.isna() if doc is None else got.doc_id == doc) & (got.doc_tokens == len(tokens))]
        for p in own.itertuples():
            assert len(p.ids) == p.length and p.ids_crc32 == zlib.crc32(packed(p.ids))
            if tuple(tokens[p.start:p.start + p.length]) == tuple(p.ids):
                by_doc[doc, tokens] += p.length
    assert all(by_doc[k] >= len(k[1]) * n for k, n in want.items())
    assert got.length.sum() == sum(len(t) * n for (_, t), n in want.items())
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all()
    size = got.groupby("sequence_id").length.sum()
    assert size.max() <= capacity and sorted(size.index) == list(range(len(size)))
    assert sum(capacity - s for s in size if s & (s - 1)) <= 0.02 * got.length.sum() + capacity
    assert pack(docs.limit(0), WORD_BPE).count() == 0
