import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkcurate.llm import huffman_ids, piece_cache, sentencepiece_backend
from sparkcurate.llm.shared import new_folder

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a  b", " a \n b\n\n  c", "x \t\ny ", "  b  c", "don't we'll ", "<|endoftext|> a<|endoftext|> b", "a▁b", "é漢字 😀  x ", "<s> a</s> b", "word " * 3_000]
TEXTS = st.text(st.sampled_from("ab é\n\t ▁.,!<|>'s1"), max_size=60)


def test_package_merge_is_optimal_and_limited():
    rng = np.random.default_rng(1)
    counts = np.concatenate([rng.integers(0, 50, 300), [10**6, 10**7]])
    lengths = huffman_ids.code_lengths(counts, 20)
    assert (2.0 ** -lengths[lengths > 0].astype(float)).sum() == 1
    assert ((lengths == 0) == (counts == 0)).all()
    short = huffman_ids.code_lengths(counts, 9)
    assert short.max() == 9 and (2.0 ** -short[short > 0].astype(float)).sum() <= 1
    import heapq

    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    best = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        best += a
        heapq.heappush(heap, a)
    assert (counts * lengths).sum() == best


@given(st.lists(st.integers(0, 40), min_size=1, max_size=2_000))
@settings(max_examples=60, deadline=None)
def test_pack_and_unpack(ids):
    ids = np.array(ids, np.uint32)
    lengths = huffman_ids.code_lengths(np.bincount(ids, minlength=41))
    data, marks = huffman_ids.pack(ids, huffman_ids.canonical_codes(lengths), lengths)
    table, top = huffman_ids.decoding_table(lengths)
    assert (huffman_ids.unpack(data, len(ids), marks, table, top) == ids).all()


@pytest.mark.parametrize("ordered", [False, True])
def test_id_files(spark, monkeypatch, tmp_path, ordered):
    monkeypatch.setattr(huffman_ids, "FILE_DOCS", 4)
    monkeypatch.setattr(huffman_ids, "NUMBERED", 2)
    rows = [(len(ODD) - k, t) for k, t in enumerate(ODD)] + [(None, "null id"), (3, None), (3, "again")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start long")
    if ordered:
        docs.where("doc_id > 5").orderBy("doc_id").coalesce(1).write.parquet(f"{tmp_path}/d")
        docs.where("doc_id IS NULL OR doc_id <= 5").orderBy("doc_id").coalesce(1).write.mode("append").parquet(f"{tmp_path}/d")
        docs = spark.read.parquet(f"{tmp_path}/d")
    assert (huffman_ids.blocks_in_order(docs, "doc_id", "text") is not None) == ordered
    files = huffman_ids.write_ids(docs, BPE, new_folder(spark, "huf"))
    assert files.count() > 1
    got = huffman_ids.read_ids(files).orderBy("start").collect()
    library = Tokenizer.from_file(BPE)
    start = 0
    left = {}
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        left.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    for r in got:
        assert r.start == start
        left[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    assert huffman_ids.read_ids(huffman_ids.write_ids(docs.limit(0), BPE, new_folder(spark, "huf"))).collect() == []


def test_overlapping_files_are_sorted(spark, tmp_path):
    table = spark.range(100).selectExpr("id doc_id", "concat('t ', id) text")
    table.where("doc_id < 60").coalesce(1).write.parquet(f"{tmp_path}/d")
    table.where("doc_id >= 59").coalesce(1).write.mode("append").parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    assert huffman_ids.blocks_in_order(docs, "doc_id", "text") is not None  # an id may end one part and begin the next
    table.where("doc_id = 3").coalesce(1).write.mode("append").parquet(f"{tmp_path}/d")
    assert huffman_ids.blocks_in_order(spark.read.parquet(f"{tmp_path}/d"), "doc_id", "text") is None
    assert huffman_ids.blocks_in_order(docs.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))), "doc_id", "text") is None


def test_numbers_and_sums(spark, monkeypatch):
    monkeypatch.setattr(huffman_ids, "NUMBERED", 3)
    table = spark.range(20).selectExpr("(id * 7) % 20 AS low", "id AS n_ids")
    rows = sorted(tuple(r) for r in huffman_ids.in_order(table, ["low"], "n_ids").select("file_no", "low", "n_ids", "start").collect())
    start = 0
    for k, (no, low, n, before) in enumerate(rows):
        assert (no, low, before) == (k, k, start)
        start += n


def test_more_ids_than_short_codes():
    lengths = huffman_ids.code_lengths(np.ones(20, np.int64), 3)
    assert lengths.max() == 5 and (2.0 ** -lengths.astype(float)).sum() <= 1


@given(st.lists(TEXTS, max_size=6))
@settings(max_examples=200, deadline=None)
def test_cached_ids_are_the_librarys(texts):
    library = Tokenizer.from_file(BPE) if not hasattr(test_cached_ids_are_the_librarys, "t") else test_cached_ids_are_the_librarys.t
    test_cached_ids_are_the_librarys.t = library
    cache = huffman_ids.cache_of(BPE)
    assert [x.tolist() for x in cache.texts(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_cut_texts(monkeypatch):
    monkeypatch.setattr(piece_cache, "CHUNK", 50)
    cache = huffman_ids.cache_of(BPE)
    monkeypatch.setattr(cache, "limit", 20)
    library = Tokenizer.from_file(BPE)
    texts = [*ODD, "some words that go on " * 40, "x" * 300]
    assert [x.tolist() for x in cache.texts(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_sentencepiece(spark):
    import sentencepiece

    reference = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(None, None, None), (3, "again", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens_before string")
    got = sentencepiece_backend.encode_decode(docs, PIECES, keep=("n_tokens_before",), ids=True).collect()
    assert sorted(map(str, ((r.doc_id, r.token_ids) for r in got))) == sorted(map(str, ((i, reference.encode(t or "")) for i, t, _ in rows)))
    assert all(r.decoded_ok and r.parity and r.n_tokens == len(r.token_ids) for r in got)
    assert sentencepiece_backend.encode_decode(docs.limit(0), PIECES).collect() == []


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_codec_round_trip(text):
    codec = sentencepiece_backend.codec_of(PIECES, 1, True)
    ids = next(iter(codec.encode([text])))
    assert ids.tolist() == codec.reference.encode(text)
    assert codec.decode(ids).decode() == text.replace("▁", " ")
    assert codec.full.encode(text, add_special_tokens=False).ids == ids.tolist() or not text
    assert not codec.bad


def field_(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def model_file(pieces, normaliser, kind=1):
    """A small model written out by hand."""
    every = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), *pieces]
    body = b"".join(field_(1, field_(1, t.encode()) + field_(2, s) + field_(3, k)) for t, s, k in every)
    return body + field_(2, field_(3, kind) + field_(35, 1) + field_(40, 0)) + field_(3, normaliser)


LETTERS = [("▁", -3.0, 1), ("a", -3.5, 1), ("b", -3.6, 1), ("ab", -4.0, 1), ("▁a", -4.2, 1), ("▁ab", -5.5, 1), ("c", -4.9, 1)]
IDENTITY = field_(1, b"identity") + field_(3, 1) + field_(4, 0)


def test_unigram(tmp_path):
    import sentencepiece

    path = tmp_path / "u.model"
    path.write_bytes(model_file(LETTERS, IDENTITY))
    reference = sentencepiece.SentencePieceProcessor(model_file=str(path))
    codec = sentencepiece_backend.Codec(str(path), threads=1)
    texts = ["ab", "ab a b", "abc cab", "", "aab  b", "xé"]
    assert [x.tolist() for x in codec.encode(texts)] == [reference.encode(t) for t in texts]
    assert [codec.decode(x).decode() for x in codec.encode(texts)] == texts


def charsmap():
    import sentencepiece

    spec = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    for number, value in sentencepiece_backend.fields(spec):
        if number == 3:
            return dict(sentencepiece_backend.fields(value))[2]


@pytest.mark.parametrize("kind", ["squeeze", "mapped", "joined"])
def test_normalising_models_are_compared_whole(spark, tmp_path, kind):
    import sentencepiece

    pieces, normaliser = LETTERS, field_(1, b"own") + field_(3, 1) + field_(4, 1)
    if kind == "mapped":
        normaliser += field_(2, charsmap())
    if kind == "joined":  # a piece with a space inside, so that texts don't part at spaces
        pieces, normaliser = [*LETTERS, ("a▁b", -2.0, 1)], IDENTITY
    path = tmp_path / "m.model"
    path.write_bytes(model_file(pieces, normaliser))
    reference = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["ab", "  ab   a b ", "", "   ", "ａｂ ① ab", "a b a b c", "xé  a", "a\u00a0b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in sentencepiece_backend.encode_decode(docs, str(path), ids=True).collect()}
    for k, t in enumerate(texts):
        assert got[k].parity == (got[k].token_ids == reference.encode(t))
    assert all(r.parity for r in got.values()) and all(r.decoded_ok for r in got.values())
    unasked = sentencepiece_backend.encode_decode(docs, str(path), verify=False).collect()
    assert {r.parity for r in unasked} == {None}


def test_differences_are_told_and_ids_kept(spark, monkeypatch):
    codec = sentencepiece_backend.Codec(PIECES, threads=1)
    real = codec.reference

    class Other:
        def encode(self, texts, **kw):
            one = lambda t: [x + ("odd" in t) for x in real.encode(t)]
            return one(texts) if isinstance(texts, str) else [one(t) for t in texts]

    codec.reference = Other()
    texts = ["plain words", "an odd word", "oddly", "more plain words"]
    ids = list(codec.encode(texts))
    assert [x.tolist() for x in ids] == [real.encode(t) for t in texts]
    assert [codec.parity(t, codec.normal(t), x) for t, x in zip(texts, ids, strict=True)] == [True, False, False, True]


@pytest.mark.parametrize("value", [b"", b"\x08\x96\x01"])
def test_fields(value):
    assert list(sentencepiece_backend.fields(value)) == ([(1, 150)] if value else [])
