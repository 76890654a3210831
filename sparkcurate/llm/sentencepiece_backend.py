"""SentencePiece models on the tokenizers library: model file parsed here, encoding, decoding, parity."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .piece_cache import PieceCache, joined_encode
from .shared import bounded_batches, fresh, kept, lean, load

META = "▁"
#: Pieces of text whose ids a worker remembers.
CACHED = 150_000
# Fixed values of the format: types of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message; fixed-width values stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + n]
        at += n


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        """ModelProto: 1 pieces (1 text, 2 score, 3 type), 2 trainer (3 kind, 35 byte fallback, 40 unknown id), 3 normaliser (2 map, 3 dummy prefix, 4 extra spaces removed)."""
        m = cls()
        for number, value in fields(data):
            if number == 1:
                text, score, kind = "", 0.0, NORMAL
                for k, v in fields(value):
                    if k == 1:
                        text = v.decode()
                    elif k == 2:
                        score = struct.unpack("<f", v)[0]
                    elif k == 3:
                        kind = v
                m.pieces.append((text, score, kind))
            elif number == 2:
                for k, v in fields(value):
                    if k == 3:
                        m.kind = v
                    elif k == 35:
                        m.byte_fallback = bool(v)
                    elif k == 40:
                        m.unk_id = v
            elif number == 3:
                for k, v in fields(value):
                    if k == 2:
                        m.charsmap = v
                    elif k == 3:
                        m.dummy_prefix = bool(v)
                    elif k == 4:
                        m.squeeze = bool(v)
        return m


def merges(m: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first; a piece's own pairs from its left."""
    known = {t: s for t, s, k in m.pieces if k == NORMAL}
    found = []
    for text, score in known.items():
        for cut in range(1, len(text)):
            if text[:cut] in known and text[cut:] in known:
                found.append((-score, cut, text[:cut], text[cut:]))
    found.sort()
    return [(a, b) for _, _, a, b in found]


def library_tokenizer(m: Model, normalise: bool = True):
    """A tokenizers.Tokenizer with the model's pieces, normaliser, space marker, byte fallback and decoder.

    normalise=False leaves out the character map and the removal of spaces, for texts that had both.
    """
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if m.kind == UNIGRAM:
        # the library can't hold pieces that mustn't match, so their scores are out of reach
        low = min((s for _, s, _ in m.pieces), default=0.0) - 1e4
        vocab = [(t, s if k in (NORMAL, BYTE, UNKNOWN) else low) for t, s, k in m.pieces]
        model = models.Unigram(vocab, unk_id=m.unk_id, byte_fallback=m.byte_fallback)
    elif m.kind == BPE:
        vocab = {t: i for i, (t, _, _) in enumerate(m.pieces)}
        model = models.BPE(vocab, merges(m), unk_token=m.pieces[m.unk_id][0], fuse_unk=True, byte_fallback=m.byte_fallback)
    else:
        raise ValueError(f"models of kind {m.kind} aren't supported")
    t = Tokenizer(model)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap and normalise else []
    if m.squeeze and normalise:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(META)] * m.dummy_prefix + [normalizers.Replace(" ", META)]
    t.normalizer = normalizers.Sequence(steps)
    t.decoder = decoders.Sequence([decoders.Replace(META, " "), decoders.ByteFallback(), decoders.Fuse()] + ([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []))
    own = [AddedToken(p, normalized=False, special=False) for p, _, k in m.pieces if k == USER_DEFINED]
    if own:
        t.add_tokens(own)
    return t


def splits_at_spaces(m: Model) -> bool:
    """Whether no piece has a space after a non-space: then texts part before each run of spaces."""
    return m.dummy_prefix and not any(re.search(f"[^{META}]{META}", t) or k == USER_DEFINED for t, _, k in m.pieces)


RUNS = re.compile(r"( +)([^ ]*)")


def run_keys(text: str, first: bool) -> list[str]:
    """Keys are what follows each space of ' ' + text; of a run of spaces, all but the first are in the key."""
    if META in text:
        text = text.replace(META, " ")
    if "  " in text or text[:1] == " ":
        return [a[1:] + b for a, b in RUNS.findall(" " + text)]
    return text.split(" ") if text else []


class Codec:
    """Encodes and decodes texts by one model file.

    All ids are the tokenizers library's. Each distinct piece that the cache learns is encoded by the
    sentencepiece library too; where they differ, the piece is noted (bad), and texts with it are told.
    Pieces of models with a character map, or that remove extra spaces, come after both, so that the other
    library would not see the same text: there whole texts are compared as they come. Empty text has no ids.
    """

    def __init__(self, path: str, threads: int = 2, verify: bool = True) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        with open(path, "rb") as f:
            self.model = m = Model.parse(f.read())
        inner = library_tokenizer(m, normalise=False)
        self.reference = None
        if verify:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.threads = threads
        self.comparable = self.reference is not None and not m.squeeze and not m.charsmap
        self.bad: set[str] = set()
        self.by_piece = splits_at_spaces(m)
        self.charsmap = None
        if m.charsmap:
            from tokenizers import normalizers

            self.charsmap = normalizers.Precompiled(m.charsmap)

        starts = np.array([t[:1] == META for t, _, _ in m.pieces])

        def ids_of(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in inner.encode_batch_fast(texts, add_special_tokens=False)]

        def alone(keys: list[str]) -> list[list[int]]:
            marker = [inner.token_to_id(META)] if self.by_piece else []  # of a space that ends a text
            ids = [one if key else marker for key, one in zip(keys, ids_of(keys), strict=True)]
            if self.comparable:
                self.bad.update(key for key, own, other in zip(keys, ids, self.reference.encode(keys, num_threads=threads), strict=True) if key and own != other)
            return ids

        def encode(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
            if not self.by_piece:
                own = alone(keys)
                return np.array([x for one in own for x in one], np.uint32), np.fromiter(map(len, own), np.int64, len(own))

            def together(texts: list[str]) -> list[list[int]]:
                ids = ids_of(texts)
                if self.comparable:
                    for text, own, other in zip(texts, ids, self.reference.encode(texts, num_threads=threads), strict=True):
                        if own != other:
                            alone(text.split(" "))  # piece by piece, to note which
                return ids

            return joined_encode(keys, lambda key: -1 if key == "" or key[0] == " " else 0, [together], alone, starts)

        self.keys = run_keys if self.by_piece else (lambda text, first: [text] if text else [])
        self.cache = PieceCache(self.keys, encode, limit=CACHED, cut=self.by_piece)
        pieces = [bytes([int(t[3:-1], 16)]) if k == BYTE else b"" if k == CONTROL else t.replace(META, " ").encode() for t, _, k in m.pieces]
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_len = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len

    @cached_property
    def full(self):
        """The library's tokenizer for whole texts, as they come."""
        return library_tokenizer(self.model)

    def normal(self, text: str) -> str:
        """The text after the character map and, if the model says so, without extra spaces."""
        if self.charsmap is not None:
            text = self.charsmap.normalize_str(text)
        if self.model.squeeze:
            text = re.sub(" {2,}", " ", text).strip(" ")
        return text

    def parity(self, text: str, plain: str, ids: np.ndarray) -> bool | None:
        """Whether the other library gives a text the same ids, by its pieces or as a whole; null where it wasn't asked."""
        if self.reference is None:
            return None
        if self.comparable:
            return not self.bad or self.bad.isdisjoint(self.keys(plain, True))
        return self.reference.encode(text) == ids.tolist()

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        return self.cache.texts(map(self.normal, texts))

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the ids' text: pieces, markers as spaces, byte pieces as bytes; the dummy space is taken off."""
        n = self.piece_len[ids]
        take = np.repeat(self.piece_at[ids] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        out = self.piece_bytes[take].tobytes()
        return out[1:] if self.model.dummy_prefix and out[:1] == b" " else out


def codec_of(path: str, threads: int, verify: bool) -> Codec:
    return kept("codec", (path, threads, verify), lambda: Codec(path, threads, verify))


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), ids: bool = False, threads: int = 2, verify: bool = True) -> DataFrame:
    """One row per document: id, the columns in keep, n_tokens, ids_crc32, decoded_bytes, decoded_ok, parity, and token_ids if ids.

    ids_crc32 is that of the ids as little-endian 32-bit integers. decoded_ok: decoding the ids gives
    the normalised text again, byte for byte. parity: both libraries gave the same ids for the text, null
    where they weren't compared (verify). Null text counts as empty: no ids, and both are true. Null or
    repeated ids and other columns don't matter, for each row is handled alone; an empty table gives no
    rows. A column to keep that has the name of a new one has _1, _2, ... put to its name, whichever is free.
    """
    from pyspark.sql import types as T

    columns = list(dict.fromkeys([id_col, *keep]))
    new = T.StructType().add("n_tokens", "long").add("ids_crc32", "long").add("decoded_bytes", "long").add("decoded_ok", "boolean").add("parity", "boolean")
    if ids:
        new = new.add("token_ids", T.ArrayType(T.IntegerType()))
    names: list[str] = []
    for c in columns:
        names.append(fresh(c, [*new.names, *(x for x in columns if x != c), *names]))
    schema = T.StructType([T.StructField(name, docs.schema[c].dataType) for name, c in zip(names, columns, strict=True)] + new.fields)
    docs = docs.select(F.struct("*").alias("row")).select(*(F.col("row")[c].alias(f"c{k}") for k, c in enumerate(columns)), F.col("row")[text_col].alias("text"))

    def run(batches):
        codec = codec_of(model_path, threads, verify)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [x or "" for x in part.column("text").to_pylist()]
                n, crc, size, good, same, every = [], [], [], [], [], []
                for text, one in zip(texts, codec.encode(texts), strict=True):
                    n.append(len(one))
                    crc.append(zlib.crc32(one.astype("<u4").tobytes()))
                    back = codec.decode(one)
                    size.append(len(back))
                    plain = codec.normal(text)
                    good.append(back == plain.replace(META, " ").encode(errors="replace"))
                    same.append(codec.parity(text, plain, one))
                    if ids:
                        every.append(one.astype(np.int32))
                out = part.columns[: len(columns)] + [pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(size, pa.int64()), pa.array(good, pa.bool_()), pa.array(same, pa.bool_())]
                if ids:
                    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *every]))))
                yield pa.RecordBatch.from_arrays(out, schema.names)

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(lean(run), schema)


def slices(batch: pa.RecordBatch, text_col: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about limit bytes of text, one row at least."""
    sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(batch.column(text_col)).to_pylist()], np.int64)
    group = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
