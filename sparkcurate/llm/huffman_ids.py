"""Token ids in files: canonical length-limited Huffman codes, independent blocks, bit-offset checkpoints."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .piece_cache import PieceCache, joined_encode, spaced_keys
from .shared import bounded_batches, filesystem, forget, kept, literal, load, new_folder, remove, scanned, written

MAGIC = b"HUFIDS01"
#: Longest code in bits, more only where more ids occur than that has codes for; the decoding table has an entry for each such code.
MAX_BITS = 20
#: Ids in a block and between two checkpoints.
BLOCK_IDS = 1 << 20
STEP_IDS = 256
#: Documents of a file, about, where they have to be put in order first.
FILE_DOCS = 14_000

#: Stands for a null id in a file; below all real ids.
NO_ID = -(1 << 63)
#: Files whose counts one task adds up.
COUNTED = 256
#: Files that one task numbers.
NUMBERED = 4_096
#: Pieces of text whose ids a worker remembers.
CACHED = 700_000
#: How byte-level BPE writes the byte of a space.
SPACE = "\u0120"

def cache_of(tokenizer: str) -> PieceCache:
    """The worker's cache for the tokenizers file at that path; kept for later tasks."""

    def make() -> PieceCache:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        library = Tokenizer.from_file(tokenizer)

        def ids_of(texts: list[str]) -> list:
            return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]

        starts = np.zeros(max(library.get_vocab().values()) + 1, bool)
        starts[[i for t, i in library.get_vocab().items() if t[0] == SPACE]] = True
        special = [t.content for t in library.get_added_tokens_decoder().values()]

        # words of ASCII letters are one piece to the library's own splitting too, and each of their
        # bytes is written as itself; so its model gets them as they are
        words = Tokenizer.from_file(tokenizer)
        words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()

        def kind(key) -> int:
            if key.__class__ is tuple:
                return -1
            if key.isalpha() and key.isascii():
                return 1
            return -1 if "<" in key and any(t in key for t in special) else 0

        def plain(texts: list[str]) -> list:
            return ids_of([" " + t for t in texts])

        def letters(texts: list[str]) -> list:
            marked = [SPACE + t.replace(" ", " " + SPACE) for t in texts]
            return [e.ids for e in words.encode_batch_fast(marked, add_special_tokens=False)]

        def encode(keys: list) -> tuple[np.ndarray, np.ndarray]:
            return joined_encode(keys, kind, [plain, letters], lambda own: ids_of([k[0] if isinstance(k, tuple) else " " + k for k in own]), starts)

        apart = splits_at_spaces(tokenizer)
        return PieceCache(spaced_keys if apart else whole_key, encode, limit=CACHED, cut=apart)

    return kept("pieces", tokenizer, make)


def splits_at_spaces(tokenizer: str) -> bool:
    """Whether the file's own splitting never joins a non-space with a following space, as that of byte-level BPE."""
    with open(tokenizer) as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer") and spec.get("post_processor") is None


def whole_key(text: str, first: bool) -> list:
    return [(text if first else " " + text,)]


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most max_bits by package-merge; 0 for ids that don't occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    max_bits = max(max_bits, (len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels = []
    row, single = weights, np.ones(len(weights), bool)
    for _ in range(max_bits - 1):
        levels.append(single)
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        by = np.argsort(both, kind="stable")
        row, single = both[by], by < len(weights)
    levels.append(single)
    take = 2 * len(weights) - 2
    for single in reversed(levels):
        ones = int(single[:take].sum())
        lengths[order[:ones]] += 1
        take = 2 * (take - ones)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), each left-aligned value read from its low length bits."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    sizes = lengths[order].astype(np.int64)
    if len(order):
        top = int(sizes.max())
        aligned = np.concatenate([[0], np.cumsum(np.int64(1) << (top - sizes))[:-1]])
        codes[order] = (aligned >> (top - sizes)).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each window of the longest code's bits, id << 5 | length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    top = int(lengths.max()) if len(order) else 1
    sizes = lengths[order].astype(np.int64)
    table = np.repeat((order.astype(np.int64) << 5) | sizes, np.int64(1) << (top - sizes))
    return np.concatenate([table, np.zeros((1 << top) - len(table), np.int64)]), top


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' bits, most significant first, and the bit offset of every STEP_IDS-th id."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    word, shift = starts >> 6, 64 - (starts & 63) - sizes
    code = codes[ids]
    high = code << np.maximum(shift, 0).view(np.uint64)
    over = np.flatnonzero(shift < 0)  # at most one code runs over the end of each word
    high[over] = code[over] >> (-shift[over]).view(np.uint64)
    if len(ids):
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        words[word[firsts]] |= np.add.reduceat(high, firsts)
        words[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: (total + 7) // 8], starts[::STEP_IDS]


def unpack(data: bytes, n: int, checkpoints: np.ndarray, table: np.ndarray, top: int) -> np.ndarray:
    """n ids of a block; all its checkpoints are read side by side."""
    out = np.zeros((STEP_IDS, len(checkpoints)), np.uint32)
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint64)
    # the 40 bits that start at each byte
    wide = raw[:-4] << np.uint64(32) | raw[1:-3] << np.uint64(24) | raw[2:-2] << np.uint64(16) | raw[3:-1] << np.uint64(8) | raw[4:]
    at = checkpoints.astype(np.int64)
    last = n - STEP_IDS * (len(checkpoints) - 1)
    mask = (1 << top) - 1
    for k in range(min(n, STEP_IDS)):
        live = at if k < last else at[:-1]
        entry = table[(wide[live >> 3].astype(np.int64) >> (40 - top - (live & 7))) & mask]
        out[k, : len(live)] = entry >> 5
        live += entry & 31
    return out.T.reshape(-1)[: n]


class Writer:
    """Writes blocks; the file's end holds the directory: code lengths, blocks, documents."""

    def __init__(self, out, lengths: np.ndarray, start: int = 0) -> None:
        """start: the ids of all documents before the file's first."""
        self.out, self.lengths, self.codes, self.start = out, lengths, canonical_codes(lengths), start
        self.at, self.blocks, self.marks, self.parts, self.held = len(MAGIC), [], [], [], 0
        self.ids: list[int] = []
        self.sizes: list[int] = []
        out.write(MAGIC)

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.held += len(ids)
        while self.held >= BLOCK_IDS:
            everything = np.concatenate(self.parts)
            self._block(everything[:BLOCK_IDS])
            self.parts, self.held = [everything[BLOCK_IDS:]], len(everything) - BLOCK_IDS

    def _block(self, ids: np.ndarray) -> None:
        data, marks = pack(ids, self.codes, self.lengths)
        self.out.write(data)
        self.blocks.append((self.at, len(data), len(ids)))
        self.marks.append(marks.astype("<u4"))
        self.at += len(data)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.parts))
        body = [self.lengths.astype("<u1"), np.array(self.blocks, "<i8").reshape(-1), np.concatenate([*self.marks, np.zeros(0, "<u4")]), np.array(self.ids, "<i8"), np.array(self.sizes, "<i8")]
        packed = zlib.compress(struct.pack("<6q", self.start, *map(len, body)) + b"".join(x.tobytes() for x in body), 1)
        self.out.write(packed + struct.pack("<q", len(packed)) + MAGIC)


class Reader:
    """Reads such a file: its documents' ids in order, or any block alone."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        tail = file.read_at(8 + len(MAGIC), size - 8 - len(MAGIC))
        if tail[8:] != MAGIC:
            raise ValueError("not a file of Huffman-coded ids, or not whole")
        n = struct.unpack("<q", tail[:8])[0]
        body = zlib.decompress(file.read_at(n, size - 8 - len(MAGIC) - n))
        self.start, *counts = struct.unpack("<6q", body[:48])
        at, parts = 48, []
        for count, kind in zip(counts, ("<u1", "<i8", "<u4", "<i8", "<i8"), strict=True):
            parts.append(np.frombuffer(body, kind, count, at))
            at += parts[-1].nbytes
        self.lengths, blocks, self.marks, self.ids, self.sizes = parts
        self.blocks = blocks.reshape(-1, 3)
        self.table, self.top = decoding_table(self.lengths)
        self.first_mark = np.concatenate([[0], np.cumsum(-(-self.blocks[:, 2] // STEP_IDS))]).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        at, size, n = map(int, self.blocks[k])
        return unpack(self.file.read_at(size, at), n, self.marks[self.first_mark[k] : self.first_mark[k + 1]], self.table, self.top)

    def documents(self) -> Iterator[tuple[int, int, int]]:
        """(id, number of ids, crc32 of the ids) of each document; one block is held at a time."""
        block, at, k = np.zeros(0, np.uint32), 0, 0
        for doc, size in zip(self.ids.tolist(), self.sizes.tolist(), strict=True):
            left, crc = size, 0
            while left:
                if at == len(block):
                    block, at, k = self.block(k), 0, k + 1
                part = block[at : at + left]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                at += len(part)
                left -= len(part)
            yield doc, size, crc


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    return (x or "" for x in batch.column(column).to_pylist())


def blocks_in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """(id, text, file, block) with the place of each row's part of its file, if the ids ascend within all parts and parts don't overlap.

    Then nothing has to be sorted. Only the ids are read to tell. None if they don't, or if docs isn't a
    plain scan.
    """
    placed = scanned(docs, ["file_path", "file_block_start"])
    if placed is None:
        return None
    placed = placed.select(F.col("row")[id_col].cast("long").alias("id"), F.col("row")[text_col].alias("text"), F.col("file_path").alias("file"), F.col("file_block_start").alias("block"))

    def bounds(batches):
        now, low, last, ascending, out = None, 0, 0, True, []
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            for key, a, b in _parts_of(batch):
                part = ids[a:b]
                if key != now:
                    if now is not None:
                        out.append((*now, low, last, ascending))
                    now, low, last, ascending = key, int(part[0]), int(part[0]), True
                ascending &= bool(part[0] >= last and (part[1:] >= part[:-1]).all())
                last = max(last, int(part.max()))
                low = min(low, int(part.min()))
        if now is not None:
            out.append((*now, low, last, ascending))
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], ["file", "block", "low", "high", "ascending"])

    parts = written(placed.select("id", "file", "block").mapInArrow(bounds, "file string, block long, low long, high long, ascending boolean"), "bounds")
    dealt = ranged(parts, ["low", "high"])
    ends = sorted(tuple(r) for r in dealt.groupBy("bucket").agg(F.min("low"), F.max("high")).collect())
    good = all(x[2] <= y[1] for x, y in zip(ends, ends[1:], strict=False))
    before = F.lag("high").over(Window.partitionBy("bucket").orderBy("low", "high"))
    good = good and not dealt.select("ascending", (before > F.col("low")).alias("overlaps")).where("NOT ascending OR overlaps").take(1)
    good = good and not parts.groupBy("file", "block").count().where("count > 1").take(1)
    forget(parts, dealt)
    return placed if good else None


def ranged(table: DataFrame, order: list[str]) -> DataFrame:
    """table with bucket: ranges of the order, of about NUMBERED rows; written down, for a repeated task might draw other ranges."""
    n = table.count() // NUMBERED + 1
    return written(table.repartitionByRange(n, *order).withColumn("bucket", F.spark_partition_id()), "ranged")


def in_order(table: DataFrame, order: list[str], total: str) -> DataFrame:
    """table with file_no, its row's number in the order, and start, the sum of total over all rows before. Rows are counted by buckets, of which the driver has one sum each."""
    dealt = ranged(table, order)
    sums = sorted((r["bucket"], r["n"], r["t"]) for r in dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("t")).collect())
    before, rows_, ids = [], 0, 0
    for bucket, n, t in sums:
        before.append((bucket, rows_, ids))
        rows_, ids = rows_ + n, ids + t
    first = literal(table.sparkSession, before, "bucket int, rows_before bigint, ids_before bigint")
    within = Window.partitionBy("bucket").orderBy(*order)
    number = F.row_number().over(within) - 1 + F.col("rows_before")
    start = F.coalesce(F.sum(total).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("ids_before")
    return dealt.join(F.broadcast(first), "bucket").withColumn("file_no", number.cast("long")).withColumn("start", start.cast("long")).drop("bucket", "rows_before", "ids_before")


def _parts_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """((file, block), start, end) of the runs of a batch's last two columns."""
    file, block = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1).to_numpy()
    names = file.dictionary_encode()
    code = names.indices.to_numpy()
    cuts = np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), (code[1:] != code[:-1]) | (block[1:] != block[:-1])]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(code)], strict=True):
        yield (names.dictionary[code[a]].as_py(), int(block[a])), a, b


def write_raw(docs: DataFrame, tokenizer: str, folder: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Encodes the documents in order of id; each task writes its ids as they are, compressed, a file for each part.

    Parts of input files that are in order stay as they are; else the documents are dealt out and
    sorted by id. Returns (file_no, start, raw, n_docs, n_ids, docs, sizes, used, n): the last four are
    arrays in bytes, of the documents' ids and sizes and of the ids that occur with their counts.
    """

    def write(batches):
        import zstandard

        cache, end = cache_of(tokenizer), np.array([end_id], np.uint32)
        now = out = None
        name, docs, sizes, total, held = "", [], [], np.zeros(1, np.int64), []

        def flush():
            nonlocal total, held
            ids = np.concatenate(held)
            here = np.bincount(ids, minlength=len(total))
            here[: len(total)] += total
            total, held = here, []
            wide = int(ids.max()) >> 16 > 0
            data = zstandard.ZstdCompressor(level=1).compress(ids.astype("<u4" if wide else "<u2").tobytes())
            out.write(struct.pack("<qq", len(data), 4 if wide else 2) + data)

        def close():
            if held:
                flush()
            out.close()
            used = np.flatnonzero(total)
            arrays = [np.array(docs, "<i8"), np.array(sizes, "<i8"), used.astype("<i8"), total[used].astype("<i8")]
            row = [[docs[0]], [docs[-1]], [f"{folder}/{name}"], [len(docs)], [sum(sizes)], *([x.tobytes()] for x in arrays)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], RAW.names)

        for batch in batches:
            for key, a, b in _parts_of(batch):
                if key != now:
                    if out is not None:
                        yield close()
                    fs, path = filesystem(folder)
                    fs.create_dir(path, recursive=True)
                    now, name, docs, sizes, total, held = key, f"raw-{uuid.uuid4().hex}", [], [], np.zeros(1, np.int64), []
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                part = batch.slice(a, b - a)
                docs += (NO_ID if d is None else d for d in part.column("id").to_pylist())
                for ids in cache.texts(_texts(part, "text")):
                    held += [ids, end]
                    sizes.append(len(ids) + 1)
                    if len(held) >= 1024:
                        flush()
        if out is not None:
            yield close()

    schema = "low long, high long, raw string, n_docs long, n_ids long, docs binary, sizes binary, used binary, n binary"
    dealt = blocks_in_order(docs, id_col, text_col)
    if dealt is None:
        plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        parts = plain.count() // FILE_DOCS + 1
        dealt = plain.repartitionByRange(parts, "id").sortWithinPartitions("id").select("id", "text", F.lit("").alias("file"), F.spark_partition_id().cast("long").alias("block"))
    bounded_batches(docs.sparkSession)
    raw = written(dealt.mapInArrow(write, schema), "raw-ids")
    return raw.join(in_order(raw.select("raw", "low", "high", "n_ids"), ["low", "high", "raw"], "n_ids").select("raw", "file_no", "start"), "raw")


RAW = pa.schema([("low", pa.int64()), ("high", pa.int64()), ("raw", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("docs", pa.binary()), ("sizes", pa.binary()), ("used", pa.binary()), ("n", pa.binary())])


def id_counts(raw: DataFrame) -> DataFrame:
    """(id, n) over all documents; the counts of COUNTED files at a time are added up before any are sent."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for used, n in zip(batch.column("used").to_pylist(), batch.column("n").to_pylist(), strict=True):
                ids = np.frombuffer(used, "<i8")
                if ids[-1] >= len(total):
                    total = np.concatenate([total, np.zeros(ids[-1] + 1 - len(total), np.int64)])
                total[ids] += np.frombuffer(n, "<i8")
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    tasks = raw.select("used", "n").coalesce(raw.count() // COUNTED + 1)
    return tasks.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """Encodes every document, writes the ids' files into folder in ascending order of id, returns (file_no, file, n_docs, n_ids).

    First the ids are put down raw with their counts; the counts' table has one row an id of the
    vocabulary, whose file each worker holds, and gives the code lengths; then each raw file becomes a
    coded one, which says how many ids come before it. A repeated task writes a file of another name, and
    only the files returned count. Null ids come first, null text counts as empty, rows with equal ids
    stay next to each other; no documents give no files. Other columns, of any name, are ignored.
    """
    spark = docs.sparkSession
    raw = write_raw(docs, tokenizer, f"{folder}/raw", end_id, id_col, text_col)
    counts = id_counts(raw).collect()
    table = np.zeros(max((r["id"] for r in counts), default=0) + 1, np.int64)
    for r in counts:
        table[r["id"]] = r["n"]
    lengths = code_lengths(table, max_bits).tobytes()

    def write(batches):
        import zstandard

        sizes = np.frombuffer(lengths, np.uint8)
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = filesystem(row["raw"])
                out_fs, out_path = filesystem(folder)
                out_fs.create_dir(out_path, recursive=True)
                name = f"ids-{row['file_no']:06d}-{uuid.uuid4().hex}.huf"
                with fs.open_input_stream(path) as f, out_fs.open_output_stream(f"{out_path}/{name}") as out:
                    writer = Writer(out, sizes, row["start"])
                    writer.ids, writer.sizes = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["sizes"], "<i8")
                    while head := f.read(16):
                        n, width = struct.unpack("<qq", head)
                        writer.add(np.frombuffer(zstandard.ZstdDecompressor().decompress(f.read(n)), f"<u{width}"))
                    writer.close()
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (row["file_no"], f"{folder}/{name}", row["n_docs"], row["n_ids"])], ["file_no", "file", "n_docs", "n_ids"])

    dealt = raw.select("file_no", "start", "raw", "n_docs", "n_ids", "docs", "sizes").repartition(max(1, raw.count()), "file_no")
    files = written(dealt.mapInArrow(write, "file_no long, file string, n_docs long, n_ids long"), "id-files")
    remove(spark, f"{folder}/raw")
    return files


def read_ids(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """From the files alone: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    def read(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                fs, path = filesystem(file)
                with fs.open_input_file(path) as f:
                    reader = Reader(f)
                    rows = list(reader.documents())
                sizes = np.array([r[1] for r in rows], np.int64)
                ids = pa.array([None if r[0] == NO_ID else r[0] for r in rows], pa.int64())
                begin = reader.start + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays([ids, pa.array(begin), pa.array(sizes), pa.array([r[2] for r in rows], pa.int64())], [id_col, "start", "n_tokens", "ids_crc32"])

    return files.select("file_no", "file").repartition(max(1, files.count()), "file_no").mapInArrow(read, f"{id_col} long, start long, n_tokens long, ids_crc32 long")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "huffman-ids")
    files = write_ids(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_ids(files)
