"""GIF as media: bytes as palette samples of timed frames, LZW streams, composed frames, colour histograms."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bounded_batches, kept, load, written

#: Payload bytes come in multiples of a tile of 24 x 24 samples; a frame holds up to FRAME_TILES tiles.
SIDE = 24
TILE = SIDE * SIDE
FRAME_TILES = 32
#: Hundredths of a second that each frame is shown.
DELAY = 4
#: Cells of the colour histogram: two bits a channel.
CELLS = 64
# Fixed values of the format.
BITS = 8
CLEAR, END, FIRST, FULL = 256, 257, 258, 4096


def widths(n: int) -> np.ndarray:
    """Bits of each of n codes after a clear code: the table gets an entry with each code but the first."""
    entries = np.minimum(FIRST + np.maximum(np.arange(n) - 1, 0), FULL)
    return np.minimum(np.maximum(BITS + 1, np.ceil(np.log2(entries + 1)).astype(np.int64)), 12)


_WIDTHS = widths(1 << 16)


def _width(n: int) -> np.ndarray:
    global _WIDTHS
    if n > len(_WIDTHS):
        _WIDTHS = widths(2 * n)
    return _WIDTHS[:n]


def lzw_codes(data: bytes) -> list[int]:
    """Greedy codes of data, without clear and end; a full table stays as it is."""
    table: dict[int, int] = {}
    out, following = [], FIRST
    it = iter(data)
    w = next(it)
    get, put = table.get, out.append
    for c in it:
        key = w << 8 | c
        k = get(key)
        if k is None:
            put(w)
            if following < FULL:
                table[key] = following
                following += 1
            w = c
        else:
            w = k
    put(w)
    return out


def pack_codes(codes: np.ndarray, sizes: np.ndarray) -> bytes:
    """Codes of the given numbers of bits, least significant bit first."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.zeros(int(ends[-1]) // 8 + 4, np.uint32)
    value = codes.astype(np.uint32) << (starts & 7).astype(np.uint32)
    first = starts >> 3
    for k in range(3):
        # several codes can share a byte; their bits never do, so sums are unions
        out += np.bincount(first + k, weights=(value >> np.uint32(8 * k)) & 255, minlength=len(out)).astype(np.uint32)[: len(out)]
    return out[: (int(ends[-1]) + 7) // 8].astype(np.uint8).tobytes()


def lzw_encode(data: bytes) -> bytes:
    codes = np.array([CLEAR, *lzw_codes(data), END], np.int64)
    sizes = np.concatenate([[BITS + 1], _width(len(codes) - 1)])
    return pack_codes(codes, sizes)


def lzw_decode(stream: bytes, n: int) -> bytes:
    """n samples of a stream of 8-bit samples.

    Where each code is follows from its rank after the last clear code, so a run of codes is read at
    once. A code of the table stands for samples that were put out before, where its entry was made;
    so each sample points back at an earlier one, and following the pointers ends at literals.
    """
    bits = np.frombuffer(stream + bytes(8), np.uint8).astype(np.int64)
    wide = bits[:-2] | bits[1:-1] << 8 | bits[2:] << 16
    at, limit, out = 0, 8 * len(stream), bytearray()
    while len(out) < n:
        rank = int(np.searchsorted(np.cumsum(_width(n - len(out) + 2)), limit - at, side="right"))
        sizes = _width(rank)
        starts = at + np.cumsum(sizes) - sizes
        codes = (wide[starts >> 3] >> (starts & 7)) & ((1 << sizes) - 1)
        stops = np.flatnonzero((codes == CLEAR) | (codes == END))
        count = int(stops[0]) if len(stops) else rank
        if count:
            out += _samples(codes[:count])
        if not len(stops) or codes[count] == END:
            break
        at = int(starts[count] + sizes[count])
    if len(out) < n:
        raise ValueError("the stream ends before its frame is full")
    return bytes(out[:n])


def _samples(codes: np.ndarray) -> bytes:
    n = len(codes)
    literal = codes < CLEAR
    made = np.where(literal, 0, codes - FIRST)  # the code after which the entry was made
    if (made[~literal] >= np.arange(n)[~literal]).any() or (codes >= FULL).any():
        raise ValueError("a code isn't in the table yet")
    jump = np.where(literal, np.arange(n), made)
    hops = np.where(literal, 0, 1)
    while (hops[jump] > 0).any():
        hops = hops + hops[jump]
        jump = jump[jump]
    size = hops + 1
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1])
    owner = np.repeat(np.arange(n), size)
    shift = np.where(literal, 0, starts - starts[made])
    source = np.arange(total) - shift[owner]
    while True:
        further = source[source]
        if np.array_equal(further, source):
            break
        source = further
    values = np.zeros(total, np.uint8)
    values[starts] = np.where(literal, codes, 0).astype(np.uint8)
    return values[source].tobytes()


#: Bytes 255 occur in no UTF-8 text, so that they are the padding alone; they are shown transparent.
PAD = 255


def palettes() -> tuple[bytes, bytes]:
    """The shared palette, of greys, and that of every second frame, whose channels rise at rates of their own."""
    return bytes(x for v in range(256) for x in (v, v, v)), bytes(x for v in range(256) for x in (v, 3 * v & 255, 7 * v & 255))


GREY, TINTED = palettes()


def encode_gif(payload: bytes, delay: int = DELAY) -> bytes:
    """A GIF whose frames' samples are the payload, a positive multiple of TILE bytes.

    Frames take turns: every second one has a palette of its own, and what becomes of a frame when the
    next one comes is, in turn, that it stays, that its place is cleared, and that what was there before
    comes back. In frames with padding, the padding is transparent and lets through what is below.
    """
    tiles = len(payload) // TILE
    high = SIDE * min(tiles, FRAME_TILES)
    parts = [b"GIF89a", struct.pack("<HHBBB", SIDE, high, 0xF7, 0, 0), GREY]
    for turn, k in enumerate(range(0, len(payload), TILE * FRAME_TILES)):
        data = payload[k : k + TILE * FRAME_TILES]
        stream = lzw_encode(data)
        clear = data[-1] == PAD
        parts.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, (1 + turn % 3) << 2 | clear, delay, PAD if clear else 0, 0))
        own = turn % 2 == 1
        parts.append(struct.pack("<BHHHHB", 0x2C, 0, 0, SIDE, len(data) // SIDE, 0x87 if own else 0))
        parts += [TINTED] * own + [bytes([BITS])]
        parts += [bytes([len(x)]) + x for x in (stream[i : i + 255] for i in range(0, len(stream), 255))]
        parts.append(b"\0")
    return b"".join([*parts, b";"])


@dataclass
class Frame:
    """A frame as stored: its place, samples, palette (n x 3), shown time, what becomes of it, transparent sample."""

    left: int
    top: int
    width: int
    height: int
    samples: np.ndarray
    palette: np.ndarray
    delay: int
    disposal: int
    transparent: int | None


def read_gif(data: bytes) -> tuple[int, int, list[Frame]]:
    """(width, height, frames). Interlaced frames are put in order; streams of fewer than 8 bits a sample are decoded one code at a time."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack("<HHB", data[6:11])
    at, shared = 13, None

    def palette(flags: int) -> np.ndarray:
        nonlocal at
        n = 3 << ((flags & 7) + 1)
        table = np.frombuffer(data, np.uint8, n, at).reshape(-1, 3)
        at += n
        return table

    def blocks() -> bytes:
        nonlocal at
        parts = []
        while n := data[at]:
            parts.append(data[at + 1 : at + 1 + n])
            at += n + 1
        at += 1
        return b"".join(parts)

    if flags & 128:
        shared = palette(flags)
    frames, control = [], (0, 0, None)
    while data[at] != 0x3B:
        kind = data[at]
        if kind == 0x21:
            label = data[at + 1]
            at += 2
            body = blocks()
            if label == 0xF9:
                packed, delay, index = struct.unpack("<BHB", body[:4])
                control = (delay, packed >> 2 & 7, index if packed & 1 else None)
        elif kind == 0x2C:
            left, top, w, h, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
            at += 10
            own = palette(flags) if flags & 128 else shared
            if own is None:
                raise ValueError("a frame has no palette")
            bits = data[at]
            at += 1
            stream = blocks()
            raw = lzw_decode(stream, w * h) if bits == BITS else lzw_plain(stream, w * h, bits)
            samples = np.frombuffer(raw, np.uint8).reshape(h, w)
            if flags & 64:
                rows = [*range(0, h, 8), *range(4, h, 8), *range(2, h, 4), *range(1, h, 2)]
                ordered = np.empty_like(samples)
                ordered[rows] = samples
                samples = ordered
            frames.append(Frame(left, top, w, h, samples, own, control[0], control[1], control[2]))
            control = (0, 0, None)
        else:
            raise ValueError(f"unknown block {kind:#x}")
    return width, height, frames


def lzw_plain(stream: bytes, n: int, bits: int) -> bytes:
    """As lzw_decode, for any number of bits a sample."""
    clear, value, held, at = 1 << bits, 0, 0, 0
    table: list[bytes] = []
    out, size, last = bytearray(), bits + 1, b""
    while len(out) < n:
        while held < size:
            if at == len(stream):
                raise ValueError("the stream ends before its frame is full")
            value |= stream[at] << held
            held += 8
            at += 1
        code = value & ((1 << size) - 1)
        value >>= size
        held -= size
        if code == clear:
            table, size, last = [bytes([k]) for k in range(clear)] + [b"", b""], bits + 1, b""
            continue
        if code == clear + 1:
            break
        if not table:
            table = [bytes([k]) for k in range(clear)] + [b"", b""]
        if code < len(table):
            entry = table[code]
        elif last and code == len(table):
            entry = last + last[:1]
        else:
            raise ValueError("a code isn't in the table yet")
        out += entry
        if last and len(table) < FULL:
            table.append(last + entry[:1])
        if len(table) == 1 << size and size < 12:
            size += 1
        last = entry
    if len(out) < n:
        raise ValueError("the stream ends before its frame is full")
    return bytes(out[:n])


def composed(width: int, height: int, frames: list[Frame]) -> Iterator[tuple[np.ndarray, int]]:
    """Each picture as shown, RGBA, with its delay: transparent samples let the last one through, then
    disposal 2 clears the frame's place and 3 puts back what was there."""
    canvas = np.zeros((height, width, 4), np.uint8)
    for f in frames:
        rows, cols = slice(f.top, min(f.top + f.height, height)), slice(f.left, min(f.left + f.width, width))
        before = canvas.copy() if f.disposal == 3 else None
        samples = f.samples[: rows.stop - rows.start, : cols.stop - cols.start]
        table = np.zeros((256, 4), np.uint8)
        table[: len(f.palette), :3] = f.palette
        table[:, 3] = 255
        new = table[samples]
        if f.transparent is None:
            canvas[rows, cols] = new
        else:
            seen = samples != f.transparent
            canvas[rows, cols][seen] = new[seen]
        yield canvas.copy(), f.delay
        if f.disposal == 2:
            canvas[rows, cols] = 0
        elif f.disposal == 3:
            canvas = before


def histogram(picture: np.ndarray) -> np.ndarray:
    """Pixels of each colour cell, two bits a channel; transparent ones aren't counted."""
    rgb = picture[picture[..., 3] > 0][:, :3].astype(np.int64) >> 6
    return np.bincount(rgb[:, 0] * 16 + rgb[:, 1] * 4 + rgb[:, 2], minlength=CELLS)


def payload_of(text: bytes) -> bytes:
    """The text's bytes and bytes 255 up to a positive multiple of TILE."""
    return text + b"\xff" * (max(1, -(-len(text) // TILE)) * TILE - len(text))


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes and media, the GIF that stores its text; null text counts as empty.

    Rows are handled alone, so ids may be null or repeat, and equal texts have equal media; other columns,
    of any name, are ignored, and an empty table gives no rows. A text is held whole, with its media, by
    the task that handles it, the codes of one frame at a time.
    """
    schema = docs.select(id_col).schema.add("n_bytes", "long").add("media", "binary")

    def encode(batches):
        kept("gif", None)
        for batch in batches:
            for part in small(batch, "__bytes"):
                texts = [x or b"" for x in part.column("__bytes").to_pylist()]
                media = [encode_gif(payload_of(x)) for x in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array(media, pa.binary())], schema.names)

    bounded_batches(docs.sparkSession)
    return docs.select(id_col, F.col(text_col).cast("binary").alias("__bytes")).mapInArrow(encode, schema)


def small(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about limit bytes in a binary column, one row at least."""
    at, size = 0, 0
    for k, x in enumerate(batch.column(column)):
        size += len(x.as_buffer() or b"") if x.is_valid else 0
        if size > limit:
            yield batch.slice(at, k + 1 - at)
            at, size = k + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


FRAME_TYPE = "array<struct<start:long,delay:int,histogram:array<int>>>"


def frames_of(media: DataFrame, id_col: str = "doc_id", frames: bool = False) -> DataFrame:
    """Decodes stored media: id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256,
    feature (hash of the histograms of all frames as shown, with their times), n_frames, and the timed frames if asked
    for: each one's start and delay in hundredths of a second, and its pixels by colour.
    """
    schema = media.select(id_col, "n_bytes").schema
    for name, kind in (("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long"), ("media_bytes", "long"), ("media_sha256", "string"), ("feature", "string"), ("n_frames", "long")):
        schema = schema.add(name, kind)
    if frames:
        from pyspark.sql.types import _parse_datatype_string

        schema = schema.add("frames", _parse_datatype_string(FRAME_TYPE))

    def decode(batches):
        for batch in batches:
            for part in small(batch, "media"):
                out = [described(x.as_py(), frames) for x in part.column("media")]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                if frames:
                    kinds.append(pa.list_(pa.struct([("start", pa.int64()), ("delay", pa.int32()), ("histogram", pa.list_(pa.int32()))])))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], schema.names)

    return media.select(id_col, "n_bytes", "media").mapInArrow(decode, schema)


def described(data: bytes, timed: bool) -> list:
    width, height, stored = read_gif(data)
    payload = b"".join(f.samples.tobytes() for f in stored)
    counts = [(histogram(p), delay) for p, delay in composed(width, height, stored)]
    whole = sum(h for h, _ in counts)
    feature = f"{len(stored)}x{width}x{height}:" + hashlib.md5(b"".join(struct.pack("<i", d) + h.astype("<i8").tobytes() for h, d in counts)).hexdigest() + ":" + ",".join(map(str, whole[[0, 21, 42, 63]].tolist()))
    row = [len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature, len(stored)]
    if timed:
        start, list_ = 0, []
        for h, d in counts:
            list_.append({"start": start, "delay": d, "histogram": h.tolist()})
            start += d
        row.append(list_)
    return row


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = written(media_columns(load(spark, sf_dir, "documents")), "gif")
    return written(frames_of(media, frames=True), "frames").drop("frames")
