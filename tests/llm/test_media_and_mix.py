import hashlib
import os
import random
import struct
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkcurate.llm import gif_media, mixing, shared, warc
from sparkcurate.llm.shared import filesystem, new_folder


@given(st.binary(min_size=1, max_size=3_000) | st.text("ab", min_size=1, max_size=4_000).map(str.encode))
@settings(max_examples=80, deadline=None)
def test_lzw(data):
    stream = gif_media.lzw_encode(data)
    assert gif_media.lzw_decode(stream, len(data)) == data == gif_media.lzw_plain(stream, len(data), 8)


@pytest.mark.parametrize("data", [b"a" * 60_000, os.urandom(20_000), bytes(range(256)) * 80])
def test_lzw_full_table(data):
    stream = gif_media.lzw_encode(data)
    assert gif_media.lzw_decode(stream, len(data)) == data == gif_media.lzw_plain(stream, len(data), 8)


def test_lzw_clears_midway():
    codes = np.array([256, 1, 2, 258, 256, 3, 4, 258, 257])
    assert gif_media.lzw_decode(gif_media.pack_codes(codes, np.full(9, 9)), 8) == bytes([1, 2, 1, 2, 3, 4, 3, 4])
    with pytest.raises(ValueError):
        gif_media.lzw_decode(gif_media.pack_codes(np.array([256, 1, 300, 257]), np.full(4, 9)), 3)


def frame(samples, disposal, transparent=None, left=0, top=0):
    s = np.array(samples, np.uint8)
    return gif_media.Frame(left, top, s.shape[1], s.shape[0], s, np.array([[0, 0, 0], [255, 0, 0], [0, 255, 0]], np.uint8), 5, disposal, transparent)


def test_composition():
    frames = [frame([[1, 1], [1, 1]], 1), frame([[2, 0]], 2, transparent=0, top=1), frame([[2]], 3, left=1), frame([[1]], 0)]
    shown = [p for p, _ in gif_media.composed(2, 2, frames)]
    red, green, none = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 0, 0)
    grid = lambda p: [tuple(map(int, x)) for x in p.reshape(-1, 4)]
    assert grid(shown[0]) == [red] * 4
    assert grid(shown[1]) == [red, red, green, red]
    assert grid(shown[2]) == [red, green, none, none]
    assert grid(shown[3]) == [red, red, none, none]
    assert gif_media.histogram(shown[2])[48] == 1 and gif_media.histogram(shown[2])[12] == 1


ODD = [(1, None), (2, ""), (3, "é" * 1_000), (4, "x" * 576), (5, "y" * 100_000), (5, "again"), (None, "no id")]


def test_media(spark):
    docs = spark.createDataFrame([(i, t, b"z") for i, t in ODD], "doc_id long, text string, media binary")
    got = gif_media.frames_of(gif_media.media_columns(docs), frames=True).collect()
    assert len(got) == len(ODD)
    for r, (i, t) in zip(got, ODD, strict=True):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.n_frames == len(r.frames) == -(-len(payload) // (576 * gif_media.FRAME_TILES)) and r.frames[-1].start == 4 * (r.n_frames - 1)
        assert sum(r.frames[0].histogram) == min(len(raw), 576 * gif_media.FRAME_TILES)
    assert got[0][1:] == got[1][1:]
    assert gif_media.frames_of(gif_media.media_columns(docs.limit(0))).collect() == []


def plain_feature(data):
    """A frame's pictures and their colours, sample by sample."""
    width, height = struct.unpack("<HH", data[6:10])
    shared, at = data[13 : 13 + 768], 13 + 768
    canvas = [None] * (width * height)
    told, whole, n, control = b"", [0] * 64, 0, None
    while data[at] != 0x3B:
        if data[at] == 0x21:
            control = data[at + 3 : at + 7]
            at += 8
            continue
        left, top, w, h, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
        at += 10
        palette = shared
        if flags & 128:
            palette, at = data[at : at + 768], at + 768
        bits, at, stream = data[at], at + 1, b""
        while data[at]:
            stream += data[at + 1 : at + 1 + data[at]]
            at += data[at] + 1
        at += 1
        samples = gif_media.lzw_plain(stream, w * h, bits)
        before = list(canvas)
        for k, v in enumerate(samples):
            if not (control[0] & 1 and v == control[3]):
                canvas[(top + k // w) * width + left + k % w] = tuple(palette[3 * v : 3 * v + 3])
        counts = [0] * 64
        for c in canvas:
            if c is not None:
                counts[(c[0] >> 6) * 16 + (c[1] >> 6) * 4 + (c[2] >> 6)] += 1
        told += struct.pack("<i", struct.unpack("<H", control[1:3])[0]) + struct.pack("<64q", *counts)
        whole = [x + y for x, y in zip(whole, counts, strict=True)]
        disposal = control[0] >> 2 & 7
        if disposal == 2:
            for k in range(w * h):
                canvas[(top + k // w) * width + left + k % w] = None
        elif disposal == 3:
            canvas = before
        n += 1
    return f"{n}x{width}x{height}:{hashlib.md5(told).hexdigest()}:" + ",".join(str(whole[k]) for k in (0, 21, 42, 63))


def test_features_are_those_of_the_stored_bytes(spark):
    texts = ["", "é" * 500, "some words, " * 9_000, "x" * 18_432, "y" * 18_433]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    media = gif_media.media_columns(docs)
    stored = {r.doc_id: bytes(r.media) for r in media.collect()}
    kinds = set()
    for r in gif_media.frames_of(media).collect():
        data = stored[r.doc_id]
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(data), hashlib.sha256(data).hexdigest(), plain_feature(data))
        frames = gif_media.read_gif(data)[2]
        kinds |= {(f.disposal, f.transparent, f.palette[9].tolist() == [9, 9, 9]) for f in frames}
    assert {d for d, _, _ in kinds} == {1, 2, 3} and {t for _, t, _ in kinds} == {None, 255} and {g for _, _, g in kinds} == {True, False}


def test_media_columns_follow_the_contract(spark):
    got = gif_media.op4(spark, "/root/testdata/sf0.001")
    assert got.columns[:8] == ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


PAGES = [(4, "http://a b/\n", "p" * 200), (2, None, "p" * 200), (9, "u", "p" * 200), (1, "u", "p" * 99), (3, "u", "p" * 99), (5, "u", None), (6, "u", ""), (None, "u", "p" * 200), (7, "u", "é<html>" * 50_000), (7, "v", "é<html>" * 50_000), (None, "u", "n" * 150), (None, "v", "n" * 150)]


@pytest.mark.parametrize("limit", [500_000, 0])
def test_warc(spark, monkeypatch, limit):
    monkeypatch.setattr(shared, "BROADCAST_GROUPS", limit)
    pages = spark.createDataFrame([(i, u, h, "x", 1, "m") for i, u, h in PAGES], "page_id long, url string, html string, digest string, file int, `_metadata` string").repartition(3)
    index = warc.write_archives(pages, new_folder(spark, "warc"))
    read = warc.read_records(index)
    assert read.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    got = read.collect()
    first = {"p" * 200: 2, "é<html>" * 50_000: 7, "n" * 150: None}
    left = dict.fromkeys(first, 1)
    expected = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        again = h in first and not (i == first[h] and left[h])
        if h in first and not again:
            left[h] -= 1
        expected.append((str(i), len(raw), hashlib.sha256(raw).hexdigest(), str(first[h] if again else None), "revisit" if again else "response"))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, str(r.refers_to), r.record_type) for r in got) == sorted(expected)
    own = warc.read_records(index, payloads=True).collect()
    assert all((r.payload is None) == (r.record_type == "revisit") for r in own)
    whole = warc.with_payloads(index, index).collect()
    assert sorted(bytes(r.payload) for r in whole) == sorted((h or "").encode() for _, _, h in PAGES)
    one = warc.with_payloads(index.where("page_id = 9"), index).collect()
    assert [(r.page_id, r.refers_to, bytes(r.payload)) for r in one] == [(9, 2, b"p" * 200)]
    assert warc.read_records(index.limit(0)).collect() == []
    assert warc.read_records(warc.write_archives(pages.limit(0), new_folder(spark, "warc"))).collect() == []


def test_archives_are_gzip_members(spark):
    import gzip

    index = warc.write_archives(spark.createDataFrame([(1, "u", "one"), (2, "v", "two")], "page_id long, url string, html string").coalesce(1), new_folder(spark, "warc"))
    fs, path = filesystem(index.first().file)
    with fs.open_input_file(path) as f:
        text = gzip.decompress(f.read())
    assert text.count(b"WARC/1.1\r\n") == 2 and b"WARC-Target-URI: v" in text


def test_ranges_are_joined(monkeypatch):
    monkeypatch.setattr(warc, "GAP", 10)
    monkeypatch.setattr(warc, "RANGE", 100)
    rows = [("a", 0, 20), ("a", 20, 20), ("a", 49, 5), ("a", 80, 30), ("b", 0, 1), ("b", 12, 1)]
    assert list(warc.ranges(iter(rows))) == [("a", [(0, 20), (20, 20), (49, 5)]), ("a", [(80, 30)]), ("b", [(0, 1)]), ("b", [(12, 1)])]


SOURCES = st.dictionaries(st.sampled_from("abcdefgh"), st.tuples(st.integers(0, 70), st.integers(1, 1000)), min_size=1)


def on_the_line(units, parts, slots):
    """Where each source is after so many slots, exactly: all run by their parts until they have no units left."""
    place, left, at = dict.fromkeys(units, Fraction(0)), {s: Fraction(n) for s, n in units.items() if n}, Fraction(0)
    while left and at < slots:
        total = sum(parts[s] for s in left)
        run = min(min(left[s] * total / parts[s] for s in left), slots - at)
        for s in list(left):
            step = run * parts[s] / total
            place[s], left[s] = place[s] + step, left[s] - step
            if not left[s]:
                del left[s]
        at += run
    return place


@given(SOURCES, st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_epochs_keep_to_the_line(sources, length):
    units, parts = {s: n for s, (n, _) in sources.items()}, {s: w for s, (_, w) in sources.items()}
    done, slot = dict.fromkeys(units, 0), 0
    for at, n, shares in mixing.epochs(units, parts, length):
        assert at == slot and sum(k for _, _, k in shares) == n <= length
        for s, first, k in shares:
            assert first == done[s] and k > 0
            done[s] += k
        slot += n
        line = on_the_line(units, parts, slot)
        assert all(abs(done[s] - line[s]) < 1 for s in units)
    assert done == units


def test_many_sources_are_planned_at_once():
    rng = random.Random(7)
    counts = {f"s{k}": 1 + int(rng.paretovariate(1)) % 20_000 for k in range(20_000)}
    parts = mixing.exact_parts(counts, None)
    began = time.process_time()
    found = list(mixing.epochs({s: -(-n // 8) for s, n in counts.items()}, parts))
    assert time.process_time() - began < 10
    assert sum(n for _, n, _ in found) == sum(-(-n // 8) for n in counts.values())


def test_schedules_are_pfair(spark):
    shares = [[("a", 5, 3), ("b", 0, 7), ("c", 2, 1)], [("a", 8, 1)], [("a", 0, 50), ("b", 0, 50), ("c", 9, 1), ("d", 0, 27)]]
    rows_, at = [], 0
    for x in shares:
        rows_.append((at, sum(k for _, _, k in x), [{"source": s, "first": f, "units": k} for s, f, k in x]))
        at += rows_[-1][1]
    table = mixing.literal(spark, rows_, f"at bigint, slots bigint, shares {mixing.SHARES}")
    got = mixing.scheduled(table).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(at))
    for (begin, n, _), x in zip(rows_, shares, strict=True):
        done = {s: 0 for s, _, _ in x}
        for t, r in enumerate(got[begin : begin + n], 1):
            first, units = next((f, k) for s, f, k in x if s == r.source)
            assert r.unit == first + done[r.source]
            done[r.source] += 1
            assert all(abs(done[s] * n - t * k) < n for s, _, k in x)
        assert done == {s: k for s, _, k in x}


def test_many_epochs_go_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PLANNED", 3)
    units, parts = {"a": 40, "b": 11}, {"a": 3, "b": 2}
    table = mixing.planned(spark, units, parts, 4)
    assert sorted(r.at for r in table.collect()) == [at for at, _, _ in mixing.epochs(units, parts, 4)]


def test_mix_keeps_to_the_weights_given(spark):
    weights = {"a": 0.6667, "b": 0.333, "c": 0.0003}
    table = spark.range(12_000).selectExpr("id doc_id", "CASE WHEN id < 7000 THEN 'a' WHEN id < 11900 THEN 'b' ELSE 'c' END source")
    got = [r.source for r in mixing.mix_sources(table, weights=weights, block_rows=8, length=64).orderBy("slot", "source_row").collect()]
    done, total = dict.fromkeys(weights, 0), sum(weights.values())
    for t, s in enumerate(got[:10_000], 1):  # no source has ended by then
        done[s] += 1
        assert all(abs(done[x] - t * weights[x] / total) < 8 for x in weights)
    assert len(got) == 12_000


def test_mix(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rows = [(k, "t", "big") for k in range(100)] + [(200 + k, "t", "small") for k in range(21)] + [(1, "t", None), (None, "t", "small"), (200, "t", "small")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, slot int")
    got = mixing.mix_sources(docs, weights={"big": 1, "small": 3}, block_rows=4).orderBy("slot", "source_row").collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r.source_row)
        assert r.block == r.source_row // 4
    assert {s: x == list(range(len(x))) for s, x in by.items()} == {"big": True, "small": True, "": True}
    assert sum(r.source == "small" for r in got[:16]) >= 8
    assert mixing.mix_sources(docs.limit(0)).collect() == []
    docs.write.parquet(f"{tmp_path}/d")
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    twice = spark.createDataFrame([(None, "s")] * 60 + [(k, "s") for k in range(9)], "doc_id long, source string")
    ranks = [r.source_row for r in mixing.mix_sources(twice).collect()]
    assert sorted(ranks) == list(range(69))
    ordered = mixing.in_mixed_order(spark.read.parquet(f"{tmp_path}/d"))
    assert ordered.columns == docs.columns and ordered.count() == len(rows)
