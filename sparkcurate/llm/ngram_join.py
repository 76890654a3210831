"""Exact Jaccard join of word shingles: pivots' Voronoi regions, triangle-inequality windows, recursive joins of regions.

Distances are Jaccard's, 1 - intersection / union, and two texts link at EPS = 1 - T or less. Each text also
has a fold of its set, one parity bit a cell; sets differ in at least as many shingles as folds in
bits, and Jaccard's distance grows with the difference, so folds bound all distances from below.

1. Texts with equal sets become one point.
2. Pivots: points that share a band of minimum hashes gather around some of them. Points within EPS of
   a pivot form its region (each point goes to its nearest pivot, so that a region's radius is at most
   EPS); every other point is a region of its own, of radius 0.
3. Windows: points that link have a common shingle among the first n - ceil(T n) + 1 of each in one
   order of all shingles, frequent ones last; these first ones are a point's cells. Two regions meet
   only in cells, and are joined only if their pivots are within both radii and EPS.
4. A joined pair of regions replicates the points of each that are within the other's radius and EPS
   of its pivot, and just those are compared; sets are read for pairs that the folds allow.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import bounded_batches, forget, hot_rows, join_groups, kept, lean, load, placed, scratch, written

#: Minimum hashes: bands and rows of each.
BANDS, ROWS = 4, 3
#: Pivots that each band proposes.
PIVOTS = 4
#: Buckets of shingles whose frequencies order them; a table of a byte each goes to all tasks.
ORDER_BITS = 22
#: A task tells the buckets it has met so often.
LEAST_COUNT = 8
#: Up to so many ids are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Pairs of points of two regions that are tried first, those with the lowest bounds.
FIRST_PAIRS = 4
MAX_FOLD = 1 << 14
#: Cells with more regions than this are joined with folds at hand.
LARGE = 6
#: Regions of a cell that one task compares with each other; larger groups are split.
LEAF = 512
#: Pivots that a large group is split by.
SPLIT = 8
#: Up to so many large groups' pivots, some 16 KB each, are broadcast; more are joined by a shuffle.
BROADCAST_PIVOTS = 2_000
#: Members of a region that one task compares.
TOGETHER = 128
#: Points of another region that come to them as one.
PIECE = 64


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least similarity in hundredths."""

    words: int = 5
    similar: int = 80


_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_BASE = 0x5851F42D4C957F2D
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_powers = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's first n powers and those of its inverse, modulo 2**64."""
    size = 1 << max(16, n.bit_length())
    if size not in _powers:
        _powers.clear()
        inverse = pow(_BASE, -1, 1 << 64)
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        for out, base in ((up, _BASE), (down, inverse)):
            done, step = 1, base
            while done < size:  # doubling: the next powers are these times base**done
                out[done : 2 * done] = out[:done] * np.uint64(step)
                step = step * step % (1 << 64)
                done *= 2
        _powers[size] = up, down
    return _powers[size]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True


#: Bytes of a text that are hashed at a time.
LONG = 1 << 22
_GAPS = re.compile(rb"[\x20\x09-\x0D]")


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; all its words together where they are fewer than words."""
    if all(len(t) <= LONG for t in texts):
        return _sets(texts, words)
    return [_sets([t], words)[0] if len(t) <= LONG else _long_set(t, words) for t in texts]


def _long_set(text: bytes, words: int) -> np.ndarray:
    """A long text's set, from pieces that end at gaps and begin with the last words of the one before."""
    parts, tail, at = [], b"", 0
    while at < len(text):
        gap = _GAPS.search(text, at + LONG)
        end = gap.start() if gap else len(text)
        piece = tail + b" " + text[at:end]
        parts.append(_sets([piece], words, whole=False)[0])
        tail = b" ".join(piece.rsplit(None, words - 1)[1 - words :]) if words > 1 else b""
        at = end
    every = np.unique(np.concatenate(parts))
    return every if len(every) else _sets([text], words)[0]


def _sets(texts: list[bytes], words: int, whole: bool = True) -> list[np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = _LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    up, down = powers(len(data) + 1)
    gap = _GAP[data]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    begin = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    stop = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
    word = _mix((total[stop] - total[begin]) * down[begin])
    words_before = np.searchsorted(begin, np.concatenate([[0], np.cumsum(sizes + 1)]))
    rolled = np.zeros(len(word), np.uint64)
    if len(word) >= words:
        n = len(word) - words + 1
        acc = word[:n].copy()
        for k in range(1, words):
            acc = _mix(acc + _C) + word[k : k + n]
        rolled[:n] = _mix(acc)
    out = []
    for a, b in zip(words_before[:-1].tolist(), words_before[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a and whole:
            acc = np.array([b - a], np.uint64)
            for k in range(a, b):
                acc = _mix(acc + _C) + word[k]
            out.append(_mix(acc ^ _A))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> int:
    """A hash of the set, signed 64 bits."""
    x = _mix(s * _C + np.uint64(len(s)))
    return int((_mix(np.array([x.sum()]))[0] ^ np.bitwise_xor.reduce(_mix(x + _B))).astype(np.int64))


def fold(s: np.ndarray) -> bytes:
    bits = min(MAX_FOLD, max(64, 1 << (len(s) - 1).bit_length()))
    odd = np.bincount((s >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differences(a: list[bytes], b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """At least so many shingles are in just one of two sets, for each pair of folds."""
    out = np.abs(n_a - n_b)
    size_a, size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    for kind in np.unique(size_a * (1 << 20) + size_b):
        at = np.flatnonzero(size_a * (1 << 20) + size_b == kind)
        wide = [np.frombuffer(b"".join([x[k] for k in at.tolist()]), np.uint64).reshape(len(at), -1) for x in (a, b)]
        least = min(x.shape[1] for x in wide)
        x, y = (np.bitwise_xor.reduce(w.reshape(len(at), -1, least), axis=1) for w in wide)
        out[at] = np.maximum(out[at], np.bitwise_count(x ^ y).sum(1).astype(np.int64))
    return out


def within(similar: int, diff: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, radii: np.ndarray | int = 0) -> np.ndarray:
    """Whether a distance of (1 + radii) * EPS or less is possible where sets differ in diff shingles or more."""
    far = (100 - similar) * (1 + radii)
    return 200 * diff <= far * (n_a + n_b + diff)


def _parts(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    at = size = 0
    for k, x in enumerate(batch.column(column)):
        size += len(x.as_buffer() or b"") if x.is_valid else 0
        if size > limit:
            yield batch.slice(at, k + 1 - at)
            at, size = k + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def _texts(docs: DataFrame, id_: Column, text: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(text, F.lit("")).cast("binary")
    return docs.select(id_.alias("__id"), *keep, F.xxhash64(text).alias("__digest"), text.alias("__text"))


def frequency_classes(texts: DataFrame, rule: Rule) -> bytes:
    """For each bucket of shingles the binary logarithm of how often tasks have met it, 0 for the rare."""

    def count(batches):
        kept("ngrams", None)
        total = np.zeros(1 << ORDER_BITS, np.int32)
        for batch in batches:
            for part in _parts(batch, "__text"):
                sets = shingle_sets(part.column("__text").to_pylist(), rule.words)
                every = np.concatenate([np.zeros(0, np.uint64), *sets])
                np.add.at(total, (every >> np.uint64(64 - ORDER_BITS)).astype(np.int64), 1)
        often = np.flatnonzero(total >= LEAST_COUNT)
        yield pa.RecordBatch.from_arrays([pa.array(often, pa.int64()), pa.array(total[often], pa.int64())], ["bucket", "n"])

    rows = texts.select("__text").mapInArrow(lean(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = np.zeros(1 << ORDER_BITS, np.uint8)
    for r in rows.select("bucket", F.floor(F.log2("n")).cast("int").alias("n")).toLocalIterator():
        table[r["bucket"]] = r["n"]
    return table.tobytes()


def profiles(texts: DataFrame, rule: Rule, classes, keep: tuple[str, ...]) -> DataFrame:
    """Per row: id, n, key of its set, fold, bands, cells (first shingles in the order, 8 bytes each)."""
    fields = [texts.schema["__id"], *(texts.schema[c] for c in keep)]
    schema = T.StructType(fields).add("n", "long").add("key", "long").add("fold", "binary").add("bands", T.ArrayType(T.LongType())).add("cells", "binary")

    def run(batches):
        order = np.frombuffer(classes.value, np.uint8)
        for batch in batches:
            for part in _parts(batch, "__text"):
                n, keys, folds, bands, cells = [], [], [], [], []
                for s in shingle_sets(part.column("__text").to_pylist(), rule.words):
                    n.append(len(s))
                    if not len(s):
                        keys.append(None)
                        folds.append(b"")
                        bands.append([])
                        cells.append(b"")
                        continue
                    keys.append(set_key(s))
                    folds.append(fold(s))
                    least = np.array([(s * seed).min() for seed in _SEEDS], np.uint64).reshape(BANDS, ROWS)
                    bands.append(_mix(_mix(_mix(least[:, 0]) + least[:, 1]) + least[:, 2] + np.arange(BANDS, dtype=np.uint64)).astype(np.int64))
                    first = len(s) - -(-rule.similar * len(s) // 100) + 1
                    rank = order[(s >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                    s = s[np.lexsort((_mix(s), rank))[:first]] if rank.any() else s[np.argsort(_mix(s), kind="stable")[:first]]
                    cells.append(s.tobytes())
                out = [part.column(c) for c in ("__id", *keep)]
                out += [pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(folds, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(cells, pa.binary())]
                yield pa.RecordBatch.from_arrays(out, schema.names)

    return texts.mapInArrow(lean(run), schema)


def bounded(pairs: DataFrame, rule: Rule, points: DataFrame, radii: bool = False) -> DataFrame:
    """Pairs (a, b) that the folds allow to be within EPS, or with radii within EPS and ra + rb times EPS."""
    folds = points.select("key", "n", "fold")
    both = pairs.join(folds.toDF("a", "na", "fa"), "a").join(folds.toDF("b", "nb", "fb"), "b")
    names = pairs.columns
    schema = T.StructType([pairs.schema[c] for c in names])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
                diff = differences(batch.column("fa").to_pylist(), batch.column("fb").to_pylist(), na, nb)
                r = batch.column("ra").to_numpy() + batch.column("rb").to_numpy() if radii else 0
                yield batch.select(names).filter(pa.array(within(rule.similar, diff, na, nb, r)))

    return both.select(*names, "na", "nb", "fa", "fb").mapInArrow(lean(run), schema)


def verified(pairs: DataFrame, rule: Rule, texts: DataFrame, points: DataFrame) -> DataFrame:
    """(a, b, union, diff) of the pairs that link by their sets, which are made again from the texts in question.

    A point's text is found by its id, which may be null, and its digest; others that have both do no harm.
    """
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    ids = written(wanted.join(points.select("key", "first"), "key").select(F.col("first.id").alias("id"), F.col("first.digest").alias("digest")).distinct(), "wanted")
    n = ids.count()
    ids = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    some = texts.join(ids, (F.col("__digest") == F.col("digest")) & F.col("__id").eqNullSafe(F.col("id")), "left_semi").select("__text")

    def sets(batches):
        for batch in batches:
            for part in _parts(batch, "__text"):
                made = [s for s in shingle_sets(part.column("__text").to_pylist(), rule.words) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in made], pa.int64()), pa.array([s.tobytes() for s in made], pa.binary())], ["key", "set"])

    table = written(some.mapInArrow(lean(sets), "key long, set binary").dropDuplicates(["key"]), "sets")
    both = pairs.select("a", "b").join(table.toDF("a", "sa"), "a").join(table.toDF("b", "sb"), "b")

    def run(batches):
        for batch in batches:
            a, b, union, diff = [], [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sa", "sb")), strict=True)
            for ka, kb, sa, sb in rows:
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                every = len(x) + len(y) - common
                if 100 * common >= rule.similar * every:
                    a.append(ka)
                    b.append(kb)
                    union.append(every)
                    diff.append(every - common)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, union, diff)], ["a", "b", "union", "diff"])

    return written(both.select("a", "b", "sa", "sb").mapInArrow(lean(run), "a long, b long, union long, diff long"), "links")


def band_pairs(points: DataFrame) -> DataFrame:
    """(a, b): a shares a band with b, one of the band's PIVOTS points of smallest hashes, each by another hash of the key."""
    bands = points.select("key", F.explode("bands").alias("band"))
    firsts = [F.min_by("key", F.xxhash64("key", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)]
    pivots = bands.groupBy("band").agg(*firsts, F.count(F.lit(1)).alias("n")).where("n > 1")
    pivots = written(pivots.select(F.col("band").alias("key"), "n", F.array_distinct(F.array(*(f"p{k}" for k in range(PIVOTS)))).alias("pivots")), "pivots")
    bands = bands.select(F.col("band").alias("key"), F.col("key").alias("a"))
    both = join_groups(bands, pivots, pivots.count(), hot_rows(points.count()), "inner", by=("a",))
    return both.select("a", F.explode("pivots").alias("b")).where("a <> b").distinct()


def region_pairs(points: DataFrame, rule: Rule, regions: DataFrame) -> DataFrame:
    """(a, b, ra, rb): regions whose points have a common cell, sizes and places that allow a link, and pivots near enough by their folds.

    Cells with up to LARGE regions give their pairs at once. The rows of larger ones are joined again by
    cell, with the pivots' folds, and only pairs that pass are given, in the first cell that both have.
    """
    assigned = points.select("key", "n", "cells").join(regions, "key", "left").select(F.coalesce("region", "key").alias("region"), F.col("region").isNotNull().cast("long").alias("r"), "n", "cells")

    def spread(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cells").to_pylist()
            count = np.fromiter((len(c) // 8 for c in cells), np.int64, len(cells))
            cell = np.frombuffer(b"".join(cells), np.int64)
            region, r, n = (np.repeat(batch.column(c).to_numpy(), count) for c in ("region", "r", "n"))
            place = np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)
            if len(cell):
                yield _merged(cell, region, r, n, n, place)

    def meet(batches):
        held, large = None, None
        for batch in batches:
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if held.num_rows < 1 << 16:
                continue
            cell = held.column("cell").to_numpy()
            cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            if cut:
                yield from _met(rule, held.slice(0, cut), large)
                held = held.slice(cut)
            if held.num_rows > 1 << 18:
                large = cell[-1]
                yield from _met(rule, held, large)
                held = held.slice(0, 0)
        if held is not None and held.num_rows:
            yield from _met(rule, held, large)

    rows = assigned.mapInArrow(lean(spread), "cell long, region long, r long, least long, most long, place long")
    parts = min(max(1, points.count() // 4_000), 20_000)
    dealt = rows.repartition(parts, "cell").sortWithinPartitions("cell", "region")
    met = written(dealt.mapInArrow(lean(meet), "cell long, a long, b long, ra long, rb long, least long, most long, place long"), "meetings")
    small = met.where("cell IS NULL").select("a", "b", "ra", "rb").distinct()
    large = met.where("cell IS NOT NULL").select("cell", F.col("a").alias("region"), F.col("ra").alias("r"), "least", "most", "place")
    return bounded(small, rule, points, radii=True).unionByName(large_cells(large, rule, points, parts))


_CELL_NAMES = ["cell", "region", "r", "least", "most", "place"]
_MET_SCHEMA = pa.schema([(c, pa.int64()) for c in ("cell", "a", "b", "ra", "rb", "least", "most", "place")])


def _merged(cell, region, r, least, most, place) -> pa.RecordBatch:
    """One row per cell and region: smallest and largest set, first place in the order."""
    order = np.lexsort((region, cell))
    cell, region, r, least, most, place = (x[order] for x in (cell, region, r, least, most, place))
    new = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (region[1:] != region[:-1])]))
    columns = [cell[new], region[new], r[new], np.minimum.reduceat(least, new), np.maximum.reduceat(most, new), np.minimum.reduceat(place, new)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _CELL_NAMES)


def _near(rule: Rule, most_a, least_b, most_b, place_a, place_b) -> np.ndarray:
    """Whether sizes and places allow a link; b's smallest set isn't smaller than a's."""
    size = most_a + most_b
    return (100 * most_a >= rule.similar * least_b) & ((100 + rule.similar) * (place_a + place_b) <= (100 - rule.similar) * size)


def _met(rule: Rule, batch: pa.RecordBatch, large) -> Iterator[pa.RecordBatch]:
    """Pairs of the small cells' regions (cell null), and the rows of large cells as they are (a: region, ra: its radius)."""
    batch = _merged(*(batch.column(c).to_numpy() for c in _CELL_NAMES))
    cell, region, r, least, most, place = (batch.column(c).to_numpy() for c in _CELL_NAMES)
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sizes = np.diff(np.append(first, len(cell)))
    big = np.repeat(sizes > LARGE, sizes) | (cell == large if large is not None else np.zeros(len(cell), bool))
    if big.any():
        zero = np.zeros(int(big.sum()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cell[big], region[big], zero, r[big], zero, least[big], most[big], place[big])], schema=_MET_SCHEMA)
    order = np.lexsort((least, cell))
    order = order[~big[order]]
    cell, region, r, least, most, place = (x[order] for x in (cell, region, r, least, most, place))
    found = []
    for step in range(1, LARGE):
        left = np.flatnonzero(cell[step:] == cell[:-step]) if step < len(cell) else np.zeros(0, np.int64)
        if not len(left):
            break
        right = left + step
        fine = _near(rule, most[left], least[right], most[right], place[left], place[right])
        left, right = left[fine], right[fine]
        low = region[left] < region[right]
        left, right = np.where(low, left, right), np.where(low, right, left)
        found.append(np.stack([region[left], region[right], r[left], r[right]], 1))
    if found:
        a, b, ra, rb = np.unique(np.concatenate(found), axis=0).T
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([none, *(pa.array(np.ascontiguousarray(x)) for x in (a, b, ra, rb)), none, none, none], schema=_MET_SCHEMA)


#: What a region is in a group: at home, or there because a home region may be near. Pairs are compared if one is at home, or if they are of the two halves.
HOME, GUEST, LEFT, RIGHT = 0, 1, 2, 3
#: Each row has so many of its region's large cells, the lowest, so that a pair that meets in one of them isn't given again in a higher cell.
LISTED = 64


def large_cells(rows: DataFrame, rule: Rule, points: DataFrame, parts: int) -> DataFrame:
    """(a, b, ra, rb) of large cells' regions that the folds allow to be near enough.

    A cell's regions are a group. Groups of up to LEAF regions are compared in a task; a larger one is
    split by pivots of its own, and its parts again, until all are small. Folds of one width are points
    of a metric space, in which near regions are at most a bound apart: a region is at home with its
    nearest pivot and a guest where another one isn't farther by over twice the bound, so that each near
    pair meets where one of them is at home. A split is taken where it leaves half of the group's comparing
    (homes times rows) at most, which ends the recursion: a level has half of the comparing of the one above.
    Other groups, as those of texts that have nothing else in common, are cut into blocks of regions of like
    size, and each pair of blocks whose sizes allow a link is a group.
    """
    merged = written(rows.select("cell", "region", "r").distinct(), "merged")
    lists = merged.groupBy("region").agg(F.slice(F.array_sort(F.collect_list("cell")), 1, LISTED).alias("cells"))
    level = merged.join(points.select(F.col("key").alias("region"), "n", "fold"), "region").join(lists, "region")
    level = level.select(F.col("cell").alias("grp"), "region", "r", "n", "fold", F.lit(HOME).alias("side"), F.lit(False).alias("final"), F.filter("cells", lambda c: c < F.col("cell")).alias("lower"))
    level = written(level, "level")
    found = []
    for depth in itertools.count():
        sizes = level.where("NOT final").groupBy(F.col("grp").alias("key")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("side") == HOME).alias("at_home"),
            F.min(F.octet_length("fold")).alias("width"),
            F.max("r").alias("far"),
            F.max(level["n"]).alias("top"),
            *(F.min_by("fold", F.xxhash64("region", F.lit(k + SPLIT * depth))).alias(f"p{k}") for k in range(SPLIT)),
        )
        sizes = written(sizes.where(F.col("n") > LEAF), "sizes")
        n_big = sizes.count()
        if not n_big:
            found.append(written(_leaves(level, rule, parts), "leaf-pairs"))
            break
        hot = hot_rows(level.count())
        keyed = level.withColumnsRenamed({"grp": "key", "n": "size"})
        both = join_groups(keyed, sizes.select("key", "n"), n_big, hot, by=("region", "side")).withColumn("large", F.col("n").isNotNull() & ~F.col("final"))
        small = both.where("NOT large").select(F.col("key").alias("grp"), "region", "r", F.col("size").alias("n"), "fold", "side", "final", "lower")
        found.append(written(_leaves(small, rule, parts), "leaf-pairs"))
        # guests alone need not meet
        large = join_groups(keyed.where("NOT final"), sizes.where("at_home > 0"), n_big, hot, "inner", by=("region", "side"), most=BROADCAST_PIVOTS)
        homes = written(_homes(large.withColumn("class", _size_class(rule)), rule), "homes")
        spread = homes.select("key", "n", "at_home", "side", F.posexplode(F.concat(F.array("home"), "also")).alias("k", "to")).groupBy("key", "to")
        spread = spread.agg(F.count(F.lit(1)).alias("rows"), F.count_if((F.col("k") == 0) & (F.col("side") == HOME)).alias("own"), F.max("n").alias("n"), F.max("at_home").alias("at_home"))
        good = spread.groupBy("key").agg(F.max("n").alias("n"), F.max("at_home").alias("at_home"), F.sum(F.col("own") * F.col("rows")).alias("work"), F.sum("rows").alias("sum"))
        # worth it where at least half of the comparing goes, and rows at most triple
        good = good.select("key", "n", ((2 * F.col("work") <= F.col("at_home") * F.col("n")) & (F.col("sum") <= 3 * F.col("n"))).alias("apart"))
        classes = homes.groupBy("key", "class").agg(F.ceil(2 * F.count(F.lit(1)) / LEAF).alias("blocks"))
        classes = classes.groupBy("key").agg(F.collect_list(F.struct("class", "blocks")).alias("classes"))
        good = written(good.join(classes, "key"), "good")
        after = written(_parts_again(join_groups(homes.drop("n", "at_home"), good, n_big, hot, "inner", by=("region", "side"))), "level")
        level = after
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.distinct()


def _homes(rows: DataFrame, rule: Rule) -> DataFrame:
    """rows with home, the number of the nearest pivot of their group, and also, those of others that may have a near region at home."""
    schema = T.StructType([f for f in rows.schema if not f.name.startswith("p") and f.name not in ("width", "far", "top")]).add("home", "integer").add("also", T.ArrayType(T.IntegerType()))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            folds, width = batch.column("fold").to_pylist(), batch.column("width").to_numpy()
            pivots = [batch.column(f"p{k}").to_pylist() for k in range(SPLIT)]
            size, r, far = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "r", "far"))
            apart = np.zeros((len(folds), SPLIT), np.int64)
            for w in np.unique(width).tolist():
                at = np.flatnonzero(width == w)
                own = _narrowed([folds[k] for k in at.tolist()], w)
                for k in range(SPLIT):
                    apart[at, k] = np.bitwise_count(own ^ _narrowed([pivots[k][j] for j in at.tolist()], w)).sum(1)
            bound = _most_apart(rule, size, r + far)
            # pivots near an earlier one part nothing; all rows of a group leave out the same ones
            alike = _most_apart(rule, batch.column("top").to_numpy().astype(np.int64), 2 * far)
            for k in range(1, SPLIT):
                for w in np.unique(width).tolist():
                    at = np.flatnonzero(width == w)
                    own = _narrowed([pivots[k][j] for j in at.tolist()], w)
                    for other in range(k):
                        close = np.bitwise_count(own ^ _narrowed([pivots[other][j] for j in at.tolist()], w)).sum(1) <= alike[at]
                        apart[at[close & (apart[at, other] < NOWHERE)], k] = NOWHERE
            home = apart.argmin(1)
            near = (apart <= apart.min(1)[:, None] + 2 * bound[:, None]) & (apart < NOWHERE)
            near[np.arange(len(home)), home] = False
            also = [np.flatnonzero(x).tolist() for x in near]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.names[:-2]), pa.array(home, pa.int32()), pa.array(also, pa.list_(pa.int32()))], schema.names)

    return rows.mapInArrow(lean(run), schema)


#: A distance that stands for a pivot that is left out.
NOWHERE = 1 << 40


def _most_apart(rule: Rule, size: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """At most so many shingles are in one alone of a set of that size and one that within() lets be near; the larger of them has 100 / (100 - eps) as many."""
    eps = (100 - rule.similar) * (1 + radii)
    other = -(-100 * size // np.maximum(1, 100 - eps))
    return np.where(eps >= 100, NOWHERE // 4, -(-eps * (size + other) // np.maximum(1, 200 - eps)))


def _narrowed(folds: list[bytes], width: int) -> np.ndarray:
    """Folds of a width in bytes, to which wider ones are folded."""
    out = np.empty((len(folds), width // 8), np.uint64)
    length = np.fromiter(map(len, folds), np.int64, len(folds))
    for kind in np.unique(length).tolist():
        at = np.flatnonzero(length == kind)
        wide = np.frombuffer(b"".join([folds[k] for k in at.tolist()]), np.uint64)
        out[at] = np.bitwise_xor.reduce(wide.reshape(len(at), -1, width // 8), axis=1)
    return out


#: Classes of sizes within which the largest set that may be near to another goes; rounding may add one.
CLASSES = 4
_CODE = 1 << 32


def _size_class(rule: Rule) -> Column:
    """A number that differs by CLASSES + 1 at most for regions of a group whose sizes let them be near."""
    eps = (100 - rule.similar) * (1 + 2 * F.col("far"))
    step = F.when(eps < 100, -F.log((100 - F.least(eps, F.lit(99))) / 100) / CLASSES)
    return F.coalesce(F.floor(F.log(F.greatest("size", F.lit(1))) / step), F.lit(0).cast("long"))


def _parts_again(rows: DataFrame) -> DataFrame:
    """The next level: groups that pivots took apart (apart) by pivots, others in pairs of blocks, which are final.

    A block has regions of one class of sizes, and meets those of classes that are near enough.
    """
    one = F.col("class")
    blocks = F.filter("classes", lambda x: x["class"] == one)[0]["blocks"]
    own = one * _CODE + F.pmod(F.xxhash64("region"), blocks)
    group = lambda *x: F.xxhash64("key", *x)
    # a guest stays one: two guests of a group need not meet
    by_pivot = F.transform(F.concat(F.array("home"), "also"), lambda k, i: F.struct(group(F.lit(0), k).alias("grp"), F.when((i == 0) & (F.col("side") == HOME), HOME).otherwise(GUEST).alias("side"), F.lit(False).alias("final")))
    near = F.filter("classes", lambda x: F.abs(x["class"] - one) <= CLASSES + 1)
    met = F.flatten(F.transform(near, lambda x: F.transform(F.sequence(F.lit(0).cast("long"), x["blocks"] - 1), lambda j: x["class"] * _CODE + j)))
    by_block = F.transform(met, lambda j: F.struct(group(F.lit(1), F.least(own, j), F.greatest(own, j)).alias("grp"), F.when(own == j, F.col("side")).when(own < j, LEFT).otherwise(RIGHT).alias("side"), F.lit(True).alias("final")))
    each = rows.withColumn("x", F.explode(F.when(F.col("apart"), by_pivot).otherwise(by_block)))
    return each.select("x.grp", "region", "r", F.col("size").alias("n"), "fold", "x.side", "x.final", "lower")


def _leaves(rows: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """(a, b, ra, rb): pairs of a group's regions that pass."""
    dealt = rows.repartition(parts, "grp").sortWithinPartitions("grp", "n", "region")

    def run(batches):
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["grp"] != held[0]["grp"]:
                    yield from _compared(rule, held)
                    held = []
                held.append(row)
        yield from _compared(rule, held)

    return dealt.mapInArrow(lean(run), "a long, b long, ra long, rb long").distinct()


def _compared(rule: Rule, rows: list[dict]) -> Iterator[pa.RecordBatch]:
    if len(rows) < 2:
        return
    region, r, n, side = (np.array([x[c] for x in rows]) for c in ("region", "r", "n", "side"))
    folds = [x["fold"] for x in rows]
    lower = [frozenset(x["lower"]) for x in rows]
    out = []
    for k in range(len(rows) - 1):
        # three times EPS at most lie between pivots; so the sizes can't be further apart
        least = 100 - 3 * (100 - rule.similar)
        right = np.arange(k + 1, int(np.searchsorted(n, 100 * n[k] // least, side="right")) if least > 0 else len(rows))
        right = right[(side[right] != side[k]) | (side[k] == HOME)]
        if not len(right):
            continue
        diff = differences_to(folds[k], int(n[k]), [folds[j] for j in right], n[right])
        right = right[within(rule.similar, diff, n[k], n[right], r[k] + r[right])]
        for j in right[region[right] != region[k]].tolist():
            # what lets a pair pass is the same in all cells, so that the lowest one speaks for all
            if not lower[k].isdisjoint(lower[j]):
                continue
            a, b = (k, j) if region[k] < region[j] else (j, k)
            out.append((region[a], region[b], r[a], r[b]))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b", "ra", "rb"])


def differences_to(one: bytes, n: int, folds: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """differences() of one fold to each of folds."""
    out = np.abs(sizes - n)
    length = np.fromiter(map(len, folds), np.int64, len(folds))
    x = np.frombuffer(one, np.uint64)
    for kind in np.unique(length):
        at = np.flatnonzero(length == kind)
        wide = np.frombuffer(b"".join([folds[k] for k in at.tolist()]), np.uint64).reshape(len(at), -1)
        least = min(len(x), wide.shape[1])
        y = np.bitwise_xor.reduce(wide.reshape(len(at), -1, least), axis=1) ^ np.bitwise_xor.reduce(x.reshape(-1, least), axis=0)
        out[at] = np.maximum(out[at], np.bitwise_count(y).sum(1).astype(np.int64))
    return out


def window_pairs(pairs: DataFrame, rule: Rule, points: DataFrame, regions: DataFrame, skip: int, most: int | None) -> DataFrame:
    """(ra_, rb_, a, b, more): pairs of points of two regions that the folds allow to link; of each two regions, by parts, those of ranks from skip on by their bound, most of them.

    The larger region stays where it is, in parts of TOGETHER members. The other's points, in pieces of
    PIECE, come to each part; where many come to one, they go to several copies of it.
    """
    folds = points.select("key", "n", "fold")
    members = regions.select("region", "key").union(regions.select("region", F.col("region").alias("key"))).distinct()
    members = written(members.join(folds, "key").select(F.col("region").alias("key"), F.col("key").alias("point"), F.col("n").alias("size"), "fold"), "members")
    sizes = written(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    n_regions, hot = sizes.count(), hot_rows(members.count())
    own = sizes.select(F.col("key").alias("region"), "n")
    both = pairs.select("a", "b").join(own.toDF("a", "sa"), "a", "left").join(own.toDF("b", "sb"), "b", "left").fillna(0, ["sa", "sb"])
    turn = F.col("sa") >= F.col("sb")
    both = both.select("a", "b", F.when(turn, F.col("a")).otherwise(F.col("b")).alias("key"), F.when(turn, F.col("b")).otherwise(F.col("a")).alias("small"), F.greatest("sa", "sb").alias("most"), F.least("sa", "sb").alias("least"))
    both = written(both, "region-pairs")

    def shares(n: Column, size: int) -> Column:
        return (F.floor((n - 1) / size) + 1).cast("int")

    coming = F.sum(F.greatest("least", F.lit(1)))
    meets = both.groupBy("key").agg(F.count(F.lit(1)).alias("n"), shares(F.max("most"), TOGETHER).alias("salts"), shares(coming, 2 * PIECE).alias("copies"))
    meets = written(meets, "meets")
    both = join_groups(both, meets, n_regions, hot_rows(both.count()), "inner", by=("a", "b")).drop("n", "most")
    # the larger region's members, each in one part of it
    stay = meets.select("key", "salts", "copies").join(sizes, "key")
    home = join_groups(members, stay, n_regions, hot, "inner", by=("point",))
    home = home.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    part = [F.col("key").alias("big"), F.pmod(F.xxhash64("point"), F.col("salts")).cast("int").alias("part"), "copy"]
    none = F.lit(None).cast("long")
    home = home.select(*part, F.lit(0).alias("kind"), none.alias("a"), none.alias("b"), F.lit(0).alias("piece"), "point", "size", "fold")
    # the smaller one's go to each part, in pieces of their own; a region without members is its own point
    alone = both.where("least = 0").join(folds.toDF("small", "size", "fold"), "small").withColumn("point", F.col("small")).withColumn("piece", F.lit(0))
    meet = both.where("least > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), shares(F.col("least"), PIECE) - 1)))
    dealt = join_groups(members, sizes, n_regions, hot, "inner", by=("point",))
    dealt = dealt.select(F.col("key").alias("small"), F.pmod(F.xxhash64("point"), shares(F.col("n"), PIECE)).cast("int").alias("piece"), "point", "size", "fold")
    columns = ["a", "b", "key", "salts", "copies", "piece", "point", "size", "fold"]
    guests = alone.select(columns).unionByName(meet.join(dealt, ["small", "piece"]).select(columns))
    guests = guests.withColumn("copy", F.pmod(F.xxhash64("a", "b", "piece"), F.col("copies")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    guests = guests.select(F.col("key").alias("big"), "part", "copy", F.lit(1).alias("kind"), "a", "b", "piece", "point", "size", "fold")
    place = ["big", "part", "copy"]
    dealt = home.unionByName(guests).repartition(*place).sortWithinPartitions(*place, "kind", "a", "b", "piece")

    def run(batches):
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            big, part, copy = (batch.column(c).to_numpy() for c in place)
            cuts = np.flatnonzero(np.concatenate([[True], (big[1:] != big[:-1]) | (part[1:] != part[:-1]) | (copy[1:] != copy[:-1])])).tolist()
            for at, end in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                group = (big[at], part[at], copy[at])
                if group != now:
                    yield from _windows(rule, held, skip, most)
                    held, now = [], group
                held.append(batch.slice(at, end - at))
        yield from _windows(rule, held, skip, most)

    return dealt.mapInArrow(lean(run), "ra_ long, rb_ long, a long, b long, more boolean")


def _windows(rule: Rule, batches: list[pa.RecordBatch], skip: int, most: int | None) -> Iterator[pa.RecordBatch]:
    """The pairs of one part of a region, whose members come first, with the points that come to it."""
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    kind = table.column("kind").to_numpy()
    n_home = int((kind == 0).sum())
    if n_home in (0, len(kind)):
        return
    piece, point, size = (table.column(c).to_numpy() for c in ("piece", "point", "size"))
    ra, rb = (table.column(c).slice(n_home).to_numpy().astype(np.int64) for c in ("a", "b"))
    folds = table.column("fold").to_pylist()
    n_x, key_x, folds_x = size[:n_home], point[:n_home], folds[:n_home]
    found, counts, bounds = [], [], []
    for key, n, fold_y in zip(point[n_home:].tolist(), size[n_home:].tolist(), folds[n_home:], strict=True):
        diff = differences_to(fold_y, n, folds_x, n_x)
        ok = np.flatnonzero(within(rule.similar, diff, n, n_x) & (key_x != key))
        found.append(key_x[ok])
        counts.append(len(ok))
        bounds.append(diff[ok] / (n + n_x[ok]))
    b, d = np.concatenate(found), np.concatenate(bounds)
    if not len(b):
        return
    ra, rb, piece, a = (np.repeat(v, counts) for v in (ra, rb, piece[n_home:], point[n_home:]))
    order = np.lexsort((b, a, d, piece, rb, ra))
    ra, rb, piece, a, b = (v[order] for v in (ra, rb, piece, a, b))
    new = np.concatenate([[True], (ra[1:] != ra[:-1]) | (rb[1:] != rb[:-1]) | (piece[1:] != piece[:-1])])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(b)))
    size = np.repeat(sizes, sizes)
    rank = np.arange(len(b)) - np.repeat(first, sizes)
    last = len(b) + skip if most is None else skip + most
    take = (rank >= skip) & (rank < last)
    if take.any():
        yield pa.RecordBatch.from_arrays([pa.array(v[take]) for v in (ra, rb, a, b, size > last)], ["ra_", "rb_", "a", "b", "more"])


def components(edges: DataFrame) -> DataFrame:
    """(key, component) for all ends of edges (a, b): the smallest key reachable. Labels spread and jump until none changes."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "key"), "labels")
    while True:
        near = both.join(labels.toDF("b", "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near.withColumnRenamed("a", "key"), "key").select("key", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        spread = written(spread, "spread")
        jump = spread.select(F.col("key").alias("label"), F.col("label").alias("further"))
        new = written(spread.join(jump, "label", "left").select("key", F.least("label", F.coalesce("further", "label")).alias("label"), "old"), "labels")
        if not new.where("label <> old").take(1):
            return new.select("key", F.col("label").alias("component"))
        labels = new.select("key", "label")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (the smallest id reachable by links).

    Null text counts as empty; texts without words have no shingles and link with nothing, so their
    component is their own id. Rows with equal texts link whatever their ids; a null id is smaller than
    none, and null only where all ids of a component are. Other columns, of any name, are ignored; an
    empty table gives no rows. Long texts are hashed in pieces. Sets and shingles go by 64-bit hashes.
    """
    found = _groups(_texts(docs, F.col(id_col), F.col(text_col)), rule)
    return found.select(F.col("__id").alias(id_col), "n_shingles", "component_id")


def _groups(texts: DataFrame, rule: Rule, keep: tuple[str, ...] = ()) -> DataFrame:
    """(__id, the columns in keep, n_shingles, component_id, component_key) of _texts(); the component's own key is null without shingles."""
    spark = texts.sparkSession
    bounded_batches(spark)
    classes = spark.sparkContext.broadcast(frequency_classes(texts, rule))
    profile = written(profiles(texts, rule, classes, ("__digest", *keep)), "profiles")
    with scratch() as made:
        first = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__digest").alias("digest")))
        points = profile.where("key IS NOT NULL").groupBy("key").agg(*(F.first(c).alias(c) for c in ("n", "fold", "bands", "cells")), first.alias("first"))
        points = written(points, "points")
        near = written(bounded(band_pairs(points), rule, points), "near")
        star = verified(near, rule, texts, points)
        nearest = F.min_by("b", F.struct(F.col("diff") / F.col("union"), "b"))
        regions = written(star.groupBy(F.col("a").alias("key")).agg(nearest.alias("region")), "regions")
        # a pivot's region has its pivot as a point too, unless that is nearer to another one
        centres = regions.select(F.col("region").alias("key")).distinct().join(regions.select("key"), "key", "left_anti")
        regions = written(regions.unionByName(centres.select("key", F.col("key").alias("region"))), "regions")
        met = written(region_pairs(points, rule, regions), "met")
        alone = met.where("ra = 0 AND rb = 0").select("a", "b")
        deep = met.where("ra > 0 OR rb > 0")
        edges = star.select("a", "b")
        tries = written(window_pairs(deep, rule, points, regions, 0, FIRST_PAIRS), "tries")
        direct = verified(written(alone.unionByName(tries.select("a", "b")).distinct(), "pairs"), rule, texts, points)
        edges = edges.unionByName(direct.select("a", "b"))
        hits = tries.join(direct.select("a", "b", F.lit(1).alias("hit")), ["a", "b"], "left").groupBy("ra_", "rb_")
        open_pairs = hits.agg(F.max("hit").alias("hit"), F.max("more").alias("more")).where("more AND hit IS NULL")
        left = written(open_pairs.select(F.col("ra_").alias("a"), F.col("rb_").alias("b")).join(deep, ["a", "b"]), "left")
        if left.take(1):
            rest = written(window_pairs(left, rule, points, regions, FIRST_PAIRS, None).select("a", "b").distinct(), "rest")
            edges = edges.unionByName(verified(rest, rule, texts, points).select("a", "b"))
        groups = components(edges)
        ids = profile.groupBy("key").agg(F.min("__id").alias("least")).where("key IS NOT NULL").join(groups, "key")
        named = ids.groupBy("component").agg(F.min("least").alias("name"))
        named = groups.join(named, "component").select("key", "component", "name")
        own = profile.where("key IS NOT NULL").groupBy("key").agg(F.min("__id").alias("own"))
        own = own.join(named, "key", "left").select("key", F.coalesce("component", "key").alias("component_key"), F.coalesce("name", "own").alias("name"))
        named = written(own, "named")
    forget(*(t for t in made if t is not named))
    out = profile.select("__id", *keep, "n", "key").join(named, "key", "left")
    return out.select("__id", *keep, F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("__id")).otherwise(F.col("name")).alias("component_id"), "component_key")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule(), limit: int = 200_000) -> DataFrame:
    """The rows of docs, with all columns, whatever their names, of which each component has its first: smallest id, then place; a null id is last.

    Dropped rows' places are broadcast while they are at most limit, else joined by a shuffle. Texts
    without words are components of their own.
    """
    rows = placed(docs, "located")
    groups = _groups(_texts(rows, F.col("row")[id_col], F.col("row")[text_col], ("file", "at")), rule, ("file", "at"))
    place = F.struct(F.col("__id").isNull().alias("none"), "__id", "file", "at")
    groups = written(groups.where("n_shingles > 0").select("file", "at", "component_key", place.alias("place")), "groups")
    groups = groups.withColumnRenamed("component_key", "key")
    first = written(groups.groupBy("key").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "firsts")
    gone = written(join_groups(groups, first, first.count(), hot_rows(groups.count()), "inner").where("place <> first").select("file", "at"), "gone")
    gone = F.broadcast(gone) if gone.count() <= limit else gone
    return rows.join(gone, ["file", "at"], "left_anti").select("row.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(load(spark, sf_dir, "documents"), rule=Rule(4, 85))
