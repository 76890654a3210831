"""Removal of repeated 100-byte strings: anchors find where texts can repeat, suffix arrays settle it.

Each window of WINDOW bytes has an anchor, its GRAM bytes with the smallest hash. Equal windows have
equal anchors at the same place in them; so windows are compared only with those of equal anchors,
and neighbouring windows with the same anchor stay together as a run. Runs that are equal as a whole
need only their first occurrence; the different runs of an anchor are set in one text and sorted as
suffixes, by a grouping construction in linear time, and neighbours in that order that share a window
are equal windows. In that text the bytes that the neighbouring windows of a block all have stand as one
symbol, the same for the same bytes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ngram_join import _A, _B, _C, _mix, _parts, powers
from .shared import bounded_batches, forget, hot_rows, join_groups, kept, load, placed, scratch, written

WINDOW, GRAM = 100, 32
#: An anchor with more different runs than this is cut into groups by further bytes; such a group of more than PIECES parts, into windows.
MANY, PIECES = 2_000, 500
#: Runs that repeat in a piece of text are remembered by a task, so many, for what comes after; more just meet later.
REMEMBERED = 20_000
#: Symbols of the texts that suffixes are sorted in; a group of runs isn't split.
SORTED = 1 << 16
#: Up to so many ids of documents with spans are broadcast; beyond that all texts are shuffled to their spans.
BROADCAST_IDS = 1_000_000
#: Bytes of text that a task handles at a time, many times over in arrays.
CHUNK = 1 << 19
NO_ID = -(1 << 63)


def rolling(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash modulo 2**64, and powers of the base's inverse."""
    up, down = powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return total, down


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbours."""
    done, y = 1, x
    while 2 * done <= width:
        y = np.minimum(y[: len(y) - done], y[done:])
        done *= 2
    rest = width - done
    return np.minimum(y[: len(y) - rest], y[rest:]) if rest else y


#: Places in a piece of text take so many bits of a window's key; longer data is cut into pieces.
PLACE_BITS = 24
_LOW = np.uint64((1 << PLACE_BITS) - 1)


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, first window's start, windows, anchor's hash, hash of the run's bytes, anchor's place in it) of all runs."""
    pieces, owner, shift = [], [], []
    step = (1 << PLACE_BITS) // 2
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - WINDOW + 1), step):
            pieces.append(text[at : at + step + WINDOW - 1])
            owner.append(k)
            shift.append(at)
    out, held, size = [], [], 0
    for k, piece in enumerate(pieces):
        if held and size + len(piece) >= 1 << PLACE_BITS:
            out.append(_runs([pieces[j] for j in held], np.array(held)))
            held, size = [], 0
        if len(piece) >= WINDOW:
            held.append(k)
            size += len(piece)
    if held:
        out.append(_runs([pieces[j] for j in held], np.array(held)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    piece, start, count, anchor, context, rel = (np.concatenate(x) for x in zip(*out, strict=True))
    return np.array(owner)[piece], start + np.array(shift)[piece], count, anchor, context, rel


def _runs(texts: list[bytes], names: np.ndarray) -> tuple[np.ndarray, ...]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    total, down = rolling(data)
    n = len(data)
    gram = _mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])
    # keys order by hash, then by place; so a window's anchor is the first of its smallest
    least = sliding_min((gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64), WINDOW - GRAM + 1)
    place = (least & _LOW).astype(np.int64)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(place)]
    inside = np.arange(len(place)) + WINDOW <= ends[owner]
    changed = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(changed & inside)
    edge = np.append(np.flatnonzero(changed | ~inside), len(place))
    count = edge[np.searchsorted(edge, first, side="right")] - first
    body = (total[first + count + WINDOW - 1] - total[first]) * down[first]
    context = _mix(_mix(body) + (place[first] - first).astype(np.uint64) * _C + count.astype(np.uint64) * _B)
    return names[owner[first]], first - begin[owner[first]], count, gram[place[first]].astype(np.int64), context.astype(np.int64), place[first] - first


def suffix_array(text: list[int]) -> list[int]:
    """Places of the text's suffixes in ascending order, for symbols below 2**16; an end ranks below all symbols. Linear time.

    Suffixes stand in groups, first by their first symbol, at last by their longest Lyndon prefix.
    Groups are taken from the greatest down. Each member has a pointer to the nearest place before it
    in a lower group, whose prefix the member's continues: places pointed at leave their group for new
    ones above it, the higher the more members point at them. Then the order within groups follows
    from the ends up: when a suffix is placed, those whose Lyndon prefix ends where it starts take the
    next free places of their groups, and the pointers lead from one to the next.

    First groups come from a radix sort. A pointer is found along pointers of higher groups and of the
    own one; what one search passes over no later one does, for that starts from its member or leaps it.
    """
    n = len(text)
    order = np.argsort(np.asarray(text, np.uint16), kind="stable").tolist()
    place, group, size, before = [0] * n, [0] * n, [0] * n, [-2] * n
    start, last = 0, None
    for k, i in enumerate(order):
        if text[i] != last:
            start, last = k, text[i]
        place[i], group[i] = k, start
        size[start] += 1
    top = n
    while top:
        low = group[order[top - 1]]
        members = order[low:top]
        votes: dict[int, int] = {}
        for i in members:
            j = before[i]
            if j == -2:
                path = [i]
                j = i - 1
                while j >= 0 and group[j] >= low:
                    if before[j] == -2:  # a member whose own search goes on from here
                        path.append(j)
                        j -= 1
                    else:
                        j = before[j]
                for k in path:
                    before[k] = j
            if j >= 0:
                votes[j] = votes.get(j, 0) + 1
        if votes:
            most = max(votes.values())
            by_votes: list[list[int]] = [[] for _ in range(most + 1)]  # no longer than the members
            for j, v in votes.items():
                by_votes[v].append(j)
            for v in range(most, 0, -1):
                moved = by_votes[v]
                for j in moved:
                    g = group[j]
                    end = g + size[g] - 1
                    other, at = order[end], place[j]
                    order[at], order[end] = other, j
                    place[other], place[j] = at, end
                    size[g] = end - g
                starts = [group[j] + size[group[j]] for j in moved]
                for j, g in zip(moved, starts, strict=True):
                    group[j] = g
                    size[g] += 1
        top = low
    out, free, placed = [0] * n, list(range(n)), bytearray(n + 1)
    for k in range(-1, n):
        i = (n if k < 0 else out[k]) - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            placed[i] = 1
            i = before[i]
    return out


#: A run's row. k: 48 bits of its anchor's hash. what: whether it is known to repeat an earlier run (the
#: sign), 46 bits of the hash of its bytes, its number of windows and the anchor's place in it (7 bits each).
RUNS = "k long, what long, doc long, u long, s long"
RUNS_SCHEMA = pa.schema([(c, pa.int64()) for c in ("k", "what", "doc", "u", "s")])


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema.names)


def anchor_runs(texts: DataFrame) -> DataFrame:
    """All runs; equal ones of a task are combined: those that a smaller one is known of are marked as repeats and spread by document.

    So what many documents share gives about a row a task of its anchor, and not one a document.
    """

    def run(batches):
        kept("suffixes", None)
        seen: dict[tuple[int, int], tuple[int, int, int]] = {}
        may = np.zeros(1 << 20, bool)  # low bits of the keys in seen, so that few others are looked up
        for batch in batches:
            for part in _parts(batch, "__text", CHUNK):
                owner, s, n, k, context, rel = runs_of(part.column("__text").to_pylist())
                doc, u = (part.column(c).to_numpy()[owner] for c in ("doc", "u"))
                k = k & ((1 << 48) - 1)
                what = (context & ((1 << 46) - 1)) << 14 | n << 7 | rel
                order = np.lexsort((s, u, doc, what, k))
                s, k, what, doc, u = (x[order] for x in (s, k, what, doc, u))
                again = np.concatenate([np.zeros(min(1, len(k)), bool), (k[1:] == k[:-1]) & (what[1:] == what[:-1])])
                first = np.flatnonzero(~again)
                many = np.diff(np.append(first, len(k))) > 1
                asked = many | may[k[first] & (len(may) - 1)]
                first, many = first[asked], many[asked]
                places = zip(doc[first].tolist(), u[first].tolist(), s[first].tolist(), strict=True)
                for at, key, place, several in zip(first.tolist(), zip(k[first].tolist(), what[first].tolist(), strict=True), places, many.tolist(), strict=True):
                    known = seen.get(key)
                    if known is not None and known < place:
                        again[at] = True
                    elif known is not None or several and len(seen) < REMEMBERED:
                        seen[key] = place
                        may[key[0] & (len(may) - 1)] = True
                yield _batch(RUNS_SCHEMA, np.where(again, doc * 31 + s, k), np.where(again, what + np.int64(-(1 << 63)), what), doc, u, s)

    return texts.mapInArrow(run, RUNS)


SPANS = pa.schema([("kind", pa.int8()), ("k", pa.int64()), ("doc", pa.int64()), ("u", pa.int64()), ("s", pa.int64()), ("n", pa.int32()), ("rel", pa.int32())])
SPAN_TYPES = "kind byte, k long, doc long, u long, s long, n int, rel int"
REPEAT, COMPARE, SPREAD = 0, 1, 2


def sorted_out(runs: DataFrame, parts: int) -> DataFrame:
    """(kind, k, doc, u, s, n, rel): runs that repeat an earlier equal one, and the first ones of anchors with several, to be compared.

    The runs come sorted; a task holds those of one anchor, up to MANY, and goes through the rest as they come.
    """
    dealt = runs.repartition(parts, "k").sortWithinPartitions("k", "what", "doc", "u", "s")

    def run(batches):
        held = None
        last_k = last_what = many_k = None
        for batch in batches:
            k, what, doc, u, s = (batch.column(c).to_numpy() for c in RUNS_SCHEMA.names)
            if not len(k):
                continue
            same = np.concatenate([[k[0] == last_k and what[0] == last_what], (k[1:] == k[:-1]) & (what[1:] == what[:-1])])
            repeat = same | (what < 0)
            last_k, last_what = k[-1], what[-1]
            n, rel = what >> 7 & 127, what & 127
            if repeat.any():
                yield _batch(SPANS, np.full(int(repeat.sum()), REPEAT, np.int8), k[repeat], doc[repeat], u[repeat], s[repeat], n[repeat].astype(np.int32), rel[repeat].astype(np.int32))
            rows = np.stack([k, doc, u, s, n, rel], 1)[~repeat]
            held = rows if held is None else np.concatenate([held, rows])
            if not len(held):
                continue
            first = _firsts(held)
            yield from _kinds(held[: first[-1]], many_k)
            held = held[first[-1] :]
            if len(held) > MANY or held[0, 0] == many_k:
                many_k = held[0, 0]
                yield from _kinds(held, many_k)
                held = held[:0]
        if held is not None and len(held):
            yield from _kinds(held, many_k)

    return dealt.mapInArrow(run, SPAN_TYPES)


def _firsts(rows: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), rows[1:, 0] != rows[:-1, 0]]))


def _kinds(rows: np.ndarray, many_k) -> Iterator[pa.RecordBatch]:
    """Runs of whole anchors, or of a part of many_k's; those alone in their anchor are left out."""
    first = _firsts(rows)
    sizes = np.diff(np.append(first, len(rows)))
    many = np.repeat(sizes > MANY, sizes) | (rows[:, 0] == many_k if many_k is not None else np.zeros(len(rows), bool))
    keep = many | np.repeat(sizes > 1, sizes)
    rows, kind = rows[keep], np.where(many[keep], SPREAD, COMPARE).astype(np.int8)
    if len(rows):
        yield _batch(SPANS, kind, rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 4].astype(np.int32), rows[:, 5].astype(np.int32))


def with_lists(texts: DataFrame, spans: DataFrame, entry: list[str], rest: bool) -> tuple[DataFrame, DataFrame]:
    """texts with each document's list of spans, and the table of the lists; documents without any stay, with a null list, if rest is true.

    The ids of documents with spans are broadcast while they are at most BROADCAST_IDS, so that only those
    documents' texts are shuffled.
    """
    lists = written(spans.groupBy("doc", "u").agg(F.collect_list(F.struct(*entry)).alias("list")), "lists")
    if lists.count() > BROADCAST_IDS:
        return texts.join(lists, ["doc", "u"], "left" if rest else "inner"), lists
    ids = F.broadcast(lists.select("doc", "u"))
    some = texts.join(ids, ["doc", "u"], "left_semi").join(lists, ["doc", "u"])
    others = texts.join(ids, ["doc", "u"], "left_anti").withColumn("list", F.lit(None).cast(lists.schema["list"].dataType))
    return some.unionByName(others) if rest else some, lists


def bodies(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(kind, k, doc, u, s, n, rel, body): each run with its bytes."""
    both, _ = with_lists(texts, spans, ["kind", "k", "s", "n", "rel"], rest=False)
    schema = pa.schema([*SPANS, ("body", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in _parts(batch, "__text", CHUNK):
                rows = []
                for doc, u, text, spans in zip(*(part.column(c).to_pylist() for c in ("doc", "u", "__text", "list")), strict=True):
                    rows += ((x["kind"], x["k"], doc, u, x["s"], x["n"], x["rel"], text[x["s"] : x["s"] + x["n"] + WINDOW - 1]) for x in spans)
                yield _batch(schema, *zip(*rows, strict=True))

    return both.select("doc", "u", "__text", "list").mapInArrow(run, SPAN_TYPES + ", body binary")


#: Windows of a run are taken by this many places of their start relative to the anchor.
CORE = 12
#: Bytes that all windows of such a block have in common.
COMMON = WINDOW - CORE + 1


def cores(n: int, rel: int, body: bytes) -> Iterator[tuple[tuple[int, bytes], int, int, int]]:
    """((block, bytes), first window, last window, place of the bytes) of a run's windows, by blocks of CORE places of their start relative to the anchor.

    All windows of a block have the bytes in common that lie in the first and the last of them; so equal
    windows are in blocks with the same bytes.
    """
    # windows start rel, rel - 1, ... rel - n + 1 places before the anchor
    for block in range((rel - n + 1) // CORE, rel // CORE + 1):
        far, near = block * CORE + CORE - 1, block * CORE  # places before the anchor, of the first and the last
        yield (block, body[rel - near : rel - far + WINDOW]), max(0, rel - far), min(n - 1, rel - near), rel - near


def shared_parts(group: list[tuple]) -> list[tuple]:
    """Parts (doc, u, s, n, at, body) of an anchor's runs (doc, u, s, n, rel, body) that may have equals in another one: blocks whose core, at at, another run has too."""
    seen: dict[tuple, int] = {}
    pieces = []
    for run in group:
        own = list(cores(*run[3:]))
        for key, _, _, _ in own:
            seen[key] = seen.get(key, 0) + 1
        pieces.append(own)
    return [
        (doc, u, s + first, last - first + 1, at - first, body[first : last + WINDOW])
        for (doc, u, s, _, _, body), own in zip(group, pieces, strict=True)
        for key, first, last, at in own
        if seen[key] > 1
    ]


def later_windows(rows: list[tuple]) -> np.ndarray:
    """(doc, u, start) of the windows of rows (doc, u, s, n, at, body) that equal an earlier one of them, by a suffix array.

    The COMMON bytes at at are in all windows of a row, and become one symbol; so each window has CORE symbols.
    """
    text: list[int] = []
    names: dict[bytes, int] = {}
    for _, _, _, _, at, body in rows:
        text += body[:at]
        text.append(names.setdefault(body[at : at + COMMON], 256 + len(names)))
        text += body[at + COMMON :]
    doc, u, s, n = np.array([row[:4] for row in rows], np.int64).reshape(-1, 4).T
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    where = np.repeat(np.cumsum(n + CORE - 1) - (n + CORE - 1), n) + step
    keys = np.stack([np.repeat(doc, n), np.repeat(u, n), np.repeat(s, n) + step], 1)
    number = np.full(len(text), -1)
    number[where] = np.arange(len(where))
    order = number[np.array(suffix_array(text), np.int64)]
    order = order[order >= 0]
    views = np.lib.stride_tricks.sliding_window_view(np.array(text, np.int32), CORE)
    new = np.ones(len(order), bool)
    for k in range(1, len(order), 1 << 14):
        part = order[k - 1 : k + (1 << 14)]
        rows_ = views[where[part]]
        new[k : k + len(part) - 1] = (rows_[1:] != rows_[:-1]).any(1)
    group = np.cumsum(new)
    by = np.lexsort((keys[order, 2], keys[order, 1], keys[order, 0], group))
    later = by[np.concatenate([[False], group[by][1:] == group[by][:-1]])]
    return keys[order[later]]


def compared(runs: DataFrame, parts: int) -> DataFrame:
    """(doc, u, s, n): windows of the runs of an anchor that equal an earlier one's. Runs with at are parts that have a core in common already."""
    whole = "rel" in runs.columns
    names = ["k", "doc", "u", "s", "n", "rel" if whole else "at", "body"]
    dealt = runs.select(*names).repartition(parts, "k").sortWithinPartitions("k", "doc", "u", "s")
    schema = pa.schema([("doc", pa.int64()), ("u", pa.int64()), ("s", pa.int64()), ("n", pa.int32())])

    def run(batches):
        group: list = []
        ready: list = []
        size = 0
        last = None
        for batch in batches:
            for k, *row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if k != last:
                    group = shared_parts(group) if whole else group
                    ready += group
                    size += sum(x[3] + CORE - 1 for x in group)
                    if size > SORTED:
                        yield _batch(schema, *_joined(later_windows(ready)))
                        ready, size = [], 0
                    group, last = [], k
                group.append(row)
        ready += shared_parts(group) if whole else group
        if ready:
            yield _batch(schema, *_joined(later_windows(ready)))

    return dealt.mapInArrow(run, "doc long, u long, s long, n int")


def spread(runs: DataFrame, parts: int) -> DataFrame:
    """As compared(), for anchors with more than MANY runs.

    Runs are cut into parts by their cores, and parts with the same core are a group, as the runs of a
    smaller anchor are, which the suffix array sorts. Where more than PIECES parts have one core, their
    windows differ in a few places at their ends alone, and are compared one by one.
    """
    import struct

    schema = pa.schema([("k", pa.int64()), ("doc", pa.int64()), ("u", pa.int64()), ("s", pa.int64()), ("n", pa.int32()), ("at", pa.int32()), ("body", pa.binary())])

    def cut(batches):
        import hashlib

        for batch in batches:
            rows = []
            for k, doc, u, s, n, rel, body in zip(*(batch.column(c).to_pylist() for c in ("k", "doc", "u", "s", "n", "rel", "body")), strict=True):
                for (block, core), first, last, at in cores(n, rel, body):
                    name = hashlib.blake2b(core, digest_size=8, key=struct.pack("<qi", k, block)).digest()
                    rows.append((struct.unpack("<q", name)[0], doc, u, s + first, last - first + 1, at - first, body[first : last + WINDOW]))
                if len(rows) > 4_096:
                    yield _batch(schema, *zip(*rows, strict=True))
                    rows = []
            if rows:
                yield _batch(schema, *zip(*rows, strict=True))

    pieces = written(runs.select("k", "doc", "u", "s", "n", "rel", "body").mapInArrow(cut, "k long, doc long, u long, s long, n int, at int, body binary"), "pieces")
    counts = written(pieces.groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "cores")
    keyed = pieces.withColumnsRenamed({"k": "key", "n": "windows"})
    several = join_groups(keyed, counts, counts.count(), hot_rows(pieces.count()), "inner", by=("doc", "u", "s"))
    several = written(several.select(F.col("key").alias("k"), "doc", "u", "s", F.col("windows").alias("n"), "at", "body", (F.col("n") > PIECES).alias("many")), "several")
    found = written(compared(several.where("NOT many").drop("many"), parts), "compared")
    if several.where("many").take(1):
        found = found.unionByName(spread_windows(several.where("many")))
    return found


def _joined(keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring starts of a document as (doc, u, first start, how many)."""
    keys = keys[np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))] if len(keys) else np.zeros((0, 3), np.int64)
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), (keys[1:, :2] != keys[:-1, :2]).any(1) | (keys[1:, 2] != keys[:-1, 2] + 1)]))
    return keys[new, 0], keys[new, 1], keys[new, 2], np.diff(np.append(new, len(keys))).astype(np.int32)


def spread_windows(runs: DataFrame) -> DataFrame:
    """As compared(), for groups of any size: equal windows meet by their bytes, first ones are found by an aggregate.

    The aggregate combines before the shuffle, and a window's later places are spread over tasks.
    """
    schema = pa.schema([("key", pa.binary()), ("doc", pa.int64()), ("u", pa.int64()), ("s", pa.int64())])

    def windows(batches):
        for batch in batches:
            doc, u, s, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("doc", "u", "s", "n"))
            if not len(n):
                continue
            data = b"".join(batch.column("body").to_pylist())
            begin = np.cumsum(n + WINDOW - 1) - (n + WINDOW - 1)
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(begin, n) + step
            yield _batch(schema, [data[k : k + WINDOW] for k in at.tolist()], np.repeat(doc, n), np.repeat(u, n), np.repeat(s, n) + step)

    every = written(runs.select("doc", "u", "s", "n", "body").mapInArrow(windows, "key binary, doc long, u long, s long"), "windows")
    place = F.struct("doc", "u", "s")
    first = written(every.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "first")
    both = join_groups(every, first, first.count(), hot_rows(every.count()), "inner", by=("doc", "u", "s"))
    return both.where(place != F.col("first")).select("doc", "u", "s", F.lit(1).alias("n"))


def merged_spans(sizes: np.ndarray, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts of so many bytes, with lists of (s, n) of their windows: how many maximal spans each has, and the begins and ends of all of them, text by text."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    s, n = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.flatten().flatten())
    owner = np.repeat(np.arange(len(sizes)), counts)
    base = np.cumsum(sizes + 1) - sizes - 1  # with a gap, so that spans of two texts don't touch
    s += base[owner]
    order = np.argsort(s, kind="stable")
    s, owner, reach = s[order], owner[order], np.maximum.accumulate((s + n + WINDOW - 1)[order])
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(s)), bool), s[1:] > reach[:-1]]))
    last = np.append(first[1:] - 1, len(s) - 1)[: len(first)]
    return np.bincount(owner[first], minlength=len(sizes)), s[first] - base[owner[first]], reach[last] - base[owner[first]]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for.

    A byte goes if a string of WINDOW bytes that covers it also starts earlier: in a document of
    smaller id, or earlier in its own. Null text counts as empty. A null id is smaller than all others;
    rows that repeat an id are documents of their own, in an order that follows from their places. Other columns are
    ignored; an empty table gives no rows. Anchors and equal runs go by 64-bit hashes.
    """
    bounded_batches(docs.sparkSession)
    twice = docs.groupBy(id_col).count().where(F.col(id_col).isNull() | (F.col("count") > 1)).limit(1).count()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if twice:
        docs = placed(docs, "located").select("row.*", F.xxhash64("file", "at").alias("u"))
    else:
        docs = docs.withColumn("u", F.lit(0).cast("long"))
    texts = docs.select(F.coalesce(F.col("id"), F.lit(NO_ID)).alias("doc"), "u", F.coalesce("text", F.lit("")).cast("binary").alias("__text"))
    if twice:
        texts = written(texts, "texts")
    size = docs.agg(F.sum(F.octet_length(F.coalesce(F.col("text"), F.lit(""))))).first()[0] or 0
    parts = int(size // (24 << 20)) + 1
    with scratch() as made:
        spans = written(sorted_out(anchor_runs(texts), parts), "spans")
        open_runs = spans.where(F.col("kind") != REPEAT)
        runs = written(bodies(texts, open_runs), "runs")
        found = spans.where(F.col("kind") == REPEAT).select("doc", "u", "s", "n").unionByName(written(compared(runs.where(F.col("kind") == COMPARE), parts), "compared"))
        if runs.where(F.col("kind") == SPREAD).take(1):
            found = found.unionByName(spread(runs.where(F.col("kind") == SPREAD), parts))
        both, lists = with_lists(texts, found, ["s", "n"], rest=True)
    forget(*(t for t in made if t is not lists))
    schema = f"{id_col} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text

    def run(batches):
        import hashlib

        for batch in batches:
            for part in _parts(batch, "__text", CHUNK):
                texts, docs = part.column("__text").to_pylist(), part.column("doc").to_pylist()
                n_spans, begin, end = merged_spans(np.fromiter(map(len, texts), np.int64, len(texts)), part.column("list"))
                spans = zip(begin.tolist(), end.tolist(), strict=True)
                out = []
                for doc, text, n in zip(docs, texts, n_spans.tolist(), strict=True):
                    rest = text
                    if n:
                        kept, at = [], 0
                        for s, stop in itertools.islice(spans, n):
                            kept.append(text[at:s])
                            at = stop
                        rest = b"".join([*kept, text[at:]])
                    out.append([None if doc == NO_ID else doc, len(text), len(text) - len(rest), n, hashlib.sha256(rest).hexdigest(), *([rest] if keep_text else [])])
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)], names[: len(out[0])])

    return both.select("doc", "__text", "list").mapInArrow(run, schema)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents"))
