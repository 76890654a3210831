"""Ranked lexical search: documents reordered by recursive graph bisection, a clustered index of them, shards visited by their bounds.

1. Each document becomes its distinct terms, as 64-bit hashes, with their counts.
2. Order: recursive bisection of the graph of documents and terms. Halves swap the documents that lower
   the cost of storing their terms' lists most. The first levels are fitted on a bounded sample and
   route all documents; every group that comes of it is then bisected as a whole, in a task.
3. A shard is a run of that order: one row, with its terms' lists of (document, impact), and for each term
   the number of its documents and its largest impact. The numbers of documents are the corpus's statistics.
4. An item's bound in a shard is the sum of its terms' weights and largest impacts. Items visit the shards of the
   highest bounds first, some more after that, and then all whose bounds reach the item's last place.
   A bound that equals it is visited too, for among equal scores the smaller doc_id goes first.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ngram_join import _mix, powers
from .shared import bounded_batches, forget, kept, load, written

BEST = 10
#: Documents, and terms of a document, that the first levels are fitted on; expected number, and most.
FIT_DOCS, FIT_TERMS = 4_096, 256
#: Levels that are fitted there, and buckets of terms' hashes.
LEVELS, HASH_BITS = 6, 15
#: Documents of a group that a task bisects, as expected from the sample; and what a group is cut at, documents and postings.
GROUP, MOST_DOCS, MOST_POSTINGS = 2_048, 4_096, 1_000_000
#: Documents and postings of a shard, at most; a document is never cut.
SHARD, SHARD_POSTINGS = 128, 400_000
#: Times that two halves swap, at most.
ROUNDS = 8
#: Shards that each item visits in the first rounds; what may still be better follows in the last.
VISITS = (4, 32)
#: Items, and different terms of theirs, that are ranked at a time.
ITEMS, TERMS = 500, 200_000
#: Impacts are at most this.
TOP = 1_000_000
#: Bytes of a text that are taken at a time.
LONG = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash of the term) of all terms, in order."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    up, down = powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)])])
    inside = np.concatenate([[False], _TERM[raw], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, stop = edge[::2], edge[1::2]
    text = np.searchsorted(np.cumsum(sizes + 1), begin, side="right")
    return text, _mix((total[stop] - total[begin]) * down[begin])


def term_counts(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct terms, as ascending hashes, and how often each occurs."""
    long = [k for k, t in enumerate(texts) if len(t) > LONG]
    short = [b"" if len(t) > LONG else t for t in texts]
    text, term = term_hashes(short)
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (term[1:] != term[:-1])])) if len(term) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(term)))
    text, term = text[new], term[new]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
    out = [(term[a:b], count[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for k in long:
        out[k] = _long_counts(texts[k])
    return out


def _long_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Those of a long text, from pieces that end between terms."""
    found = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    at = 0
    while at < len(text):
        gap = _BETWEEN.search(text, at + LONG)
        end = gap.start() if gap else len(text)
        more = np.unique(term_hashes([text[at:end]])[1], return_counts=True)
        term, code = np.unique(np.concatenate([found[0], more[0]]), return_inverse=True)
        found = term, np.bincount(code, np.concatenate([found[1], more[1]]), len(term)).astype(np.int64)
        at = end
    return found


def profiles(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, n, terms, counts) of each row: a hash of id and text, all its terms with repeats, the distinct ones' hashes (8 bytes each), how often each occurs (4)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumn("h", F.xxhash64("id", "text"))

    def run(batches):
        kept("lexical", None)
        for batch in batches:
            texts, at, size = batch.column("text").to_pylist(), 0, 0
            for k, t in enumerate(texts):
                size += len(t)
                if size > 1 << 20 or k + 1 == len(texts):
                    found = term_counts(texts[at : k + 1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).slice(at, k + 1 - at) for c in ("id", "h")),
                            pa.array([int(c.sum()) for _, c in found], pa.int64()),
                            pa.array([x.tobytes() for x, _ in found], pa.binary()),
                            pa.array([c.astype(np.uint32).tobytes() for _, c in found], pa.binary()),
                        ],
                        ["id", "h", "n", "terms", "counts"],
                    )
                    at, size = k + 1, 0

    return rows.mapInArrow(run, "id long, h long, n long, terms binary, counts binary")


def swapped_halves(sizes: np.ndarray, terms: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Which documents go to the second half. sizes: of each document's terms, which follow each other in terms.

    A term with l of a half's documents takes about l log(half / l) bits there. Of both halves, the documents
    that save most by a change go over in pairs, while a pair saves anything; then all is counted anew.
    """
    n = len(sizes)
    right = np.arange(n) >= (n + 1) // 2
    doc = np.repeat(np.arange(n), sizes)
    _, code, df = np.unique(terms, return_inverse=True, return_counts=True)
    again = df > 1  # a term of one document costs the same in either half
    doc, code = doc[again[code]], (np.cumsum(again) - 1)[code[again[code]]]
    every = df[again].astype(float)
    n_left, n_right = (n + 1) // 2, n // 2

    def cost(left, right):
        left, right = np.maximum(left, 0), np.maximum(right, 0)
        return left * np.log2(n_left / (left + 1)) + right * np.log2(n_right / (right + 1))

    for _ in range(rounds):
        there = right[doc]
        r = np.bincount(code[there], minlength=len(every))
        left = every - r
        now = cost(left, r)
        saves = np.where(there, (now - cost(left + 1, r - 1))[code], (now - cost(left - 1, r + 1))[code])
        gain = np.bincount(doc, saves, n)
        one, two = np.flatnonzero(~right), np.flatnonzero(right)
        one, two = one[np.argsort(-gain[one], kind="stable")], two[np.argsort(-gain[two], kind="stable")]
        pairs = min(len(one), len(two))
        k = int((gain[one[:pairs]] + gain[two[:pairs]] > 1e-9).sum())
        if not k:
            break
        right[one[:k]], right[two[:k]] = True, False
    return right


def _postings(start: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Where the terms of some documents are."""
    own = sizes[docs]
    return np.repeat(start[docs] - np.cumsum(own) + own, own) + np.arange(int(own.sum()))


def bisected(sizes: np.ndarray, terms: np.ndarray, most: int = SHARD, postings: int = SHARD_POSTINGS) -> list[np.ndarray]:
    """Documents in an order by recursive bisection, as runs of at most so many documents and postings."""
    start = np.cumsum(sizes) - sizes
    least = np.array([int(terms[a]) if s else 0 for a, s in zip(start.tolist(), sizes.tolist(), strict=True)], np.uint64)
    todo, out = [np.argsort(least, kind="stable")], []  # copies begin beside each other
    while todo:
        docs = todo.pop()
        if len(docs) < 2 or len(docs) <= most and sizes[docs].sum() <= postings:
            out.append(docs)
            continue
        right = swapped_halves(sizes[docs], terms[_postings(start, sizes, docs)])
        todo += [docs[right], docs[~right]]
    return out


@dataclass(frozen=True)
class Routes:
    """A tree of the first levels: each node's weights of buckets of terms, and the threshold of their sum; children of node k are 2k+1 and 2k+2."""

    levels: int
    weights: np.ndarray
    thresholds: np.ndarray
    shares: np.ndarray

    def leaf(self, sizes: np.ndarray, terms: np.ndarray) -> np.ndarray:
        node = np.zeros(len(sizes), np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        bucket = (terms >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        for _ in range(self.levels):
            total = np.bincount(doc, self.weights[node[doc], bucket], len(sizes))
            node = 2 * node + 1 + (total > self.thresholds[node])
        return node - ((1 << self.levels) - 1)


def fitted_routes(sample: list[np.ndarray], levels: int = LEVELS) -> Routes:
    """Bisects a sample and keeps, for each node, how much a term speaks for the second half; each half of the sample is routed to half."""
    levels = min(levels, max(0, int(math.log2(max(1, len(sample) / 32)))))
    nodes = (1 << levels) - 1
    weights, thresholds = np.zeros((max(1, nodes), 1 << HASH_BITS), np.float32), np.zeros(max(1, nodes))
    sizes = np.array([len(x) for x in sample], np.int64)
    terms = np.concatenate([np.zeros(0, np.uint64), *sample])
    start = np.cumsum(sizes) - sizes
    held = {0: np.arange(len(sample))}
    for node in range(nodes):
        docs = held.pop(node)
        own = terms[_postings(start, sizes, docs)]
        right = swapped_halves(sizes[docs], own) if len(docs) > 1 else np.zeros(len(docs), bool)
        bucket = (own >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        there = np.repeat(right, sizes[docs])
        count = [np.bincount(bucket[side], minlength=1 << HASH_BITS) for side in (~there, there)]
        weights[node] = np.log((count[1] + 0.5) / (right.sum() + 1)) - np.log((count[0] + 0.5) / ((~right).sum() + 1))
        total = np.bincount(np.repeat(np.arange(len(docs)), sizes[docs]), weights[node][bucket], len(docs))
        thresholds[node] = np.median(total) if len(docs) else 0
        up = total > thresholds[node]
        held[2 * node + 1], held[2 * node + 2] = docs[~up], docs[up]
    shares = np.array([len(held[k]) for k in range(nodes, 2 * nodes + 1)]) / max(1, len(sample))
    return Routes(levels, weights, thresholds, shares)


@dataclass(frozen=True)
class Index:
    """Shards of a corpus with n documents that have terms, and all their terms' number."""

    shards: DataFrame
    n: int
    length: int


_SHARD = "shard long, terms binary, df binary, most binary, doc binary, impact binary, ids array<long>"


def impacts(count: np.ndarray, n: np.ndarray, corpus: int, length: int) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 8 m), with m from the number of the document's terms n."""
    wide = 75 * int(n.max(initial=0)) * corpus >= 1 << 63
    m = 25 + (75 * n.astype(object) * corpus // length).astype(np.int64) if wide else 25 + 75 * n * corpus // length
    count = count.astype(np.int64)
    return (1000 * TOP * count) // (1000 * count + 8 * m)


def _shards(first: int, rows: list[tuple], corpus: int, length: int, most: int) -> Iterator[pa.RecordBatch]:
    """The shards of a group of documents (id, n, terms, counts), numbered from first."""
    terms = [np.frombuffer(r[2], np.uint64) for r in rows]
    sizes = np.array([len(x) for x in terms], np.int64)
    every = np.concatenate(terms)
    counts = np.frombuffer(b"".join(r[3] for r in rows), np.uint32)
    n = np.array([r[1] for r in rows], np.int64)
    impact = impacts(counts, np.repeat(n, sizes), corpus, length)
    start = np.cumsum(sizes) - sizes
    for number, docs in enumerate(bisected(sizes, every, most)):
        at = _postings(start, sizes, docs)
        doc = np.repeat(np.arange(len(docs), dtype=np.uint16), sizes[docs])
        order = np.argsort(every[at], kind="stable")
        term, value, doc = every[at][order], impact[at][order], doc[order]
        new = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        df = np.diff(np.append(new, len(term)))
        blobs = [term[new], df.astype(np.uint32), np.maximum.reduceat(value, new).astype(np.uint32), doc, value.astype(np.uint32)]
        ids = pa.array([[rows[k][0] for k in docs.tolist()]], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([first + number], pa.int64()), *(pa.array([b.tobytes()], pa.binary()) for b in blobs), ids], ["shard", "terms", "df", "most", "doc", "impact", "ids"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> Index:
    """The clustered index of docs, in a written table of a row for each shard.

    Null text counts as empty; documents without terms aren't in it. Ids are whole numbers; null and
    repeated ones stand for rows as any other. Other columns, of any name, are ignored; an empty table gives
    an index without shards. Whole texts count, long ones in pieces. Terms go by 64-bit hashes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    profile = profiles(docs, id_col, text_col)
    # texts are cut into terms twice, so that these needn't be stored: first for totals and the sample
    part = min(1.0, FIT_DOCS / max(1, docs.count()))
    drawn = F.when(F.pmod(F.xxhash64("h", F.lit(3)), F.lit(1 << 30)) < int(part * (1 << 30)), F.substring("terms", 1, 8 * FIT_TERMS))
    known = written(profile.where("n > 0").select("n", (F.octet_length("terms") / 8).alias("postings"), drawn.alias("drawn")), "sizes")
    totals = known.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length"), F.sum("postings").alias("postings")).first()
    corpus, length, postings = totals["docs"], int(totals["length"] or 0), int(totals["postings"] or 0)
    sample = known.where("drawn IS NOT NULL").select(F.col("drawn").alias("terms")).limit(2 * FIT_DOCS).collect()
    routes = fitted_routes([np.frombuffer(r["terms"], np.uint64) for r in sample])
    groups = max(corpus / GROUP, postings / (MOST_POSTINGS // 2))
    pieces = np.maximum(1, np.ceil(routes.shares * groups)).astype(np.int64)
    before = np.cumsum(pieces) - pieces
    all_routes = spark.sparkContext.broadcast(routes)
    placed = profile.where("n > 0")

    def routed(batches):
        found = all_routes.value
        for batch in batches:
            if batch.num_rows:
                # routed by what routes were fitted on: the terms of the smallest hashes
                terms = [t[: 8 * FIT_TERMS] for t in batch.column("terms").to_pylist()]
                sizes = np.fromiter((len(t) // 8 for t in terms), np.int64, len(terms))
                leaf = found.leaf(sizes, np.frombuffer(b"".join(terms), np.uint64))
                group = before[leaf] + batch.column("h").to_numpy() % pieces[leaf]
                yield pa.RecordBatch.from_arrays([pa.array(group), *(batch.column(c) for c in ("h", "id", "n", "terms", "counts"))], ["grp", "h", "id", "n", "terms", "counts"])

    def cut(batches):
        now, number, rows, size = None, 0, [], 0
        for batch in batches:
            for group, *row in zip(*(batch.column(c).to_pylist() for c in ("grp", "id", "n", "terms", "counts")), strict=True):
                if rows and (group != now or len(rows) >= MOST_DOCS or size >= MOST_POSTINGS):
                    yield from _shards((now << 32) + (number << 14), rows, corpus, length, shard)
                    number, rows, size = number + 1, [], 0
                if group != now:
                    now, number = group, 0
                rows.append(row)
                size += len(row[2]) // 8
        if rows:
            yield from _shards((now << 32) + (number << 14), rows, corpus, length, shard)

    dealt = placed.mapInArrow(routed, "grp long, h long, id long, n long, terms binary, counts binary")
    dealt = dealt.repartition(max(1, min(20_000, int(pieces.sum()))), "grp").sortWithinPartitions("grp", "h", "id")
    shards = written(dealt.mapInArrow(cut, _SHARD), "shards")
    forget(known)
    return Index(shards, corpus, length)


@dataclass(frozen=True)
class Block:
    """Some items: their numbers, all their terms, and for each term from where to where its items and their weights are."""

    numbers: list[int]
    terms: np.ndarray
    start: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    exact: bool

    def matched(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in terms, places in the block's terms) of those that both have."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        own = np.flatnonzero(self.terms[at] == terms) if len(self.terms) else np.zeros(0, np.int64)
        return own, at[own]

    def weights(self, at: np.ndarray) -> np.ndarray:
        """A matrix of items by the terms at those places; in doubles where all sums are exact."""
        sizes = self.start[at + 1] - self.start[at]
        where = np.repeat(self.start[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        out = np.zeros((len(self.numbers), len(at)), np.float64 if self.exact else np.int64)
        out[self.item[where], np.repeat(np.arange(len(at)), sizes)] = self.weight[where]
        return out


def _block(index: Index, items: list[tuple[int, np.ndarray, np.ndarray]]) -> Block:
    """Items (number, terms, counts) with their terms' weights, from the numbers of documents that the shards tell."""
    numbers = [number for number, _, _ in items]
    terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *(t for _, t, _ in items)]))

    def count(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for own, df in zip(batch.column("terms").to_pylist(), batch.column("df").to_pylist(), strict=True):
                own = np.frombuffer(own, np.uint64)
                at = np.searchsorted(own, terms)
                at[at == len(own)] = 0
                hit = own[at] == terms
                total[hit] += np.frombuffer(df, np.uint32)[at[hit]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    df = np.zeros(len(terms), np.int64)
    for r in index.shards.select("terms", "df").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * index.n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    term = np.concatenate([np.zeros(0, np.int64), *(np.searchsorted(terms, t) for _, t, _ in items)])
    item = np.repeat(np.arange(len(items)), [len(t) for _, t, _ in items])
    own = np.concatenate([np.zeros(0, np.int64), *(c.astype(np.int64) for _, _, c in items)]) * weight[term]
    most = int(np.bincount(item, own, len(items)).max(initial=0)) + 1
    order = np.argsort(term, kind="stable")
    start = np.searchsorted(term[order], np.arange(len(terms) + 1))
    return Block(numbers, terms, start, item[order], own[order], most * TOP < 1 << 52)


def _bounds(block: Block, terms: bytes, most: bytes) -> np.ndarray:
    """Each item's bound in a shard."""
    own, at = block.matched(np.frombuffer(terms, np.uint64))
    weights = block.weights(at)
    return (weights @ np.frombuffer(most, np.uint32)[own].astype(weights.dtype)).astype(np.int64)


def _scores(block: Block, row: dict, visit: np.ndarray) -> np.ndarray:
    """The scores of a shard's documents (columns) for the items in visit (rows)."""
    own, at = block.matched(np.frombuffer(row["terms"], np.uint64))
    weights = block.weights(at)[visit]
    df = np.frombuffer(row["df"], np.uint32).astype(np.int64)
    start = np.cumsum(df) - df
    where = _postings(start, df, own)
    table = np.zeros((len(own), len(row["ids"])), weights.dtype)
    table[np.repeat(np.arange(len(own)), df[own]), np.frombuffer(row["doc"], np.uint16)[where]] = np.frombuffer(row["impact"], np.uint32)[where]
    return (weights @ table).astype(np.int64)


def _order(ids: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i is None for i in ids], bool), np.array([0 if i is None else i for i in ids], np.int64)


def _visit(rows: DataFrame, block: Block, least: np.ndarray, k: int, done: dict[int, list[int]] | None) -> DataFrame:
    """(qno, doc_id, score): of each task's shards, the k best for each item, of at least its least score.

    rows have the items that visit a shard in visit; where done is given, all do whose bound reaches the least, but for those that
    have been there. What a task has found raises its own least scores.
    """

    def run(batches):
        reach = np.maximum(least, 1)
        best: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in block.numbers]
        for batch in batches:
            for row in batch.to_pylist():
                if done is None:
                    visit = np.array(sorted(row["visit"]), np.int64)
                    visit = visit[_bounds(block, row["terms"], row["most"])[visit] >= reach[visit]]
                else:
                    able = _bounds(block, row["terms"], row["most"]) >= reach
                    able[done.get(row["shard"], [])] = False
                    visit = np.flatnonzero(able)
                if not len(visit):
                    continue
                scores = _scores(block, row, visit)
                none, ids = _order(row["ids"])
                enough = scores >= reach[visit][:, None]
                for j in np.flatnonzero(enough.any(1)).tolist():
                    q, at = int(visit[j]), np.flatnonzero(enough[j])
                    s, x, i = (np.concatenate(p) for p in zip(best[q], (scores[j, at], none[at], ids[at]), strict=True))
                    order = np.lexsort((i, x, -s))[:k]
                    best[q] = s[order], x[order], i[order]
                    if len(order) == k:
                        reach[q] = max(reach[q], s[order[-1]])
        sizes = [len(s) for s, _, _ in best]
        score, none, ids = (np.concatenate([b[c] for b in best]) for c in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(block.numbers, np.int64), sizes)), pa.array(ids, mask=none), pa.array(score)], ["qno", "doc_id", "score"])

    return rows.mapInArrow(run, "qno long, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qno").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(index: Index, items: list[tuple[int, np.ndarray, np.ndarray]], k: int, visits: tuple[int, ...]) -> DataFrame:
    """(qno, rank, doc_id, score) of some items."""
    spark = index.shards.sparkSession
    block = _block(index, items)
    at = {number: j for j, number in enumerate(block.numbers)}

    def bounds(batches):
        for batch in batches:
            shard, item, bound = [], [], []
            for number, terms, most in zip(*(batch.column(c).to_pylist() for c in ("shard", "terms", "most")), strict=True):
                all_bounds = _bounds(block, terms, most)
                some = np.flatnonzero(all_bounds)
                shard.append(np.full(len(some), number))
                item.append(some)
                bound.append(all_bounds[some])
            if shard:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (shard, item, bound)], ["shard", "item", "bound"])

    # at most the last of visits rows for each item go on
    by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "shard")
    ranked = index.shards.select("shard", "terms", "most").mapInArrow(bounds, "shard long, item long, bound long")
    ranked = written(ranked.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= max(visits)), "bounds")
    least = np.zeros(len(items), np.int64)
    done: dict[int, list[int]] = {}
    found = None
    for low, high in zip((0, *visits), (*visits, None), strict=True):
        if high is None:
            rows = _visit(index.shards, block, least, k, done)
        else:
            here = ranked.where((F.col("place") > low) & (F.col("place") <= high))
            pairs = [(r["shard"], r["item"]) for r in here.select("shard", "item", "bound").collect() if r["bound"] >= least[r["item"]]]
            for shard, item in pairs:
                done.setdefault(shard, []).append(item)
            visit: dict[int, list[int]] = {}
            for shard, item in pairs:
                visit.setdefault(shard, []).append(item)
            if not visit:
                continue
            table = spark.createDataFrame(list(visit.items()), "shard long, visit array<long>")
            rows = _visit(index.shards.join(F.broadcast(table), "shard"), block, least, k, None)
        found = rows if found is None else found.unionByName(rows)
        found = written(_top(found, k).drop("rank"), "found")
        for r in found.groupBy("qno").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).collect():
            least[at[r["qno"]]] = r["least"]
    return written(_top(found, k).select("qno", "rank", "doc_id", "score"), "ranked")


def search(index: Index, items: DataFrame, k: int = BEST, id_col: str = "item_id", text_col: str = "text", visits: tuple[int, ...] = VISITS) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of items the k documents of highest scores above 0, all if fewer; equal scores by the smaller doc_id, null last.

    Null text counts as empty; items without terms, or whose terms are in no document, give no rows. Null and repeated
    item ids stand for rows as any other. Other columns, of any name, are ignored. Items are a stated set: they are
    ranked in blocks, of ITEMS rows or TERMS terms.
    """
    spark = items.sparkSession
    bounded_batches(spark)
    rows = profiles(items, id_col, text_col).where("n > 0").select("id", "terms", "counts")
    ids: list[int | None] = []
    block: list[tuple[int, np.ndarray, np.ndarray]] = []
    found = []

    def flush() -> None:
        if block:
            names = spark.createDataFrame([(number, ids[number]) for number, _, _ in block], "qno long, id long")
            found.append(_search_block(index, block, k, visits).join(F.broadcast(names), "qno"))
            block.clear()

    for r in rows.toLocalIterator():
        block.append((len(ids), np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["counts"], np.uint32)))
        ids.append(r["id"])
        if len(block) >= ITEMS or sum(len(t) for _, t, _ in block) >= TERMS:
            flush()
    flush()
    out = spark.createDataFrame([], "id long, rank int, doc_id long, score long") if not found else found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(F.col("id").alias(id_col), "rank", "doc_id", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(load(spark, sf_dir, "documents")), load(spark, sf_dir, "benchmark"))


_PLAIN = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_PLAIN}, '{_PATTERN}') AS t FROM documents),
  c AS (SELECT count(*) AS nd, CAST(sum(len(t)) AS BIGINT) AS nl FROM d WHERE len(t) > 0),
  o AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d),
  f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM o GROUP BY ALL),
  w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY term),
  i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_PLAIN}, '{_PATTERN}') AS t FROM benchmark),
  j AS (SELECT q, item_id, unnest(t) AS term FROM i),
  s AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // nl)))) AS BIGINT) AS score
    FROM j JOIN w USING (term) JOIN f USING (term), c GROUP BY ALL),
  k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""
