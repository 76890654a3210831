"""Mixing sources to target weights: Pfair windows for blocks of rows, earliest deadline first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import literal, load, placed, written

#: Rows of a block. Halves of blocks are scheduled: less than two halves off the target is less than a block.
BLOCK_ROWS = 16
#: Slots of an epoch, which one task schedules by itself.
EPOCH = 4_096
#: A source without a weight has one of about so many parts.
PARTS = 1000
#: Target weights go with a source's rows to this power where none are given.
POWER = 0.7
#: Rows of a source that one task orders at a time.
BUCKET_ROWS = 2_000
#: Shares of sources in epochs that go into one plan at a time.
PLANNED = 20_000


def exact_parts(counts: dict[str, int], weights: dict[str, float] | None) -> dict[str, int]:
    """Whole numbers in the very proportions of the weights; a source without one has a PARTS-th of the others' sum."""
    shares = {s: Fraction(n**POWER if weights is None else weights.get(s, 0)) for s, n in counts.items()}
    none = sum(x for x in shares.values() if x > 0) / PARTS or Fraction(1)
    shares = {s: x if x > 0 else none for s, x in shares.items()}
    scale = math.lcm(*(x.denominator for x in shares.values()))
    return {s: int(x * scale) for s, x in shares.items()}


def bends(units: list[int], parts: list[int]) -> list[Fraction]:
    """Where on the line of slots each source ends, if all run side by side, each by its parts, until it has no units left."""
    out = [Fraction(0)] * len(units)
    gone, rest = 0, sum(parts)
    for i in sorted(range(len(units)), key=lambda i: (Fraction(units[i], parts[i]), i)):
        out[i] = gone + Fraction(units[i] * rest, parts[i])
        gone, rest = gone + units[i], rest - parts[i]
    return out


def epochs(units: dict[str, int], parts: dict[str, int], length: int = EPOCH) -> Iterator[tuple[int, int, list[tuple[str, int, int]]]]:
    """(first slot, slots, [(source, first unit, units)...]) of each epoch.

    All keep to a line: sources run side by side, each by its parts of what those have that still run, until it
    has no units left. An epoch ends after length slots and where the line bends, in the slots before and after the bend. At its end a
    source has had floor or ceil of its place on the line: what is due by then, and of the units that have begun but needn't be done, those
    with the earliest deadlines. All in whole numbers, so that nothing is rounded.

    Deadlines don't change on a clock that runs as the line does for one part, so a heap has each source's next unit: a short epoch
    costs as much as it has slots, a long one as much as sources run in it, and all together at most as much as there are units.
    """
    names = sorted(s for s, n in units.items() if n)
    n, w = [units[s] for s in names], [parts[s] for s in names]
    shift = max(90, max((x.bit_length() for x in w), default=0) + 20)
    ends = bends(n, w)
    marks = sorted({math.floor(x) for x in ends} | {math.ceil(x) for x in ends})
    order = sorted(range(len(names)), key=lambda i: (ends[i], i), reverse=True)
    had, live, gone, rest, at = [0] * len(names), set(range(len(names))), 0, sum(w), 0
    heap: list[tuple[int, int]] | None = None

    def due(i: int) -> tuple[int, int]:
        return ((had[i] + 1) << shift) // w[i], i

    for mark in marks:
        while at < mark:
            to = min(at + length, mark)
            was: dict[int, int] = {}
            while order and ends[order[-1]] <= to:
                i = order.pop()
                gone, rest = gone + n[i], rest - w[i]
                live.discard(i)
                if had[i] < n[i]:
                    was[i], had[i] = had[i], n[i]
            goal, taken = to - gone, sum(had[i] - k for i, k in was.items())
            if to - at < len(live) and heap is not None or to - at < len(live) // 4:
                if heap is None:
                    heap = [due(i) for i in live]
                    heapq.heapify(heap)
                aside = []
                # due ones first, then the earliest of those that have begun
                while heap and (heap[0][1] not in live or (had[heap[0][1]] + 1) * rest <= w[heap[0][1]] * goal or taken < to - at):
                    entry = heapq.heappop(heap)
                    i = entry[1]
                    if i not in live:
                        continue
                    if had[i] * rest >= w[i] * goal:
                        aside.append(entry)
                        continue
                    was.setdefault(i, had[i])
                    had[i] += 1
                    taken += 1
                    heapq.heappush(heap, due(i))
                for entry in aside:
                    heapq.heappush(heap, entry)
            else:
                heap, early = None, []
                for i in live:
                    now = max(had[i], w[i] * goal // rest)
                    if now > had[i]:
                        was[i], had[i] = had[i], now
                        taken += now - was[i]
                    if now * rest < w[i] * goal:
                        early.append(due(i))
                for _, i in heapq.nsmallest(to - at - taken, early):
                    was.setdefault(i, had[i])
                    had[i] += 1
                    taken += 1
            assert taken == to - at, "the units that are due and the slots don't agree"
            yield at, to - at, [(names[i], k, had[i] - k) for i, k in sorted(was.items())]
            at = to


SHARES = "array<struct<source:string,first:bigint,units:bigint>>"
_BITS = 20


def planned(spark: SparkSession, units: dict[str, int], parts: dict[str, int], length: int = EPOCH) -> DataFrame:
    """(at, slots, shares) of all epochs; a plan has PLANNED shares at most, or one epoch, and more go into a table. Each few epochs have a task of their own."""
    tables: list[DataFrame] = []
    chunk: list[tuple] = []
    n = size = 0
    schema = f"at bigint, slots bigint, shares {SHARES}"
    for at, slots, shares in epochs(units, parts, length):
        if chunk and size + len(shares) > PLANNED:
            tables.append(written(literal(spark, chunk, schema), "epochs"))
            chunk, size = [], 0
        chunk.append((at, slots, [{"source": s, "first": first, "units": k} for s, first, k in shares]))
        n, size = n + 1, size + len(shares)
    tables.append(literal(spark, chunk, schema))
    return reduce(DataFrame.unionByName, tables).repartition(max(1, min(n, 4_000)), "at")


def scheduled(epoch: DataFrame) -> DataFrame:
    """(source, unit, slot): a Pfair schedule of each epoch.

    In an epoch of n slots a source with k units has a share of k / n. Its unit j, from 0, may run from
    slot floor(j n / k) of the epoch and must run before ceil((j + 1) n / k); of the units that may run,
    the one with the earliest deadline does, the first source in order of names among equals. The shares
    add up to one, so each slot is used, all windows are met, and after any number of slots a source is
    less than one unit from its share of them.
    """
    n, code = F.col("slots"), F.lit(1 << _BITS)

    def step(state: Column, t: Column) -> Column:
        last = F.shiftright(F.get(state["out"], F.size(state["out"]) - 1), _BITS)

        def may_run(share: Column, i: Column) -> Column:
            done = F.get(state["done"], i) + F.when(i == last, 1).otherwise(0)
            release, due = F.floor(done * n / share["units"]), F.ceil((done + 1) * n / share["units"])
            return F.when((done < share["units"]) & (release <= t), F.struct(due.alias("due"), (i * code + done).alias("code")))

        had = F.transform(state["done"], lambda d, i: d + F.when(i == last, 1).otherwise(0))
        pick = F.array_min(F.transform("shares", may_run))["code"]
        return F.struct(had.alias("done"), F.concat(state["out"], F.array(pick)).alias("out"))

    start = F.struct(F.transform("shares", lambda x: F.lit(0).cast("bigint")).alias("done"), F.array().cast("array<bigint>").alias("out"))
    ran = epoch.select("at", "shares", F.posexplode(F.aggregate(F.sequence(F.lit(0).cast("bigint"), n - 1), start, step, lambda s: s["out"])).alias("t", "code"))
    share = F.get("shares", F.shiftright("code", _BITS).cast("int"))
    return ran.select(share["source"].alias("source"), (share["first"] + F.col("code").bitwiseAND((1 << _BITS) - 1)).alias("unit"), (F.col("at") + F.col("t")).alias("slot"))


def _order(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _mixed(docs: DataFrame, weights: dict[str, float] | None, id_col: str, source_col: str, seed: int, block_rows: int, length: int = EPOCH) -> DataFrame:
    """(id, source, source_row, block, slot, file, at) of placed() rows."""
    spark = docs.sparkSession
    half = max(1, block_rows // 2)
    base = docs.select(F.col("row")[id_col].alias("id"), F.coalesce(F.col("row")[source_col], F.lit("")).alias("source"), "file", "at").withColumn("h", _order("id", seed))
    counts = {r["source"]: r["count"] for r in base.groupBy("source").count().collect()}
    parts = exact_parts(counts, weights)
    sizes = literal(spark, [(s, -(-n // BUCKET_ROWS)) for s, n in counts.items()], "source string, buckets bigint")
    number = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    base = base.join(F.broadcast(sizes), "source").withColumn("bucket", F.shiftright(number * F.col("buckets"), 32)).drop("buckets")
    # a bucket is large only where an id repeats; then it is cut by the rows' places
    large = base.groupBy("source", "bucket").count().where(F.col("count") > 8 * BUCKET_ROWS)
    large = large.select("source", "bucket", F.ceil(F.col("count") / BUCKET_ROWS).alias("cuts"))
    base = base.join(large, ["source", "bucket"], "left").withColumn("cut", F.coalesce(F.pmod(F.xxhash64("file", "at"), F.col("cuts")), F.lit(0).cast("long"))).drop("cuts")
    place = ["source", "bucket", "cut"]
    before = base.groupBy(*place).count()
    before = before.withColumn("before", F.sum("count").over(Window.partitionBy("source").orderBy("bucket", "cut")) - F.col("count")).drop("count")
    ranked = base.withColumn("rank", F.row_number().over(Window.partitionBy(*place).orderBy("h", "id", "file", "at")) - 1)
    ranked = ranked.join(before, place).withColumn("source_row", (F.col("rank") + F.col("before")).cast("long"))
    ranked = ranked.withColumn("unit", F.floor(F.col("source_row") / half)).withColumn("block", F.floor(F.col("source_row") / block_rows))
    slots = scheduled(planned(spark, {s: -(-n // half) for s, n in counts.items()}, parts, length))
    # merged at every size: what a literal expands to has no size that a plan could tell
    return ranked.join(slots.hint("merge"), ["source", "unit"]).select("id", "source", "source_row", "block", "slot", "file", "at")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", seed: int = 17, block_rows: int = BLOCK_ROWS, length: int = EPOCH) -> DataFrame:
    """One row per row of docs: id, source, source_row, block, slot; the mix is in order of (slot, source_row).

    Rows of a source are ordered by a hash of seed and id and cut into blocks of block_rows. Halves of
    blocks are put into slots: epochs() settles how many of each source run in an epoch, scheduled() in
    which order. At every slot a source is less than a block from its place on the line that the weights
    draw: less than one half at an epoch's ends, and less than one more in between.

    Each row is used once: when a source ends, its share goes to the others. Where no weights are given, a
    source's is its number of rows to the power POWER; weights are used as they are. A source without a
    given weight has a PARTS-th of the others' sum.
    A null source counts as ''; null and repeated ids are rows as any other, next to each other but where
    there are very many; an empty table gives no rows; other columns, of any name, are ignored.

    Rows are ranked in buckets of hashes, of about BUCKET_ROWS rows however many a source has. The driver
    has one number for each source, and for each source and epoch as long as it plans.
    """
    found = _mixed(placed(docs.select(id_col, source_col), "located"), weights, id_col, source_col, seed, block_rows, length)
    return found.select(F.col("id").alias(id_col), "source", "source_row", "block", "slot")


def in_mixed_order(docs: DataFrame, rows_per_part: int = 6_000, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", seed: int = 17, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns of docs, whatever their names, dealt out and sorted in the mix's order."""
    whole = placed(docs, "located")
    order = _mixed(whole, weights, id_col, source_col, seed, block_rows)
    order = written(order.select("file", "at", "slot", "source_row"), "mix")
    n = max(1, order.count() // rows_per_part)
    # merged at every size: a broadcast of the order would be bounded by nothing
    dealt = whole.join(order.hint("merge"), ["file", "at"]).repartitionByRange(n, "slot", "source_row").sortWithinPartitions("slot", "source_row")
    return dealt.select("row.*")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(load(spark, sf_dir, "documents"))


_HALF = BLOCK_ROWS // 2
_EACH = "range(1, len(t) + 1)"
_ZEROS = "list_transform(t, lambda x: CAST(0 AS BIGINT))"
#: The same schedule from its definition: weights as whole numbers (a double's times 2 ** 52), where each source ends, what all have at
#: the ends of epochs, one after another, and then all epochs slot by slot. Lists have an entry for each source.
OP3_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source,
    row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS source_row
  FROM documents),
c AS (SELECT source, CAST((count(*) + {_HALF - 1}) // {_HALF} AS HUGEINT) AS n, CAST(power(count(*), {POWER}) * 4503599627370496 AS HUGEINT) AS w FROM d GROUP BY source),
o AS (SELECT a.source, a.n, a.w, CAST(sum(CASE WHEN b.n * a.w <= a.n * b.w THEN b.n ELSE 0 END) AS HUGEINT) AS before, CAST(sum(CASE WHEN b.n * a.w <= a.n * b.w THEN 0 ELSE b.w END) AS HUGEINT) AS beside FROM c a, c b GROUP BY ALL),
p AS (SELECT list(source ORDER BY source) AS s, list(CAST(n AS BIGINT) ORDER BY source) AS t, list(w ORDER BY source) AS q FROM o),
m AS (SELECT DISTINCT unnest([0, x // w, (x + w - 1) // w]) AS mark FROM (SELECT w, (before - n) * w + n * (beside + w) AS x FROM (
  SELECT source, n, w, CAST(sum(CASE WHEN earlier THEN bn ELSE 0 END) AS HUGEINT) + n AS before, CAST(sum(CASE WHEN earlier THEN 0 ELSE bw END) AS HUGEINT) - w AS beside
  FROM (SELECT a.source, a.n, a.w, b.n AS bn, b.w AS bw, b.n * a.w < a.n * b.w OR (b.n * a.w = a.n * b.w AND b.source < a.source) AS earlier FROM c a, c b) GROUP BY source, n, w))),
g AS (SELECT row_number() OVER (ORDER BY begin) - 1 AS k, begin, least(begin + {EPOCH}, mark2) AS goal, least(begin + {EPOCH}, mark2) - begin AS nslots
  FROM (SELECT mark2, unnest(range(CAST(mark AS BIGINT), CAST(mark2 AS BIGINT), {EPOCH})) AS begin FROM (SELECT mark, lead(mark) OVER (ORDER BY mark) AS mark2 FROM m) WHERE mark2 IS NOT NULL)),
e AS (SELECT k, begin, CAST(goal AS HUGEINT) AS goal, CAST(nslots AS BIGINT) AS nslots, CAST(sum(CASE WHEN ended THEN n ELSE 0 END) AS HUGEINT) AS gone, CAST(sum(CASE WHEN ended THEN 0 ELSE w END) AS HUGEINT) AS rest, list(ended ORDER BY source) AS ended
  FROM (SELECT *, before * w + n * beside <= goal * w AS ended FROM g, o) GROUP BY k, begin, goal, nslots),
r AS (
  SELECT CAST(-1 AS BIGINT) AS k, CAST(0 AS BIGINT) AS begin, CAST(0 AS BIGINT) AS nslots, {_ZEROS} AS had, {_ZEROS} AS firsts, {_ZEROS} AS shares FROM p
  UNION ALL
  SELECT k, begin, nslots, cur, had, list_transform({_EACH}, lambda i: cur[i] - had[i])
  FROM (
    SELECT *, list_transform({_EACH}, lambda i: low[i] + CASE WHEN list_contains(chosen, i) THEN 1 ELSE 0 END) AS cur FROM (
      SELECT *, list_transform(list_sort(list_transform(list_filter({_EACH}, lambda i: NOT ended[i] AND low[i] * rest < q[i] * (goal - gone)),
          lambda i: [(low[i] + 1) * CAST('1237940039285380274899124224' AS HUGEINT) // q[i], CAST(i AS HUGEINT)]))[1:CAST(goal - list_sum(low) AS BIGINT)], lambda x: x[2]) AS chosen FROM (
        SELECT e.*, r.had, p.t, p.q, list_transform(range(1, len(p.t) + 1), lambda i: CAST(CASE WHEN e.ended[i] THEN p.t[i] ELSE greatest(r.had[i], p.q[i] * (e.goal - e.gone) // e.rest) END AS BIGINT)) AS low
        FROM r JOIN e ON e.k = r.k + 1, p)))),
z AS (
  SELECT begin AS at_slot, nslots, firsts, shares, CAST(0 AS BIGINT) AS slot, list_transform(shares, lambda x: CAST(0 AS BIGINT)) AS done, CAST(0 AS BIGINT) AS pick FROM r WHERE k >= 0
  UNION ALL
  SELECT at_slot, nslots, firsts, shares, slot + 1, list_transform(range(1, len(done) + 1), lambda i: done[i] + CASE WHEN i = cur THEN 1 ELSE 0 END), cur FROM (
    SELECT *, list_min(list_transform(list_filter(range(1, len(done) + 1), lambda i: done[i] < shares[i] AND done[i] * nslots // nullif(shares[i], 0) <= slot),
      lambda i: [CAST(((done[i] + 1) * nslots + shares[i] - 1) // nullif(shares[i], 0) AS BIGINT), CAST(i AS BIGINT)]))[2] AS cur
    FROM z WHERE slot < nslots)),
b AS (SELECT pick, firsts[pick] + done[pick] - 1 AS unit, at_slot + slot - 1 AS slot FROM z WHERE slot > 0)
SELECT d.doc_id, d.source, d.source_row, d.source_row // {BLOCK_ROWS} AS block, b.slot
FROM d, p, b WHERE p.s[b.pick] = d.source AND b.unit = d.source_row // {_HALF}
"""
