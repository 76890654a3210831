"""Approximate nearest neighbours by cosine: a forest of random-projection trees with one priority queue a query, leaves reranked exactly.

1. Equal vectors become one point with its smallest ids, so that copies fill no leaf.
2. Trees are fitted on a bounded sample: a node parts its rows at the median of their projections
   on the difference of two of them. All points are then put into a leaf of each tree.
3. A query goes down all trees at once: one queue holds the branches not taken, of all trees, by
   how far the query is from them, and the nearest is opened until the leaves met hold a share of all points.
4. That share is measured, not set: for some queries the true neighbours are found by brute force, and the
   share is the least that reaches the wanted part of them.
5. Leaves and the queries that visit them meet by a shuffle, and cosines are computed exactly.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import bounded_batches, forget, load, written

NEAREST = 5
TREES = 4
#: Numbers of the sample that trees are fitted on, as rows of so many dimensions; and rows at most.
FIT_VALUES, FIT_ROWS = 1 << 21, 20_000
#: Rows of the sample in a leaf, at most, where projections part them.
LEAF = 160
#: Queries whose true neighbours are found by brute force.
MEASURED = 256
#: The part of their neighbours that the share of points visited must reach; what is asked for is 0.9.
RECALL = 0.95
#: Points of a leaf, and queries that visit it, in one task's group; more are dealt to several.
POINTS, VISITS = 4_096, 16_384
#: Numbers in such points, at most.
POINT_VALUES = 1 << 20
#: Queries that a task scores at a time.
TOGETHER = 256
#: Scores closer than this are ordered by sums made one way for all.
CLOSE = 1e-9


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays: a direction and a threshold each; children are nodes, or leaves as -1 - leaf."""

    direction: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray
    leaves: int


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / lengths(vectors)[:, None]


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(1))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, exactly, so that squares neither overflow nor vanish; cosines stay."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


def grown(rows: np.ndarray, seed: int, leaf: int = LEAF) -> Tree:
    """A tree over unit vectors."""
    rng = np.random.default_rng(seed)
    direction, threshold, below, above = [], [], [], []
    leaves = 0

    def put(parent: int, side: list[int], value: int) -> None:
        if parent >= 0:
            side[parent] = value

    todo = [(np.arange(len(rows)), -1, below)]
    while todo:
        at, parent, side = todo.pop()
        cut = None
        if len(at) > leaf:
            for _ in range(4):
                i, j = rng.choice(at, 2, replace=False)
                line = rows[i] - rows[j]
                where = rows[at] @ line
                middle = float(np.median(where))
                up = where > middle
                if up.any() and not up.all():
                    size = np.sqrt(line @ line)
                    cut = line / size, middle / size, up
                    break
        if cut is None:
            put(parent, side, -1 - leaves)
            leaves += 1
            continue
        node = len(direction)
        put(parent, side, node)
        direction.append(cut[0])
        threshold.append(cut[1])
        below.append(0)
        above.append(0)
        todo += [(at[~cut[2]], node, below), (at[cut[2]], node, above)]
    d = rows.shape[1]
    return Tree(np.array(direction).reshape(-1, d), np.array(threshold), np.array(below, np.int64), np.array(above, np.int64), leaves)


def leaf_of(tree: Tree, rows: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    out = np.full(len(rows), 0 if len(tree.threshold) else -1, np.int64)
    while (inner := np.flatnonzero(out >= 0)).size:
        node = out[inner]
        where = np.einsum("ij,ij->i", rows[inner], tree.direction[node])
        out[inner] = np.where(where > tree.threshold[node], tree.above[node], tree.below[node])
    return -1 - out


def visited(forest: list[Tree], sizes: list[np.ndarray], row: np.ndarray, share: float, least: int):
    """(tree, leaf, points so far) in the order of one queue of all trees, until they hold a share of all points, and some tree least of them.

    A branch's priority is the largest distance of the row from a cut between them, the bound of its distance to all of the branch.
    """
    margin = [tree.direction @ row - tree.threshold for tree in forest]
    queue = [(0.0, t, 0 if len(tree.threshold) else -1) for t, tree in enumerate(forest)]
    each = [0] * len(forest)
    goal = share * sum(int(s.sum()) for s in sizes) / max(1, len(forest))
    total = 0
    while queue and (total < goal or max(each) < least):
        far, t, node = heapq.heappop(queue)
        while node >= 0:
            m = margin[t][node]
            near, other = (forest[t].above[node], forest[t].below[node]) if m > 0 else (forest[t].below[node], forest[t].above[node])
            heapq.heappush(queue, (max(far, abs(m)), t, int(other)))
            node = near
        leaf = int(-1 - node)
        total += int(sizes[t][leaf])
        each[t] += int(sizes[t][leaf])
        yield t, leaf, total


def needed_share(forest: list[Tree], sizes: list[np.ndarray], queries: np.ndarray, neighbours: list[list[list[int]]], recall: float) -> tuple[float, float]:
    """The least share whose visits meet the wanted part of the queries' neighbours, given as their leaves in each tree; and the part that it meets."""
    n = max(1, int(sizes[0].sum()))
    needs = []
    for row, found in zip(queries, neighbours, strict=True):
        at = {}
        for t, leaf, total in visited(forest, sizes, row, float("inf"), 0):
            at[t, leaf] = total
        needs += [min(at[t, leaf] for t, leaf in enumerate(leaves)) / n for leaves in found]
    if not needs:
        return 1.0, 1.0
    needs.sort()
    share = needs[min(len(needs) - 1, int(np.ceil(recall * len(needs))) - 1)]
    return share, sum(x <= share for x in needs) / len(needs)


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null or non-finite entries, and one that isn't 0."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda c: c != 0)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return scaled(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of pairs of rows, summed in one way whatever lies beside them."""
    return (a * b).sum(1)


def _best(queries: np.ndarray, points: np.ndarray, ids: list[list], own: list, k: int) -> tuple[list[int], list[int], list, list[float]]:
    """(query, point, id, score) of the k best ids of each query among points, without the query's own row."""
    q_len, p_len = lengths(queries), lengths(points)
    unit_points = points / p_len[:, None]
    out: tuple[list[int], list[int], list, list[float]] = ([], [], [], [])
    for at in range(0, len(queries), TOGETHER):
        close = (queries[at : at + TOGETHER] / q_len[at : at + TOGETHER, None]) @ unit_points.T
        # the own point may be among them
        take = min(k + 1, len(points))
        edge = np.partition(close, len(points) - take, axis=1)[:, len(points) - take]
        rows, cols = np.nonzero(close >= edge[:, None] - CLOSE)
        exact = _dots(queries[at + rows], points[cols]) / (q_len[at + rows] * p_len[cols])
        cuts = np.searchsorted(rows, np.arange(len(close) + 1)).tolist()
        for row in range(len(close)):
            each = []
            for x in range(cuts[row], cuts[row + 1]):
                j = int(cols[x])
                left = list(ids[j])
                if own[at + row] in left and (points[j] == queries[at + row]).all():
                    left.remove(own[at + row])
                each += [(-float(exact[x]), i is None, i or 0, j, i) for i in left]
            for s, _, _, j, i in sorted(each, key=lambda x: x[:3])[:k]:
                for column, value in zip(out, (at + row, j, i, -s), strict=True):
                    column.append(value)
    return out


def _ranked(scores: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _brute(points: DataFrame, queries: list, d: int, k: int) -> DataFrame:
    """(qno, vec_id, score, leaves): the k best of all points for each of some queries, by every task and over all of them."""
    matrix, own = _rows([q["v"] for q in queries], d), [q["query_id"] for q in queries]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                who, at, found, score = _best(matrix, _matrix(batch.column("v"), d), batch.column("ids").to_pylist(), own, k)
                leaves = batch.column("leaves").take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.float64()), leaves], ["qno", "vec_id", "score", "leaves"])

    schema = "qno long, vec_id long, score double, leaves array<int>"
    return _ranked(points.select("v", "ids", "leaves").mapInArrow(run, schema), ["qno"], k)


def _rows(vectors: list, d: int) -> np.ndarray:
    return scaled(np.array(vectors, dtype=np.float64).reshape(-1, d)) if vectors else np.zeros((0, d))


def nearest(embeddings: DataFrame, queries: Column, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, recall: float = RECALL, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score, recall: of each row that queries holds for, the k nearest rows found, all if fewer.

    queries is a condition on id_col, whose type is a whole number. Nearness is the cosine of the vectors as given, in double precision;
    equal scores go by the smaller id, null last. Rows of one id and one vector are one row. A query's own row is no candidate; other
    rows of its id or with an equal vector are. Rows take no part whose vector is null, empty or zero, has null or non-finite entries, or hasn't the most common length (the
    longest of equally common ones). An empty table or no queries give no rows. Other columns, of any name, are ignored.

    recall is what was measured by brute force on MEASURED queries: at least the wanted part, where the order by which branches are opened
    reaches it, as a share of 1 visits all leaves of a tree and so all points.
    """
    spark = embeddings.sparkSession
    bounded_batches(spark)
    schema = "query_id long, rank int, vec_id long, score double, recall double"
    made = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        made.append(written(df, label))
        return made[-1]

    base = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), queries.alias("ask")).where(usable(F.col("v")))
    common = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not common:
        return spark.createDataFrame([], schema)
    d = common[0]["d"]
    base = base.where(F.size("v") == d)
    # k others and the query's own
    first = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    points = base.select("id", "v").distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    points = kept(points.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.count_if(F.col("id").isNull()).alias("nulls")), "points")
    points = points.select("v", F.concat("ids", F.array_repeat(F.lit(None).cast("long"), F.col("nulls").cast("int"))).alias("ids"))
    asked = kept(base.where("ask").select(F.col("id").alias("query_id"), F.xxhash64("v").alias("of"), "v").distinct(), "asked")

    fit_rows = max(2 * leaf, min(FIT_ROWS, FIT_VALUES // d))
    sample = points.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(fit_rows).select("v").collect()
    rows = unit(_rows([r["v"] for r in sample], d))
    forest = [grown(rows, seed, leaf) for seed in range(trees)]

    def put(batches):
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column("v"), d))
                at = np.stack([leaf_of(tree, x) for tree in forest], 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(at), pa.list_(pa.int32()))], [*batch.schema.names, "leaves"])

    placed = kept(points.mapInArrow(put, T.StructType([*points.schema.fields]).add("leaves", T.ArrayType(T.IntegerType()))), "placed")
    counts = placed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()
    sizes = [np.zeros(tree.leaves, np.int64) for tree in forest]
    for r in counts:
        sizes[r["tree"]][r["leaf"]] = r["count"]

    some = asked.orderBy(F.xxhash64("query_id", "of"), "query_id").limit(MEASURED).collect()
    truth = _brute(placed, some, d, k).select("qno", "leaves").collect() if some else []
    neighbours: list[list[list[int]]] = [[] for _ in some]
    for r in truth:
        neighbours[r["qno"]].append(r["leaves"])
    share, reached = needed_share(forest, sizes, unit(_rows([q["v"] for q in some], d)) if some else np.zeros((0, d)), neighbours, recall)

    def visits(batches):
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column("v"), d))
                who, tree, at = [], [], []
                for j, row in enumerate(x):
                    for t, number, _ in visited(forest, sizes, row, share, k + 1):
                        who.append(j)
                        tree.append(t)
                        at.append(number)
                    if len(who) > 1 << 12:
                        yield _visit(batch, who, tree, at)
                        who, tree, at = [], [], []
                yield _visit(batch, who, tree, at)

    met = asked.repartition(_tasks(asked)).mapInArrow(visits, T.StructType([*asked.schema.fields]).add("tree", "integer").add("leaf", "integer"))
    met = kept(met, "visits")
    crowd = met.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / VISITS).cast("int").alias("shifts"))
    plan = placed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / max(64, min(POINTS, POINT_VALUES // d))).cast("int").alias("pieces"))
    # a row for each leaf of the forest, which is fitted on a bounded sample
    plan = F.broadcast(kept(plan.join(crowd, ["tree", "leaf"]), "leaf-groups"))
    none = F.lit(None)
    home = placed.select("v", "ids", F.posexplode("leaves").alias("tree", "leaf")).join(plan, ["tree", "leaf"])
    home = home.withColumn("piece", F.pmod(F.xxhash64("v"), F.col("pieces")).cast("int")).withColumn("shift", F.explode(F.sequence(F.lit(0), F.col("shifts") - 1)))
    home = home.select("tree", "leaf", "piece", "shift", F.lit(0).alias("kind"), none.cast("long").alias("query_id"), none.cast("long").alias("of"), "v", "ids")
    guest = met.join(plan, ["tree", "leaf"]).withColumn("shift", F.pmod(F.xxhash64("query_id", "of"), F.col("shifts")).cast("int")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    guest = guest.select("tree", "leaf", "piece", "shift", F.lit(1).alias("kind"), "query_id", "of", "v", none.cast("array<long>").alias("ids"))
    place = ["tree", "leaf", "piece", "shift"]
    dealt = home.unionByName(guest).repartition(*place).sortWithinPartitions(*place, "kind")

    def rerank(batches):
        now, points, ids = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in (*place, "kind")], 1)
            cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)])).tolist()
            for at, end in zip(cuts, [*cuts[1:], len(key)], strict=True):
                part, group = batch.slice(at, end - at), tuple(key[at, :4].tolist())
                if group != now:
                    now, points, ids = group, [], []
                if key[at, 4] == 0:
                    points.append(_matrix(part.column("v"), d))
                    ids += part.column("ids").to_pylist()
                elif points:
                    points = [np.concatenate(points)]
                    who, _, found, score = _best(_matrix(part.column("v"), d), points[0], ids, part.column("query_id").to_pylist(), k)
                    asks = part.select(["query_id", "of"]).take(pa.array(who, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*asks.columns, pa.array(found, pa.int64()), pa.array(score, pa.float64())], ["query_id", "of", "vec_id", "score"])

    found = kept(dealt.mapInArrow(rerank, "query_id long, of long, vec_id long, score double"), "candidates")
    # a pair may be met in several trees, with one score
    once = _ranked(found.distinct(), ["query_id", "of"], k)
    out = written(once.select("query_id", "rank", "vec_id", "score", F.lit(reached).alias("recall")), "nearest")
    forget(*made)
    return out


def _tasks(asked: DataFrame) -> int:
    return max(1, min(10_000, asked.count() // 64))


def _visit(batch: pa.RecordBatch, who: list[int], tree: list[int], leaf: list[int]) -> pa.RecordBatch:
    rows = batch.take(pa.array(who, pa.int64()))
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(tree, pa.int32()), pa.array(leaf, pa.int32())], [*batch.schema.names, "tree", "leaf"])


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
