"""A digest of lines in their order: a tree of hashes over blocks of the sorted lines, the same on any number of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

#: Children of a node.
WIDTH = 1_024


def numbered(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """df with at, the number of each row in the order, from 0; rows that the order doesn't tell apart have any numbers of theirs.

    Rows are dealt out by ranges of the order and numbered in their range; ranges' sizes are added up, a number each.
    """
    n = parts or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = df.repartitionByRange(int(n), *order).sortWithinPartitions(*order)
    placed = cut(dealt.withColumn("__part", F.spark_partition_id()).withColumn("__in", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    sizes = placed.groupBy("__part").count()
    before = sizes.withColumn("__before", F.sum("count").over(Window.orderBy("__part")) - F.col("count")).drop("count")
    return placed.join(F.broadcast(before), "__part").withColumn("at", F.col("__before") + F.col("__in")).drop("__part", "__in", "__before")


def _joined(hashes: Column) -> Column:
    return F.sha2(F.array_join(hashes, ""), 256)


def ordered_hash(df: DataFrame, order: list[str], line: str, width: int = WIDTH, digits: int = 16, parts: int | None = None) -> DataFrame:
    """One row (n, content_hash): the number of lines, and the first digits of the root of a tree of SHA-256.

    Leaves are the lines' hashes, in the order; a node's hash is that of its children's, width of them, joined. The root is
    the single node of the first level that has one; of no lines it is the hash of nothing. A null line counts as
    empty; rows that order doesn't tell apart go by their lines, so the same lines in the same order give the same root however
    they lie, and a swap of two different lines changes it. A task holds one node's children.
    """
    text = F.coalesce(F.col(line).cast("string"), F.lit(""))
    leaves = df.select(*(F.col(c).alias(f"__o{k}") for k, c in enumerate(order)), F.sha2(text, 256).alias("h"))
    level = numbered(leaves, [*(f"__o{k}" for k in range(len(order))), "h"], parts).select("at", "h")
    n = count = level.count()
    while count > 1:
        node = F.floor(F.col("at") / width).cast("long")
        children = F.transform(F.array_sort(F.collect_list(F.struct("at", "h"))), lambda x: x["h"])
        level = cut(level.groupBy(node.alias("__node")).agg(_joined(children).alias("h")).withColumnRenamed("__node", "at"))
        count = -(-count // width)
    spark = df.sparkSession
    if not n:
        return spark.range(1).select(F.lit(0).cast("long").alias("n"), F.left(F.sha2(F.lit(""), 256), F.lit(digits)).alias("content_hash"))
    return level.select(F.lit(n).cast("long").alias("n"), F.left("h", F.lit(digits)).alias("content_hash"))
