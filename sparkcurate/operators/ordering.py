"""Order, sampling and top-k by hashes: results don't depend on how rows are dealt out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(seed: int, *ids: str | Column) -> Column:
    """A pseudo-random key from the seed and stable ids."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(i).cast("string") if isinstance(i, str) else i.cast("string") for i in ids)))


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keep_first_id(df: DataFrame, keys: list[str], order: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keys, order, keep) of each key's row with the least order: one aggregate, combined before the shuffle, so hot keys don't gather.

    Null keys are a key of their own, as any other value; a null order comes first, as in keep_first.
    One row a key comes out, also where its order repeats; then the least of the columns in keep.
    """
    if not keep:
        none = F.bool_or(F.col(order).isNull())
        return df.groupBy(*keys).agg(F.when(~none, F.min(order)).alias(order))
    first = F.min(F.struct(F.col(order).isNotNull().alias("__some"), F.col(order), *map(F.col, keep)))
    return df.groupBy(*keys).agg(first.alias("__first")).select(*keys, *(F.col("__first")[c].alias(c) for c in (order, *keep)))


def top_k(df: DataFrame, groups: list[str], order: list[Column | str], k: int | Column) -> DataFrame:
    """The first k rows of each group; Catalyst limits groups before and after the shuffle."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


#: Samples of up to so many rows are merged in one task; for larger ones a threshold on the hash is found first.
SMALL_SAMPLE = 10_000


def sample_n(df: DataFrame, n: int, seed: int, *ids: str, small: int = SMALL_SAMPLE) -> DataFrame:
    """n rows without replacement, or all where there are fewer: the first in hash order."""
    return first_n(df, n, hash_order(seed, *ids), *ids, small=small)


def _bucket(order: Column) -> Column:
    """One of 65,536 by the first digits of a hexadecimal hash."""
    return F.conv(F.substring(order, 1, 4), 16, 10).cast("int")


def first_n(df: DataFrame, n: int, order: Column, *ids: str, small: int = SMALL_SAMPLE) -> DataFrame:
    """The first n rows by (order, ids), or all where there are fewer; order is a hexadecimal hash.

    A large sample takes whole the buckets of hashes below the one in which the n-th row lies,
    and only that bucket's rows are sorted. So df is made up to three times.
    """
    if n <= small:
        return df.orderBy(order, *ids).limit(n)
    bucket = _bucket(order)
    before, last = 0, None
    for row in df.groupBy(bucket.alias("b")).count().orderBy("b").toLocalIterator():
        if before + row["count"] > n:
            last = row["b"]
            break
        before += row["count"]
    if last is None:
        return df
    return df.where(bucket < last).unionByName(df.where(bucket == last).orderBy(order, *ids).limit(n - before))


def global_rank(df: DataFrame, order: Column, ids: list[str], rows: int, per_bucket: int = 50_000) -> DataFrame:
    """df with __rank, 1 for the first by (order, ids); order is a hexadecimal hash. Rows are ranked in buckets of hashes, never all in one task."""
    buckets = rows // per_bucket + 1
    number = F.conv(F.substring("__order", 1, 8), 16, 10).cast("long")
    df = df.withColumn("__order", order).withColumn("__bucket", F.shiftright(number * F.lit(buckets).cast("long"), 32))
    before = df.groupBy("__bucket").count()
    before = before.withColumn("__before", F.sum("count").over(Window.orderBy("__bucket")) - F.col("count")).drop("count")
    ranked = df.withColumn("__in", F.row_number().over(Window.partitionBy("__bucket").orderBy("__order", *ids)))
    return ranked.join(before, "__bucket").withColumn("__rank", F.col("__in") + F.col("__before")).drop("__bucket", "__in", "__before", "__order")


def last_of_share(orders: DataFrame, share: float, order: str = "__order") -> str | None:
    """The hexadecimal hash up to which the first floor(rows * share) rows lie, '' where that is no row; None where rows after them have it, too.

    Rows are counted in buckets of hashes, and of the one in which the last row lies by their hashes.
    """
    counts = sorted(map(tuple, orders.groupBy(_bucket(F.col(order)).alias("b")).count().collect()))
    left = int(sum(n for _, n in counts) * share)
    if not left:
        return ""
    for bucket, n in counts:
        if left <= n:
            break
        left -= n
    for row in orders.where(_bucket(F.col(order)) == bucket).groupBy(order).count().orderBy(order).toLocalIterator():
        left -= row["count"]
        if left <= 0:
            return row[order] if left == 0 else None


def before_or_after(order: Column, last: str) -> Column:
    return F.when(order <= last, "train").otherwise("eval")


def split_ratio(df: DataFrame, ratio: float, seed: int, *ids: str) -> DataFrame:
    """metadata = train for the first floor(rows * ratio) in hash order, eval for the rest. Only hashes are shuffled, unless the bound lies between rows of one hash."""
    order = hash_order(seed, *ids)
    last = last_of_share(df.select(order.alias("__order")), ratio)
    if last is not None:
        return df.withColumn("metadata", before_or_after(order, last))
    rows = df.count()
    ranked = global_rank(df, order, list(ids), rows)
    return ranked.withColumn("metadata", F.when(F.col("__rank") <= int(rows * ratio), "train").otherwise("eval")).drop("__rank")
