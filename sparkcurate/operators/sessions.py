"""Quotas of groups that choose one after another: what an earlier group keeps, no later one may keep."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .decontam import digest
from .lineage import cut

#: Up to so many keys that are held, some 40 bytes each, are broadcast; more are joined by a shuffle.
BROADCAST_HELD = 500_000


def quotas(spark, groups: list, quota: int, group: str) -> DataFrame:
    """(group, turn, quota) of a list of groups in their order."""
    return spark.createDataFrame([(g, k, quota) for k, g in enumerate(groups)], f"{group} string, turn long, quota long")


def sessions(rounds: list[DataFrame], turns: DataFrame, group: str, order: str, key: str = "key", avoid: DataFrame | None = None) -> DataFrame:
    """(group, round, order, key) of what each group keeps.

    turns has (group, turn, quota). In their turn, groups keep the first of their candidates, by round and order, up to their quota: each
    key once, none that avoid has (key), none that an earlier group has kept. A later round is a group's second answer, looked at
    only where the rounds before it left the group short; what a full group passes over stays free for later groups. Null keys are
    a key of their own; candidates of groups that turns lacks are ignored.

    All groups choose at once, again and again: each holds its first quota keys that no earlier group
    holds; a key that several hold goes to the earliest, and the others try their next ones. Every
    loss is for good, as holders only get earlier, so that this ends, at the latest after as many passes as there are groups, with what
    turns would give. Nothing is gathered: a pass is a join with the keys held and a top-k that is
    limited before its shuffle.
    """
    every = reduce(DataFrame.unionByName, (r.select(group, F.lit(k).alias("round"), order, key) for k, r in enumerate(rounds)))
    mine = every.withColumn("__d", digest(key)).join(F.broadcast(turns.select(group, "turn", "quota")), group)
    if avoid is not None:
        mine = mine.join(avoid.select(digest(key).alias("__d")).distinct(), "__d", "left_anti")
    first = F.min(F.struct("round", order))
    mine = mine.groupBy(group, "turn", "quota", "__d").agg(first.alias("at"), F.first(key).alias(key))
    mine = cut(mine)
    most = turns.agg(F.max("quota").alias("most")).first()["most"] or 0
    held, n = None, -1
    while True:
        free = mine
        if held is not None:
            near = F.broadcast(held) if n <= BROADCAST_HELD else held
            free = mine.join(near, "__d", "left").where(F.col("by").isNull() | (F.col("by") >= F.col("turn"))).drop("by")
        chosen = free.withColumn("__rn", F.row_number().over(Window.partitionBy(group).orderBy("at", "__d")))
        # the constant lets groups be limited before the shuffle
        chosen = chosen.where((F.col("__rn") <= most) & (F.col("__rn") <= F.col("quota"))).drop("__rn")
        now = cut(chosen.groupBy("__d").agg(F.min("turn").alias("by"), F.count(F.lit(1)).alias("wanted")))
        clash = now.where("wanted > 1").take(1)
        # who holds a key now holds it against all later groups, also those that have not come to it yet
        later = now.select("__d", "by") if held is None else now.select("__d", "by").unionByName(held)
        held = cut(later.groupBy("__d").agg(F.min("by").alias("by")))
        n = held.count()
        if not clash:
            return chosen.select(group, F.col("at")["round"].alias("round"), F.col("at")[order].alias(order), key)


def session_report(kept: DataFrame, turns: DataFrame, group: str) -> DataFrame:
    """(group, quota, kept, topped_up, short): how many each group keeps, how many of them come from a later round than the first, and whether that is too few."""
    counts = kept.groupBy(group).agg(F.count(F.lit(1)).alias("kept"), F.count_if(F.col("round") > 0).alias("topped_up"))
    both = turns.join(counts, group, "left").fillna(0, ["kept", "topped_up"])
    return both.select(group, "quota", "kept", "topped_up", (F.col("kept") < F.col("quota")).alias("short"))
