"""Decontamination against held-out keys, candidate filters and their statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import hygiene, loose_key
from .ordering import keep_first, top_k


class HeldOutCollision(ValueError):
    """Held-out texts among those to train on."""


def drop_keys(df: DataFrame, keys: DataFrame, on: str = "key") -> DataFrame:
    """Rows whose key isn't among keys."""
    return df.join(keys.select(on).distinct(), on, "left_anti")


def heldout_collisions(df: DataFrame, keys: DataFrame, on: str = "key") -> DataFrame:
    return df.join(keys.select(on).distinct(), on, "left_semi")


def heldout_guard(df: DataFrame, keys: DataFrame, on: str = "key") -> DataFrame:
    """df, or an error where any of its keys is held out: texts to train on must not be dropped silently."""
    found = heldout_collisions(df, keys, on).limit(5).collect()
    if found:
        raise HeldOutCollision(f"held-out keys: {[r[on] for r in found]}")
    return df


EVAL, CORPUS = 1, 2


def judged(cands: DataFrame, avoid: DataFrame, corpus: DataFrame, hit: Column, normal: Column, group: str, order: str) -> DataFrame:
    """Each candidate that is the first of its key in its group, with what becomes of it: keyword, eval, corpus or kept.

    Texts are tidied, empty ones go. Collisions are by the loose key of the text or of its normal
    form; those with held-out keys come before those with the corpus. Keys meet as SHA-256 digests:
    both lists become one table of digests, which is joined once for each form.
    """
    tidy = cands.withColumn("text", hygiene("text")).withColumn("key", loose_key(F.col("text"))).where("text <> '' AND key <> ''")
    first = keep_first(tidy.withColumn("__key", digest("key")), [group, "__key"], [order]).withColumn("nkey", loose_key(normal)).withColumn("__nkey", digest("nkey"))
    known = avoid.select(digest("key").alias("__k"), F.lit(EVAL).alias("__in")).union(corpus.select(digest("key"), F.lit(CORPUS)))
    known = known.groupBy("__k").agg(F.bit_or("__in").alias("__in"))
    for own in ("__key", "__nkey"):
        first = first.join(known.toDF(own, f"{own}_in"), own, "left")
    where = F.coalesce("__key_in", F.lit(0)).bitwiseOR(F.coalesce("__nkey_in", F.lit(0)))
    verdict = F.when(hit, "keyword").when(where.bitwiseAND(EVAL) > 0, "eval").when(where.bitwiseAND(CORPUS) > 0, "corpus").otherwise("kept")
    return first.withColumn("verdict", verdict).drop("__key", "__nkey", "__key_in", "__nkey_in")


def digest(column: str) -> Column:
    """What stands for a long key in shuffles and joins. Null keys have an empty one, and so are equal; it is never
    null, so that no join tests for that and makes it twice."""
    return F.coalesce(F.unhex(F.sha2(column, 256)), F.lit(b""))


def filter_candidates(judged_rows: DataFrame, keep: int, group: str, order: str) -> DataFrame:
    """The first keep survivors of each group, by an order that doesn't repeat in it; the test comes after a row is taken, so there is one at least."""
    return top_k(judged_rows.where("verdict = 'kept'"), [group], [order], max(1, keep))


def filter_stats(cands: DataFrame, judged_rows: DataFrame, keep: int, group: str, order: str) -> DataFrame:
    """raw, deduped, keyword_hits, eval_collisions, corpus_collisions, kept of each group; collisions count while fewer than keep were kept before.

    A row counts up to the place where its group's keep-th survivor stands; that place is found by a
    top-k of places, so that no task needs a group's rows together.
    """
    keep = max(1, keep)
    raw = cands.groupBy(group).agg(F.count(F.lit(1)).alias("raw"))
    places = judged_rows.select(group, order, "verdict")
    last = top_k(places.where("verdict = 'kept'"), [group], [order], keep).groupBy(group).agg(F.max(order).alias("__last"), F.count(F.lit(1)).alias("__n"))
    seen = F.coalesce((F.col("__n") < keep) | (F.col(order) <= F.col("__last")), F.lit(True))
    counted = places.join(last, group, "left").groupBy(group).agg(
        F.count(F.lit(1)).alias("deduped"),
        F.count_if(F.col("verdict") == "keyword").alias("keyword_hits"),
        F.count_if((F.col("verdict") == "eval") & seen).alias("eval_collisions"),
        F.count_if((F.col("verdict") == "corpus") & seen).alias("corpus_collisions"),
        F.count_if((F.col("verdict") == "kept") & seen).alias("kept"),
    )
    names = ["deduped", "keyword_hits", "eval_collisions", "corpus_collisions", "kept"]
    return raw.join(counted, group, "left").select(group, "raw", *(F.coalesce(n, F.lit(0)).alias(n) for n in names))


def add_stats(rounds: list[DataFrame], group: str) -> DataFrame:
    """The statistics of several rounds of the same groups, added up; a group that a round lacks counts as zeros in it."""
    every = reduce(DataFrame.unionByName, rounds)
    return every.groupBy(group).agg(*(F.sum(c).alias(c) for c in every.columns if c != group))


def sequential_sessions(df: DataFrame, groups: list[str], quota: int, group: str, order: str, key: str = "key") -> DataFrame:
    """For each group in turn its first quota keys that no earlier group kept; what a full group passes over stays free for later ones."""
    from .sessions import quotas, sessions

    kept = sessions([df], quotas(df.sparkSession, groups, quota, group), group, order, key)
    return df.join(kept.select(group, order), [group, order], "left_semi")


def banned_elsewhere(df: DataFrame, banned: DataFrame, text: str, owner: str, allowed: str) -> DataFrame:
    """Rows with exactly one of the banned texts that don't belong to the one owner that may have them; texts meet as digests."""
    marked = df.where(~F.col(owner).eqNullSafe(allowed)).withColumn("__d", digest(text))
    return marked.join(banned.select(digest(text).alias("__d")).distinct(), "__d", "left_semi").drop("__d")


def drop_keyword_hits(examples: DataFrame, hit: Column, group: str) -> tuple[DataFrame, DataFrame]:
    """Examples that keywords don't already catch, and (group, total, dropped, percent, emptied); the hit is a column of each row, so verdicts can't be mispaired."""
    judged_rows = examples.withColumn("__hit", F.coalesce(hit, F.lit(False)))
    stats = judged_rows.groupBy(group).agg(F.count(F.lit(1)).alias("total"), F.count_if("__hit").alias("dropped"))
    share = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("dropped") * 100.0 / F.col("total"))
    stats = stats.select(group, "total", "dropped", F.round(share.cast("double"), 6).alias("percent"), (F.col("dropped") == F.col("total")).alias("emptied"))
    return judged_rows.where("NOT __hit").drop("__hit"), stats


def check_not_emptied(stats: DataFrame, group: str) -> None:
    empty = stats.where("emptied").limit(20).collect()
    if empty:
        raise ValueError(f"no examples are left of: {sorted(r[group] for r in empty)}")


def newline_guard(df: DataFrame, text: str) -> DataFrame:
    """df, or an error where a text has a line end: line protocols would split it."""
    if df.where(F.col(text).rlike("[\r\n]")).take(1):
        raise ValueError("a text has a line end")
    return df
