"""Frames and slots: deterministic expansion by cyclic zips, templates crossed with entities."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import placeholders, substitute
from .draws import drawn
from .ordering import hash_order, keep_first, top_k


class BankError(ValueError):
    """A bank that can't be expanded."""


def int_slots(ranges: DataFrame) -> DataFrame:
    """(slot, val_ord, surface, canonical) of whole-number ranges (slot, min, max)."""
    values = ranges.withColumn("v", F.explode(F.sequence("min", "max")))
    return values.select("slot", (F.col("v") - F.col("min")).alias("val_ord"), F.col("v").cast("string").alias("surface"), F.col("v").cast("string").alias("canonical"))


def undefined_slots(frames: DataFrame, slots: DataFrame, id_cols: list[str], ranges: DataFrame | None = None) -> DataFrame:
    """(id columns, slot) of the placeholders that neither a bank nor a range defines."""
    refs = frames.select(*id_cols, F.explode(placeholders(F.col("text"), F.col("args"))).alias("slot"))
    known = slots.select("slot") if ranges is None else slots.select("slot").union(ranges.select("slot"))
    return refs.join(known.distinct(), "slot", "left_anti").select(*id_cols, "slot")


def check_slots(frames: DataFrame, slots: DataFrame, id_cols: list[str], ranges: DataFrame | None = None) -> None:
    missing = undefined_slots(frames, slots, id_cols, ranges).limit(20).collect()
    if missing:
        raise BankError(f"undefined slots: {sorted({r['slot'] for r in missing})}")


def expand_frames(frames: DataFrame, slots: DataFrame, seed: int, id_cols: list[str], ranges: DataFrame | None = None) -> DataFrame:
    """(id columns, i, text, args): frames with placeholders filled.

    frames: id columns, text, args (map), cap. slots: slot, surface, canonical. ranges: slot, min, max, of slots whose
    values are whole numbers: up to cap of them are drawn, and the range isn't written out. Of each slot up to cap
    values are taken in hash order; a frame gives as many rows as its longest slot has values, and row
    i takes value i modulo the number of values of each slot, so slots wrap around and aren't crossed.
    Surfaces go into the text, canonical forms into arguments, in one pass. A frame without slots gives
    itself once. Frames whose slots lack values give no rows; check_slots tells.
    """
    named = frames.withColumn("names", placeholders(F.col("text"), F.col("args")))
    plain = named.where(F.size("names") == 0).select(*id_cols, F.lit(0).cast("long").alias("i"), "text", "args")
    refs = named.where(F.size("names") > 0).select(*id_cols, "cap", F.size("names").alias("wanted"), F.explode("names").alias("slot"))
    values = slots.select("slot", "surface", "canonical").distinct()
    picks = refs.join(values, "slot")
    order = hash_order(seed, *id_cols, "slot", "canonical", "surface")
    w = Window.partitionBy(*id_cols, "slot").orderBy(order, "canonical", "surface")
    picks = picks.withColumn("rk", F.row_number().over(w) - 1).where(F.col("rk") < F.col("cap"))
    if ranges is not None:
        numbers = drawn(refs.join(ranges.select("slot", "min", "max"), "slot"), "min", "max", "cap", *id_cols, "slot", seed=seed)
        text = F.col("drawn").cast("string")
        picks = picks.unionByName(numbers.select(*id_cols, "cap", "wanted", "slot", F.col("rk").cast("int").alias("rk"), text.alias("surface"), text.alias("canonical")))
    listed = picks.groupBy(*id_cols, "slot", "wanted").agg(F.array_sort(F.collect_list(F.struct("rk", "surface", "canonical"))).alias("vals"))
    per_frame = listed.groupBy(*id_cols, "wanted").agg(F.map_from_entries(F.collect_list(F.struct("slot", "vals"))).alias("banks"), F.max(F.size("vals")).alias("depth"), F.count(F.lit(1)).alias("have"))
    rows = per_frame.where("have = wanted").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("depth") - 1)))

    def chosen(part: str) -> Column:
        return F.transform_values("banks", lambda _, v: F.element_at(v, (F.col("i") % F.size(v) + 1).cast("int"))[part])

    filled = frames.join(rows, id_cols).withColumn("__s", chosen("surface")).withColumn("__c", chosen("canonical"))
    filled = filled.select(*id_cols, F.col("i").cast("long").alias("i"), substitute(F.col("text"), F.col("__s")).alias("text"), F.transform_values("args", lambda _, v: substitute(v, F.col("__c"))).alias("args"))
    return plain.unionByName(filled)


def accept(pool: DataFrame, seen: DataFrame, heldout: DataFrame, group: str, seed: int, target: Column, ids: list[str]) -> DataFrame:
    """Of a pool with keys, each group's first target rows in hash order: first of their key, not among seen (group, key), not held out."""
    first = keep_first(pool.withColumn("__o", hash_order(seed, *ids)), [group, "key"], ["__o", *ids])
    free = first.join(seen.select(group, "key").distinct(), [group, "key"], "left_anti").join(heldout.select("key").distinct(), "key", "left_anti")
    return top_k(free, [group], ["__o", *ids], target).drop("__o")


def shortfall(groups: DataFrame, accepted: DataFrame, group: str) -> DataFrame:
    """(group, target, kept, short): groups with fewer accepted rows than their target, zero ones too."""
    counts = accepted.groupBy(group).agg(F.count(F.lit(1)).alias("kept"))
    both = groups.join(counts, group, "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    return both.select(group, F.col("target").cast("long").alias("target"), "kept", (F.col("kept") < F.col("target")).alias("short"))


def with_banks(skills: DataFrame, frames: DataFrame, allow_missing: bool = False, id_col: str = "skill_id") -> DataFrame:
    """skills with has_bank: whether any frames are theirs. Skills without are an error, unless allowed: then they just get no expansions."""
    both = skills.join(frames.select(id_col).distinct().withColumn("has_bank", F.lit(True)), id_col, "left").withColumn("has_bank", F.coalesce("has_bank", F.lit(False)))
    if not allow_missing:
        missing = both.where("NOT has_bank").select(id_col).limit(20).collect()
        if missing:
            raise BankError(f"skills without frames: {sorted(r[id_col] for r in missing)}")
    return both


def heldout_dropped(pool: DataFrame, seen: DataFrame, heldout: DataFrame, group: str, seed: int, target: Column, ids: list[str]) -> DataFrame:
    """(group, eval_dropped): how many rows accept() passes over as held out before its group has its target.

    Rows count as they come in hash order, repeats of a held-out key each time, until the group's last
    accepted row; groups that never reach the target count all.
    """
    order = hash_order(seed, *ids)
    marked = pool.withColumn("__o", order).join(heldout.select("key").distinct().withColumn("__held", F.lit(True)), "key", "left")
    marked = marked.join(seen.select(group, "key").distinct().withColumn("__seen", F.lit(True)), [group, "key"], "left")
    place = F.struct("__o", *ids)
    taken = accept(pool, seen, heldout, group, seed, target, ids).withColumn("__o", order)
    last = taken.withColumn("__target", target).groupBy(group).agg(F.max(place).alias("__last"), F.count(F.lit(1)).alias("__n"), F.first("__target").alias("__target"))
    # a target of 0 is reached before any row is looked at
    both = marked.where("__held AND __seen IS NULL").where(F.coalesce(target > 0, F.lit(True))).join(last, group, "left")
    open_ = F.coalesce((F.col("__n") < F.col("__target")) | (place <= F.col("__last")), F.lit(True))
    return both.groupBy(group).agg(F.count_if(open_).alias("eval_dropped"))


#: Templates are a list that people write; they go into the plan, and longer lists are refused.
MOST_TEMPLATES = 1_000


def template_cross(templates: DataFrame, entities: DataFrame, mark: str = "{}") -> DataFrame:
    """Each template filled with each entity: the entity's columns, the template's, and text.

    A template has the mark where the column entity goes, and {name} where any other column of that
    name goes. The few templates are an array of literals that each entity's row is exploded by.
    """
    rows = templates.limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    if not rows:
        return entities.limit(0).select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in templates.schema), F.lit("").alias("text"))
    listed = F.array(*(F.struct(*(F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in templates.schema)) for r in rows))
    each = entities.withColumn("__t", F.explode(listed)).select(*entities.columns, "__t.*")
    values = [(f"{{{c}}}", F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in entities.columns]
    values += [(mark, value) for name, value in values if name == "{entity}"]
    return each.withColumn("text", filled(F.col("template"), values))


def filled(template: Column, values: list[tuple[str, Column]]) -> Column:
    """template with each mark as its value, in one pass: marks within values stay as they are. Longer marks go before shorter ones at the same place."""
    if not values:
        return template
    cut = "\x00"
    marks = sorted((m for m, _ in values), key=len, reverse=True)
    parts = F.split(F.regexp_replace(template, "|".join(map(re.escape, marks)), f"{cut}$0{cut}"), cut)

    def one(part: Column) -> Column:
        out = part
        for mark, value in values:
            out = F.when(part == mark, value).otherwise(out)
        return out

    # every second part is a mark; others may look like one only where the template has the cut's character
    return F.array_join(F.transform(parts, lambda p, k: F.when(k % 2 == 1, one(p)).otherwise(p)), "")


def locale_pool(pool: DataFrame, locale: str, fallback: str = "en", column: str = "locale") -> DataFrame:
    """The rows of the locale, or the fallback's where the locale has none."""
    own = pool.where(F.col(column) == locale)
    return own if own.take(1) else pool.where(F.col(column) == fallback)
