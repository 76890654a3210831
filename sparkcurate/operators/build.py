"""The whole way from banks to training rows: merge, eligibility, expansion, aliases, keyword filter, normal form, guard, negatives, split."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import loose_key
from . import catalog, expand
from .assemble import distinct_texts, negative_target, positives
from .decontam import digest, drop_keys
from .keywords import with_hit
from .lineage import cut
from .observed import Guards
from .ordering import sample_n, split_ratio


class BuildError(ValueError):
    """Stages that don't follow each other."""


@dataclass(frozen=True)
class Banks:
    """What a data set is made of.

    own and other: skills (id, router_eligible, further columns); own ones win. examples: skill_id, ord, text, args. frames: skill_id, frame_ord,
    target, cap, text, args. slots: slot, surface, canonical. ranges: slot, min, max. negatives: ord, text. negative_frames: as frames, of one
    skill_id of any name. heldout: key, loose keys of whatever is held out. rules: a table of keyword rules, or None for no filter.
    """

    own: DataFrame
    other: DataFrame
    examples: DataFrame
    frames: DataFrame
    slots: DataFrame
    ranges: DataFrame | None
    negatives: DataFrame
    negative_frames: DataFrame | None
    heldout: DataFrame
    rules: DataFrame | None = None


@dataclass(frozen=True)
class Plan:
    """Numbers and choices. normal makes the form in which texts are served."""

    seed: int
    normal: Callable[[Column], Column] = loose_key
    ratio: float = 1.0
    split: float = 0.9
    allow_missing: bool = False


@dataclass(frozen=True)
class State:
    """What goes from stage to stage; a field is None before the stage that makes it."""

    banks: Banks
    plan: Plan
    guards: Guards
    skills: DataFrame | None = None
    examples: DataFrame | None = None
    negatives: DataFrame | None = None
    normal: bool = False
    guarded: DataFrame | None = None
    rows: DataFrame | None = None


def _need(state: State, *fields: str) -> None:
    missing = [f for f in fields if getattr(state, f) is None or getattr(state, f) is False]
    if missing:
        raise BuildError(f"needs {', '.join(missing)} first")


def merge(s: State) -> State:
    return replace(s, skills=catalog.merge_priority(s.banks.own, s.banks.other))


def select_eligible(s: State) -> State:
    """Only what is offered when it is served; examples of other skills go."""
    _need(s, "skills")
    skills = catalog.eligible(s.skills)
    examples = catalog.clean_examples(s.banks.examples).join(F.broadcast(skills.select(F.col("id").alias("skill_id")).distinct()), "skill_id", "left_semi")
    return replace(s, skills=skills, examples=examples.select("skill_id", F.lit(0).alias("part"), F.col("ord").cast("long").alias("ord"), "text", "args"))


def _expanded(frames: DataFrame, s: State, seen: DataFrame, seed: int) -> DataFrame:
    """(skill_id, ord, text, args) of frames' fillings: each skill's first in hash order up to its target, none held out by its raw key, no key twice or among seen."""
    ids = ["skill_id", "frame_ord"]
    expand.check_slots(frames, s.banks.slots, ids, s.banks.ranges)
    pool = expand.expand_frames(frames, s.banks.slots, seed, ids, s.banks.ranges).withColumn("key", digest_key("text"))
    goal = frames.groupBy("skill_id").agg(F.max("target").alias("target"))
    pool = pool.join(F.broadcast(goal), "skill_id")
    kept = expand.accept(pool, seen, s.banks.heldout.select(digest("key").alias("key")), "skill_id", seed, F.col("target"), ["frame_ord", "i"])
    return kept.select("skill_id", (F.col("frame_ord").cast("long") * F.lit(1 << 32) + F.col("i")).alias("ord"), "text", "args")


def digest_key(text: str) -> Column:
    return F.coalesce(F.unhex(F.sha2(loose_key(F.col(text)), 256)), F.lit(b""))


def augment(s: State) -> State:
    """Frames' expansions go to the examples, and negative frames' to the negatives; decontaminated by raw keys."""
    _need(s, "skills", "examples")
    banked = expand.with_banks(s.skills.withColumnRenamed("id", "skill_id"), s.banks.frames, s.plan.allow_missing)
    frames = s.banks.frames.join(F.broadcast(banked.select("skill_id").distinct()), "skill_id", "left_semi")
    seen = s.examples.select("skill_id", digest_key("text").alias("key"))
    more = _expanded(frames, s, seen, s.plan.seed).withColumn("part", F.lit(1))
    negatives = s.banks.negatives.select(F.lit(0).alias("part"), F.col("ord").cast("long").alias("ord"), "text")
    if s.banks.negative_frames is not None:
        none = seen.limit(0)
        extra = _expanded(s.banks.negative_frames, s, none, s.plan.seed + 1)
        negatives = negatives.unionByName(extra.select(F.lit(1).alias("part"), "ord", "text"))
    return replace(s, examples=s.examples.unionByName(more), negatives=negatives)


def name_skills(s: State) -> State:
    _need(s, "skills")
    return replace(s, skills=catalog.assign_alias(s.skills))


def filter_keywords(s: State) -> State:
    """Without rules nothing; else raw texts that keywords catch go, and a skill of which all go is a failure, told when the rows are written."""
    _need(s, "examples")
    if s.banks.rules is None:
        return s
    rows = cut(s.examples.withColumn("__id", F.concat_ws("|", "skill_id", "part", "ord")))
    judged = with_hit(rows, s.banks.rules, "__id")
    left = judged.groupBy("skill_id").agg(F.count_if(~F.col("hit")).alias("__left"))
    both = s.guards.watch(judged.join(left, "skill_id"), {"no examples are left": F.col("__left") == 0}, F.col("skill_id"))
    return replace(s, examples=both.where("NOT hit").drop("__id", "hit", "__left"))


def normalize(s: State) -> State:
    """Texts in the form in which they are served; a text with a line end is a failure. Positives aren't made distinct after it."""
    _need(s, "examples", "negatives")
    line_end = F.col("text").rlike("[\r\n]")
    examples = s.guards.watch(s.examples, {"an example has a line end": line_end}, F.col("text"))
    negatives = s.guards.watch(s.negatives, {"a negative has a line end": line_end}, F.col("text"))
    return replace(s, examples=examples.withColumn("text", s.plan.normal(F.col("text"))), negatives=negatives.withColumn("text", s.plan.normal(F.col("text"))), normal=True)


def guard(s: State) -> State:
    """A positive whose normal form is held out is a failure, also where its raw form was clean; such a negative goes."""
    _need(s, "normal")
    held = s.banks.heldout.select(digest("key").alias("__d")).distinct().withColumn("__held", F.lit(True))
    marked = s.examples.withColumn("__d", digest_key("text")).join(held, "__d", "left")
    marked = s.guards.watch(marked, {"held-out positives": F.col("__held")}, F.col("text"))
    kept = drop_keys(s.negatives.withColumn("__d", digest_key("text")), held, "__d").drop("__d")
    return replace(s, examples=marked.drop("__d", "__held"), negatives=kept, guarded=held)


def sample_and_split(s: State) -> State:
    """All positives, as many negatives as they call for, in hash order; (metadata, text, name, args)."""
    _need(s, "guarded")
    pos = positives(s.examples.withColumn("__id", F.concat_ws("|", "skill_id", "part", "ord")), s.skills, keep=("__id",))
    pos = cut(pos)  # so that the banks are read once
    n = pos.agg(negative_target(F.count(F.lit(1)), s.plan.ratio)).first()[0]
    pool = cut(distinct_texts(s.negatives.withColumn("__o", F.struct("part", "ord")), "text", "__o"))  # the sample goes through it up to three times
    picked = sample_n(pool, n, s.plan.seed, "text")
    none = F.lit(None)
    every = pos.select("text", "name", "args", "__id").unionByName(picked.select("text", none.cast("string").alias("name"), none.cast("map<string,string>").alias("args"), F.lit("-").alias("__id")))
    return replace(s, rows=split_ratio(cut(every), s.plan.split, s.plan.seed, "name", "__id", "text").drop("__id"))


#: In this order; each stage says what it needs.
STAGES = (merge, select_eligible, augment, name_skills, filter_keywords, normalize, guard, sample_and_split)


def build(banks: Banks, plan: Plan, stages=STAGES) -> State:
    """Runs the stages; the state's rows are (metadata, text, name, args), its guards are asked by write_guarded().

    Errors of the banks (slots that nobody defines, skills without frames) come at once; what rows show (a
    skill that keywords own, a line end, a held-out positive) comes when the rows are written, all at a time.
    """
    state = State(banks, plan, Guards())
    for stage in stages:
        try:
            state = stage(state)
        except BuildError as e:
            raise BuildError(f"{stage.__name__} {e}") from None
    return state
