"""Training records: prompts, samples with their messages, targets of negatives, the whole data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import json_string
from ..functions.text import loose_key
from .decontam import digest, drop_keys, heldout_collisions, heldout_guard
from .expand import filled
from .lineage import cut
from .ordering import before_or_after, first_n, hash_order, keep_first_id, last_of_share, split_ratio, top_k

#: At fewer positives than this the target of negatives is fixed.
SMALL, SMALL_TARGET = 50, 250


def negative_target(positives: Column, ratio: Column | float) -> Column:
    """How many negatives to sample; halves are rounded to even."""
    return F.when(positives < SMALL, F.lit(SMALL_TARGET).cast("long")).otherwise(F.bround(positives * ratio).cast("long"))


MESSAGE = "struct<role:string,content:string,tool_calls:array<struct<type:string,function:struct<name:string,arguments:map<string,string>>>>>"


def messages(user: Column, developer: Column, name: Column, args: Column, refusal: Column) -> Column:
    """Three messages; the last is a call where there is a name, else the refusal's text."""
    calls = F.array(F.struct(F.lit("function").alias("type"), F.struct(name.alias("name"), args.alias("arguments")).alias("function")))
    none = F.lit(None)

    def message(role: str, content: Column, call: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"), call.alias("tool_calls")).cast(MESSAGE)

    last = F.when(name.isNotNull(), message("assistant", none, calls)).otherwise(message("assistant", refusal, none))
    return F.array(message("developer", developer, none), message("user", user, none), last)


def positives(examples: DataFrame, skills: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(text, name, args, the columns in keep) of each example, with its skill's alias."""
    return examples.join(skills.select(F.col("id").alias("skill_id"), "alias"), "skill_id").select("text", F.col("alias").alias("name"), "args", *keep)


def dataset(pos: DataFrame, negatives: DataFrame, heldout: DataFrame, ratio: float, seed: int, split: float = 0.9) -> DataFrame:
    """(metadata, text, name, args): all positives and as many negatives as they call for, split in hash order.

    pos has text, name, args and an ordinal ord of its own for each row, negatives text and ord; texts
    are normalised. A positive that is held out is an error; such negatives go, as do repeats of exactly
    the same text. Positives aren't made distinct. The split hashes name, ordinal and text, so that it is
    the same on any number of partitions.
    """
    def keys(rows: DataFrame, text: Column) -> DataFrame:
        return rows.withColumn("__key", F.unhex(F.sha2(text, 256)))

    held = keys(heldout, F.col("key")).select("__key").distinct()
    if heldout_collisions(keys(pos, loose_key(F.col("text"))).select("__key"), held, "__key").limit(1).collect():
        heldout_guard(pos.withColumn("key", loose_key(F.col("text"))), heldout)
    n = pos.agg(negative_target(F.count(F.lit(1)), ratio)).first()[0]
    # texts stay behind until rows are chosen; till then their digests go, with the hashes of both orders
    hashed = negatives.select("text", digest("text").alias("__d"), hash_order(seed, "text").alias("__in"), hash_order(seed, F.lit(-1), "text").alias("__order"))
    pool = drop_keys(keys(hashed, loose_key(F.col("text"))), held, "__key").select("__d", "__in", "__order").distinct()
    picked = first_n(cut(pool), n, F.col("__in"), "__d").select("__d", "__order")
    chosen = negatives.select("text", digest("text").alias("__d")).join(picked, "__d").dropDuplicates(["__d"])
    none = F.lit(None)
    own = pos.select("text", "name", "args", F.col("ord").cast("long").alias("__id"))
    own = own.withColumn("__order", hash_order(seed, "name", "__id", "text"))
    every = own.unionByName(chosen.select("text", none.cast("string").alias("name"), none.cast("map<string,string>").alias("args"), F.lit(-1).cast("long").alias("__id"), "__order"))
    last = last_of_share(own.select("__order").unionByName(picked.select("__order")), split)
    if last is None:  # the bound lies between rows of one hash
        return split_ratio(every.drop("__order"), split, seed, "name", "__id", "text").drop("__id")
    return every.select(before_or_after(F.col("__order"), last).alias("metadata"), "text", "name", "args")


def distinct_texts(df: DataFrame, text: str = "text", order: str = "ord") -> DataFrame:
    """(text, order): the first row of each exact text."""
    return keep_first_id(df, [text], order)


def attach_tools(samples: DataFrame, tools: DataFrame, developer: str, refusal: str) -> DataFrame:
    """(metadata, tools, messages): the catalogue, one row, goes onto every sample only here, at the sink."""
    both = samples.crossJoin(F.broadcast(tools))
    return both.select("metadata", "tools", messages(F.col("text"), F.lit(developer), F.col("name"), F.col("args"), F.lit(refusal)).alias("messages"))


def turns(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, turns): the messages of each conversation in order of turn. A conversation is one row, so its length is what a task must hold."""
    return conversations.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<start_of_turn>"), turn["role"], F.lit("\n"), F.coalesce(turn["text"], F.lit("")), F.lit("<end_of_turn>\n"))


def prompt_completion(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, prompt, completion) of conversations that end with the assistant: all turns before it rendered, and its text; blank completions go."""
    t = turns(conversations, id_col).where(F.element_at("turns", -1)["role"] == "assistant")
    prompt = F.array_join(F.transform(F.slice("turns", 1, F.size("turns") - 1), rendered), "")
    out = t.select(id_col, F.concat(prompt, F.lit("<start_of_turn>assistant\n")).alias("prompt"), F.element_at("turns", -1)["text"].alias("completion"))
    return out.where(F.trim(F.coalesce("completion", F.lit(""))) != "")


def first_user_turn(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, text): the first message of the user."""
    first = conversations.where("role = 'user'").groupBy(id_col).agg(F.min_by("text", "turn").alias("text"))
    return first


def max_length(df: DataFrame, length: Column, order: str, first: int = 500, room: int = 100, most: int = 2048) -> DataFrame:
    """One row (max_length): the longest of the first rows with some room, at most most. length is the measure, such as tokens that another operator counted."""
    head = df.orderBy(order).limit(first).select(length.alias("__n"))
    return head.agg(F.least(F.max("__n") + room, F.lit(most)).cast("long").alias("max_length"))


def bullet_list(texts: DataFrame, group: str, order: str, n: int, text: str = "text") -> DataFrame:
    """(group, block): a group's first n texts as lines that begin with a dash, as prompts list what to avoid."""
    first = top_k(texts.select(group, order, text), [group], [order], n)
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return first.groupBy(group).agg(F.array_join(F.transform(lines, lambda x: F.concat(F.lit("- "), x["t"])), "\n").alias("block"))


def authoring_prompts(skills: DataFrame, examples: DataFrame, avoid: DataFrame, template: str, want: int, first_examples: int = 20, first_avoid: int = 150) -> DataFrame:
    """(skill_id, prompt): for each skill a request to write want texts, from a template with the marks <SPEC>, <AVOID> and <N>.

    skills: skill_id, description, parameters (a JSON text). SPEC is a JSON object of these and of the first examples' texts; AVOID lists
    the first texts that exist already as lines with a dash. examples and avoid: skill_id, ord, text. Only so many texts of a skill
    are gathered, limited before the shuffle. Marks within values stay as they are.
    """
    own = top_k(examples.select("skill_id", "ord", "text"), ["skill_id"], ["ord", "text"], first_examples)
    listed = own.groupBy("skill_id").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("l"))
    known = top_k(avoid.select("skill_id", "ord", "text"), ["skill_id"], ["ord", "text"], first_avoid)
    known = known.groupBy("skill_id").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("a"))
    both = skills.join(listed, "skill_id", "left").join(known, "skill_id", "left")
    none = F.array().cast("array<string>")
    texts = F.coalesce(F.transform("l", lambda x: json_string(x["text"])), none)
    parts = [F.lit('{"id": '), json_string(F.col("skill_id")), F.lit(', "description": '), json_string(F.coalesce("description", F.lit(""))), F.lit(', "parameters": '), F.coalesce("parameters", F.lit("{}"))]
    spec = F.concat(*parts, F.lit(', "example_requests": ['), F.array_join(texts, ", "), F.lit("]}"))
    block = F.array_join(F.coalesce(F.transform("a", lambda x: F.concat(F.lit("- "), x["text"])), none), "\n")
    return both.select("skill_id", filled(F.lit(template), [("<SPEC>", spec), ("<AVOID>", block), ("<N>", F.lit(str(want)))]).alias("prompt"))
