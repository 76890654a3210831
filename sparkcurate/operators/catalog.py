"""Catalogues of skills: merging, eligibility, aliases, inferred parameters, fingerprints and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import last_segment


def merge_priority(first: DataFrame, second: DataFrame, on: str = "id") -> DataFrame:
    """first and the rows of second whose id it lacks; second's own repeats stay."""
    return first.unionByName(second.join(first.select(on).distinct(), on, "left_anti").select(*first.columns))


def eligible(df: DataFrame, flag: str = "router_eligible") -> DataFrame:
    """Rows that aren't marked as ineligible; a missing flag counts as eligible."""
    return df.where(F.coalesce(F.col(flag), F.lit(True)))


def assign_alias(df: DataFrame, id_col: str = "id") -> DataFrame:
    """alias: the id's last segment where no other id has it, else the whole id; null for a null id."""
    counts = df.groupBy(last_segment(F.col(id_col)).alias("__seg")).agg(F.count(F.lit(1)).alias("__n"))
    both = df.withColumn("__seg", last_segment(F.col(id_col))).join(counts, "__seg", "left")
    return both.withColumn("alias", F.when(F.col("__n") == 1, F.col("__seg")).otherwise(F.col(id_col))).drop("__seg", "__n")


def clean_examples(examples: DataFrame) -> DataFrame:
    """Examples with text, white space too; null arguments become none."""
    return examples.where(F.coalesce("text", F.lit("")) != "").withColumn("args", F.coalesce("args", F.create_map().cast("map<string,string>")))


def infer_params(examples: DataFrame, id_col: str = "skill_id") -> DataFrame:
    """(id, names, schema): argument names in the order they are first seen, and as a JSON schema of strings.

    The list of required names is there only if there are any.
    """
    from ..functions.jsontext import json_string

    keys = examples.select(id_col, "ex_ord", F.posexplode(F.map_keys("args")).alias("pos", "name"))
    first = keys.groupBy(id_col, "name").agg(F.min(F.struct("ex_ord", "pos")).alias("at"))
    listed = first.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("names"))
    every = examples.select(id_col).distinct().join(listed, id_col, "left")
    names = F.coalesce("names", F.array().cast("array<string>"))
    quoted = F.transform(names, json_string)
    props = F.array_join(F.transform(quoted, lambda n: F.concat(n, F.lit(': {"type": "string"}'))), ", ")
    required = F.when(F.size(names) > 0, F.concat(F.lit(', "required": ['), F.array_join(quoted, ", "), F.lit("]"))).otherwise("")
    return every.select(id_col, names.alias("names"), F.concat(F.lit('{"type": "object", "properties": {'), props, F.lit("}"), required, F.lit("}")).alias("schema"))


def tools(skills: DataFrame) -> DataFrame:
    """One row with the array of all skills' declarations, in order of ord; a catalogue is small."""
    one = F.struct(F.lit("function").alias("type"), F.struct(F.col("alias").alias("name"), "description", "parameters").alias("function"))
    return skills.agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", one.alias("tool")))), lambda x: x["tool"]).alias("tools"))


def fingerprint(skill: Column, description: Column, parameters: Column, texts: Column) -> Column:
    """SHA-256 of a skill's facts as canonical JSON: description, sorted example texts, id and parameters (a JSON text).

    Null strings count as empty, null texts as none, and null parameters as an empty object; malformed
    parameters give null.
    """
    from ..functions.jsontext import canonical_json, json_string

    listed = F.array_join(F.transform(F.array_sort(F.coalesce(texts, F.array().cast("array<string>"))), lambda t: json_string(F.coalesce(t, F.lit("")))), ", ")
    text = [json_string(F.coalesce(x, F.lit(""))) for x in (description, skill)]
    whole = F.concat(F.lit('{"description": '), text[0], F.lit(', "examples": ['), listed, F.lit('], "id": '), text[1], F.lit(', "parameters": '), F.coalesce(parameters, F.lit("{}")), F.lit("}"))
    return F.sha2(canonical_json(whole), 256)


def drift(skills: DataFrame, banked: DataFrame, ledger: DataFrame, id_col: str = "skill_id") -> DataFrame:
    """(id, status): missing (no bank), stale (another fingerprint than the ledger's, or none there), ok, orphaned (a bank without a skill)."""
    own = skills.select(id_col, F.col("sha256").alias("now"), F.lit(True).alias("skill"))
    banks = banked.select(id_col).distinct().withColumn("bank", F.lit(True))
    both = own.join(banks, id_col, "full").join(ledger.select(id_col, "sha256"), id_col, "left")
    status = F.when(F.col("skill").isNull(), "orphaned").when(F.col("bank").isNull(), "missing").when(F.col("now").eqNullSafe(F.col("sha256")), "ok").otherwise("stale")
    return both.select(id_col, status.alias("status"))


def ledger_upsert(old: DataFrame, new: DataFrame, keys: list[str], value: str, only: list[str] | None = None) -> DataFrame:
    """old with new's values; with only, just for those first keys."""
    new = new if only is None else new.where(F.col(keys[0]).isin(only))
    both = old.select(*keys, F.col(value).alias("__old")).join(new.select(*keys, F.col(value).alias("__new")), keys, "full")
    return both.select(*keys, F.coalesce("__new", "__old").alias(value))


def pick_locale(manifests: DataFrame, locale: str, group: str = "dir", file: str = "file_name") -> DataFrame:
    """The best manifest of each folder: the locale's, else the English one, else the plain one."""
    rank = F.when(F.col(file) == f"SKILL.{locale}.md", 0).when(F.col(file) == "SKILL.en.md", 1).when(F.col(file) == "SKILL.md", 2)
    w = Window.partitionBy(group).orderBy("__rank")
    ranked = manifests.withColumn("__rank", rank).where("__rank IS NOT NULL")
    return ranked.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rank", "__rn")


def activate_bank(bank: DataFrame, draft: DataFrame, skill: str, target: str) -> DataFrame:
    """bank without the skill's frames in any file, and the draft's in the target file."""
    return bank.where(F.col("skill_id") != skill).unionByName(draft.where(F.col("skill_id") == skill).withColumn("src_file", F.lit(target)).select(*bank.columns))


def new_slots(draft: DataFrame, bank: DataFrame) -> DataFrame:
    """The draft's slots that no file owns yet; owned ones aren't touched."""
    return draft.join(bank.select("slot").distinct(), "slot", "left_anti")


def duplicate_owners(df: DataFrame, key: str, owner: str) -> DataFrame:
    """(key, owners): keys that several owners define."""
    return df.groupBy(key).agg(F.count_distinct(owner).alias("owners")).where("owners > 1")


def siblings(df: DataFrame, exclude: str, id_col: str = "id") -> DataFrame:
    """The whole catalogue but one."""
    return df.where(F.col(id_col) != exclude)


def avoid_list(texts: DataFrame, n: int, order: str) -> DataFrame:
    """The first n texts, to be told what to avoid."""
    return texts.orderBy(order).limit(n)
