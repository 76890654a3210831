"""Scans of text formats: JSON banks, JSON lines with comments, verdict logs, front matter, sidecars, counters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import loose_key


class SourceError(ValueError):
    """A source that breaks its format's rules."""


FRAME_BANK = "map<string,struct<target:int,cap:int,frames:array<struct<text:string,args:map<string,string>>>>>"
#: A slot's bank is a list of values or a range; both are read as text first.
SLOT_BANK = "map<string,string>"
#: Files that people haven't reviewed yet; no scan sees them.
DRAFT = "draft-"


def whole_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(file_name, value): whole text files of a folder."""
    df = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("file_name"), "value")


def bank_entries(files: DataFrame, schema: str, what: str = "banks") -> DataFrame:
    """(file_name, key, value): entries of all JSON banks (file_name, value) but drafts; no files, bad JSON, or a key in two files are errors."""
    files = files.where(~F.startswith("file_name", F.lit(DRAFT)))
    entries = files.select("file_name", F.from_json("value", schema).alias("m"))
    if not files.take(1):
        raise SourceError(f"no {what}")
    if entries.where("m IS NULL").take(1):
        raise SourceError(f"bad JSON among {what}")
    flat = entries.select("file_name", F.explode("m"))
    twice = flat.groupBy("key").agg(F.count_distinct("file_name").alias("n")).where("n > 1").limit(20).collect()
    if twice:
        raise SourceError(f"keys in several files: {sorted(r['key'] for r in twice)}")
    return flat


def bank_union(spark: SparkSession, folder: str, pattern: str, schema: str) -> DataFrame:
    """bank_entries() of a folder's files."""
    return bank_entries(whole_files(spark, folder, pattern), schema, f"{pattern} in {folder}")


def frames_of(entries: DataFrame, locale: str, target: int = 500, cap: int = 12) -> DataFrame:
    """(locale, skill_id, target, cap, frame_ord, text, args, src_file) of a locale's frame banks' entries."""
    each = entries.select("file_name", F.col("key").alias("skill_id"), F.coalesce("value.target", F.lit(target)).alias("target"), F.coalesce("value.cap", F.lit(cap)).alias("cap"), F.posexplode("value.frames").alias("frame_ord", "f"))
    return each.select(F.lit(locale).alias("locale"), "skill_id", "target", "cap", "frame_ord", "f.text", F.coalesce("f.args", F.create_map().cast("map<string,string>")).alias("args"), F.col("file_name").alias("src_file"))


def frames(spark: SparkSession, folder: str, locale: str, target: int = 500, cap: int = 12) -> DataFrame:
    return frames_of(bank_union(spark, folder, f"*frames*.{locale}.json", FRAME_BANK), locale, target, cap)


def slots_of(entries: DataFrame) -> DataFrame:
    """(slot, val_ord, surface, canonical): listed values, and ranges of whole numbers written out."""
    listed = F.from_json("value", "array<struct<surface:string,canonical:string>>")
    ranged = F.from_json("value", "struct<type:string,min:bigint,max:bigint>")
    is_list = F.startswith(F.trim("value"), F.lit("["))
    values = entries.where(is_list).select(F.col("key").alias("slot"), F.posexplode(listed).alias("val_ord", "v")).select("slot", F.col("val_ord").cast("long").alias("val_ord"), "v.surface", "v.canonical")
    numbers = entries.where(~is_list).select(F.col("key").alias("slot"), ranged.alias("r")).where("r.type = 'int'")
    numbers = numbers.select("slot", F.explode(F.sequence("r.min", "r.max")).alias("v"), "r.min").select("slot", (F.col("v") - F.col("min")).alias("val_ord"), F.col("v").cast("string").alias("surface"), F.col("v").cast("string").alias("canonical"))
    return values.unionByName(numbers)


def slots(spark: SparkSession, folder: str, locale: str) -> DataFrame:
    return slots_of(bank_union(spark, folder, f"*slots*.{locale}.json", SLOT_BANK))


def banked_ids(entries: DataFrame) -> DataFrame:
    """(skill_id) that have a bank."""
    return entries.select(F.col("key").alias("skill_id")).distinct()


def bank_texts(frame_rows: DataFrame, example_rows: DataFrame) -> DataFrame:
    """(skill_id, text): a skill's frames and the texts of its examples, as prompts list them."""
    return frame_rows.select("skill_id", "text").unionByName(example_rows.select("skill_id", "text"))


def cases_of(lines: DataFrame) -> DataFrame:
    """(file, utterance, expect) of JSON lines (file, value); blank lines and // comments are passed over, bad ones are errors."""
    lines = lines.select("file", F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("line")).where("line <> ''").where(~F.startswith("line", F.lit("//")))
    return lines.select("file", F.from_json("line", "utterance string, expect string", {"mode": "FAILFAST"}).alias("c")).select("file", "c.utterance", "c.expect")


def eval_cases(spark: SparkSession, paths: list[str]) -> DataFrame:
    """cases_of() files; missing files are passed over."""
    found = [p for p in paths if _exists(spark, p)]
    if not found:
        return spark.createDataFrame([], "file string, utterance string, expect string")
    return cases_of(spark.read.text(found).select(F.col("_metadata.file_name").alias("file"), "value"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def eval_keys(cases: DataFrame) -> DataFrame:
    return cases.select(loose_key(F.col("utterance")).alias("key")).distinct()


def none_cases(cases: DataFrame) -> DataFrame:
    return cases.where(F.upper("expect") == "NONE")


VERDICT = "VERBOSE\t"
THRESHOLD = r"MIN_ROUTER_CONFIDENCE\s*=\s*(-?[0-9.]+)"


def verdict_cases(lines: DataFrame) -> DataFrame:
    """(category, conf, expect, pick, utterance) of a log's verdict lines (value); lines with fewer than six parts are errors.

    The sixth part of a line may hold tabs. A pick that is just NONE, or a confidence that is not a
    number, makes both null.
    """
    own = lines.where(F.startswith("value", F.lit(VERDICT))).select(F.split("value", "\t", 6).alias("p"))
    whole = F.when(F.size("p") == 6, F.col("p")).otherwise(F.raise_error(F.concat(F.lit("a verdict lacks parts: "), F.array_join("p", " | "))))
    own = own.select(whole.alias("p"))
    conf = F.col("p")[2].cast("double")
    nothing = (F.col("p")[4] == "NONE") | F.isnan(conf)
    return own.select(F.col("p")[1].alias("category"), F.when(~nothing, conf).alias("conf"), F.col("p")[3].alias("expect"), F.when(~nothing, F.col("p")[4]).alias("pick"), F.col("p")[5].alias("utterance"))


def last_threshold(lines: DataFrame) -> DataFrame:
    """One row (threshold): that of the last line (place, value) that states one, or null."""
    stated = lines.select("place", F.nullif(F.regexp_extract("value", THRESHOLD, 1), F.lit("")).cast("double").alias("t")).where("t IS NOT NULL")
    return stated.agg(F.max_by("t", "place").alias("threshold"))


def verdicts(spark: SparkSession, path: str) -> tuple[DataFrame, float | None]:
    """verdict_cases() of a log, and the last threshold it states."""
    # ids ascend within a split; splits are told apart by where they start
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    lines = spark.read.text(path).select("value", place.alias("place"))
    cut = F.startswith("value", F.lit(VERDICT)) & (F.size(F.split("value", "\t", 6)) != 6)
    if lines.where(cut).take(1):
        raise SourceError(f"a verdict of {path} lacks parts")
    return verdict_cases(lines), last_threshold(lines).first()[0]


def heads_of(files: DataFrame, parse=None) -> DataFrame:
    """(dir, file_name, head) of manifests (dir, file_name, value): the front matter as JSON text, null where there is none or a bad one.

    parse turns YAML text into a value; where none is given, the installed YAML library does. Rows
    without a head stay: a folder's manifest is chosen by its name, before its content is looked at.
    """
    import json

    raw = files.select("dir", "file_name", F.regexp_extract("value", r"(?s)\A---(.*?)\n---", 1).alias("head"))
    if parse is None:
        parse = _yaml().safe_load

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(text: str) -> str | None:
            try:
                value = parse(text)
            except Exception:  # whatever a parser raises, the file has no usable head
                return None
            return json.dumps(value, ensure_ascii=False, default=str) if isinstance(value, dict) else None

        for pdf in batches:
            yield pdf.assign(head=pdf["head"].map(one))

    return raw.mapInPandas(heads, "dir string, file_name string, head string")


def _yaml() -> object:
    try:
        import yaml
    except ImportError as missing:
        raise SourceError("front matter needs a YAML parser, which isn't installed") from missing
    return yaml


def front_matter(spark: SparkSession, folder: str, pattern: str = "SKILL*.md", parse=None) -> DataFrame:
    """heads_of() the files in all folders below one."""
    files = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(folder, wholetext=True)
    return heads_of(files.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("dir"), F.col("_metadata.file_name").alias("file_name"), "value"), parse)


MANIFEST = "struct<description:string,metadata:struct<skill:struct<id:string,type:string,examples:array<struct<text:string,args:map<string,string>>>>>>"


def skills_of(heads: DataFrame, locale: str, schema: str = MANIFEST) -> DataFrame:
    """(dir, id, description, examples) of each folder's manifest: the locale's, else the English one, else the plain one.

    The file is chosen by name alone: where the chosen one has no usable head the folder has no skill.
    Assistants go, and skills without id, description or examples with text, white space too.
    """
    from ..operators.catalog import pick_locale

    best = pick_locale(heads, locale).where("head IS NOT NULL").select("dir", F.from_json("head", schema).alias("h"))
    out = best.select("dir", "h.metadata.skill.id", "h.metadata.skill.type", "h.description", "h.metadata.skill.examples")
    clean = F.filter("examples", lambda e: F.coalesce(e["text"], F.lit("")) != "")
    out = out.where((F.coalesce("type", F.lit("")) != "assistant") & (F.coalesce("id", F.lit("")) != "") & (F.coalesce("description", F.lit("")) != ""))
    return out.withColumn("examples", clean).where(F.size("examples") > 0).drop("type")


SKILL = "struct<id:string,description:string,parameters:string,router_eligible:boolean,examples:array<struct<text:string,args:map<string,string>>>>"


def exported_skills(files: DataFrame) -> DataFrame:
    """(id, description, parameters, router_eligible, examples) of exported JSON arrays (value); a missing eligibility flag counts as eligible."""
    each = files.select(F.explode(F.from_json("value", f"array<{SKILL}>")).alias("s")).select("s.*")
    return each.withColumn("router_eligible", F.coalesce("router_eligible", F.lit(True)))


def skill_export(spark: SparkSession, path: str) -> DataFrame:
    return exported_skills(spark.read.text(path, wholetext=True))


def ledger_of(files: DataFrame) -> DataFrame:
    """(skill_id, locale, sha256) of ledgers (value): JSON maps of maps."""
    whole = files.select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("skill_id", "l"))
    return whole.select("skill_id", F.explode("l").alias("locale", "sha256"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """ledger_of() a file; no rows where it is absent."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "skill_id string, locale string, sha256 string")
    return ledger_of(spark.read.text(path, wholetext=True))


def samples(spark: SparkSession, path: str, schema: str) -> dict[str, DataFrame]:
    """A JSON-lines data set, its rows for training and for evaluation."""
    df = spark.read.schema(schema).json(path)
    return {kind: df.where(F.col("metadata") == kind) for kind in ("train", "eval")}


def samples_of(lines: DataFrame, schema: str, kind: str) -> DataFrame:
    """The rows of one kind of a data set's JSON lines (value)."""
    return lines.select(F.from_json("value", schema).alias("s")).select("s.*").where(F.col("metadata") == kind)


def sidecars_of(files: DataFrame) -> DataFrame:
    """(clip, device) of sidecars (file_name, value): the first line that begins with 'transcript:', after it; null without one."""
    text = F.regexp_extract("value", r"(?m)^transcript:(.*)$", 1)
    return files.select(F.regexp_replace("file_name", r"\.[^.]*$", "").alias("clip"), F.when(F.col("value").rlike(r"(?m)^transcript:"), F.trim(text)).alias("device"))


def sidecars(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    return sidecars_of(whole_files(spark, folder, pattern))


def cpu_ticks(df: DataFrame, stat: str = "stat") -> DataFrame:
    """df with ticks: user and system time of a process's stat line, whose name may hold spaces and brackets."""
    rest = F.split(F.regexp_extract(stat, r"^.*\) (.*)$", 1), " ")
    return df.withColumn("ticks", (rest[11].cast("long") + rest[12].cast("long")))


def first_present(listing: DataFrame, group: str, name: str, wanted: list[str]) -> DataFrame:
    """(group, name): the first of the wanted files that each folder has."""
    rank = F.array_position(F.array(*map(F.lit, wanted)), F.col(name))
    return listing.where(rank > 0).groupBy(group).agg(F.min_by(name, rank).alias(name))
