"""Sinks: JSON lines, evaluation files with comments, ledgers, key=value outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.catalog import ledger_upsert
from .text_files import ledger_of
from .versions import change_version, publish_version


def write_samples(df: DataFrame, path: str) -> None:
    """Samples as JSON lines, in a folder for each of train and eval, letters unescaped."""
    df.write.mode("overwrite").partitionBy("metadata").json(path)


def sample_lines(df: DataFrame, order: list[str]) -> DataFrame:
    """(part, value): each sample as a line of JSON, letters unescaped; part 0 for training comes before part 1."""
    part = (F.col("metadata") != "train").cast("int")
    return df.select(part.alias("part"), *order, F.to_json(F.struct(*(c for c in df.columns if c not in order))).alias("value"))


def write_sample_lines(df: DataFrame, order: list[str], path: str) -> None:
    """sample_lines() as text files whose names ascend with part and order."""
    sample_lines(df, order).repartitionByRange("part", *order).sortWithinPartitions("part", *order).select("value").write.mode("overwrite").text(path)


def eval_lines(cases: DataFrame, header: list[str]) -> DataFrame:
    """(value), in order: comments, then each skill's cases in order of its id, NONE last."""
    return numbered_eval_lines(cases, header).orderBy("line").select("value")


def numbered_eval_lines(cases: DataFrame, header: list[str]) -> DataFrame:
    """(line, value): eval_lines() with their numbers, from 1; an evaluation file is small, and one task numbers it."""
    comments = cases.sparkSession.range(1).select(F.posexplode(F.array(*(F.lit(f"// {h}") for h in header))).alias("k", "value"))
    own = cases.select((F.upper("expect") == "NONE").alias("none"), F.col("expect").alias("skill"), F.col("ord").cast("long").alias("k"), F.to_json(F.struct("utterance", "expect")).alias("value"))
    both = comments.select(F.lit(-1).alias("part"), F.lit("").alias("skill"), F.col("k").cast("long").alias("k"), "value").unionByName(own.select(F.col("none").cast("int").alias("part"), "skill", "k", "value"))
    return both.select(F.row_number().over(Window.orderBy("part", "skill", "k", "value")).alias("line"), "value")


def write_eval(cases: DataFrame, header: list[str], path: str) -> None:
    eval_lines(cases, header).coalesce(1).write.mode("overwrite").text(path)


def ledger_lines(ledger: DataFrame) -> DataFrame:
    """(value): a ledger (skill_id, locale, sha256) as JSON, a map of each skill's locales, in order; each skill has a line."""
    locales = F.map_from_entries(F.array_sort(F.collect_list(F.struct("locale", "sha256"))))
    each = ledger.groupBy("skill_id").agg(locales.alias("l"))
    return each.select("skill_id", F.to_json(F.create_map("skill_id", "l")).alias("value"))


def write_ledger(ledger: DataFrame, root: str, began_from: int | None = None) -> int:
    """The ledger as the next version of root, beside the one that it may be made from; its number."""
    lines = ledger_lines(ledger).repartitionByRange(1, "skill_id").sortWithinPartitions("skill_id").select("value")
    return publish_version(lines, root, began_from, "text")


def change_ledger(spark: SparkSession, root: str, new: DataFrame, only: list[str] | None = None) -> int:
    """ledger_upsert() of what is published in root, as its next version; made anew where another writer was first."""

    def change(old: DataFrame | None) -> DataFrame:
        known = new.limit(0) if old is None else ledger_of(old)
        return ledger_lines(ledger_upsert(known, new, ["skill_id", "locale"], "sha256", only)).select("value")

    return change_version(spark, root, change, form="text")


def write_manifests(manifests: DataFrame, root: str, began_from: int | None = None) -> int:
    """Manifests (group, version, ...) as the next version of root: a line of JSON each; readers see all of them or those before."""
    return publish_version(manifests.select(F.to_json(F.struct("*")).alias("value")), root, began_from, "text")


def draft_files(drafts: DataFrame, locale: str) -> DataFrame:
    """(file_name, value): each skill's drafted frames (skill_id, target, cap, frame_ord, text, args) as a bank's JSON in a file of its own, whose name scans pass over."""
    frames = F.array_sort(F.collect_list(F.struct("frame_ord", "text", "args")), lambda a, b: (a["frame_ord"] - b["frame_ord"]).cast("int"))
    each = drafts.groupBy("skill_id").agg(F.max("target").alias("target"), F.max("cap").alias("cap"), F.transform(frames, lambda x: F.struct(x["text"].alias("text"), x["args"].alias("args"))).alias("frames"))
    name = F.concat(F.lit("draft-frames."), F.col("skill_id"), F.lit(f".{locale}.json"))
    return each.select(name.alias("file_name"), F.to_json(F.create_map("skill_id", F.struct("target", "cap", "frames"))).alias("value"))


def write_drafts(drafts: DataFrame, locale: str, folder: str) -> None:
    """draft_files() as files of these names; a few, for people to review, written through Hadoop's file system API."""
    spark = drafts.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(folder)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    for row in draft_files(drafts, locale).toLocalIterator():
        out = fs.create(hadoop.Path(base, row["file_name"]), True)
        try:
            out.write(bytearray(row["value"].encode()))
        finally:
            out.close()


def key_value_lines(df: DataFrame) -> DataFrame:
    """(k, value): a line of key=value for each column of each row, in order of the columns; nulls are empty."""
    pairs = F.array(*(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in df.columns))
    return df.select(F.posexplode(pairs).alias("k", "value"))


def key_values(row: dict) -> str:
    """Lines of key=value for a build's outputs."""
    return "".join(f"{k}={v}\n" for k, v in row.items())
