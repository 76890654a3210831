"""Rows that can't be made, kept apart with the reason: errors are data, and good and bad rows go to two places in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .assemble import rendered, turns


def tried(value: Column, *reasons: tuple[Column, str]) -> Column:
    """(value, reason): the first reason whose condition holds, without a value; else the value. A null condition doesn't hold; a null value without a reason fails as 'null'."""
    reason = F.lit(None).cast("string")
    for condition, name in reversed(reasons):
        reason = F.when(F.coalesce(condition, F.lit(False)), F.lit(name)).otherwise(reason)
    reason = F.coalesce(reason, F.when(value.isNull(), F.lit("null")))
    return F.struct(F.when(reason.isNull(), value).alias("value"), reason.alias("reason"))


def write_apart(df: DataFrame, reason: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of df, written in one pass as the folders ok=true and ok=false of path, and read again; good ones are those without a reason."""
    df.withColumn("ok", F.col(reason).isNull()).write.partitionBy("ok").parquet(path)
    back = df.sparkSession.read.schema(df.withColumn("ok", F.lit(True)).schema).parquet(path)
    return back.where("ok").drop("ok", reason), back.where("NOT ok").drop("ok")


def training_rows(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, prompt, completion, reason): of each conversation the rendered turns before its last one, and what the whole has beyond them.

    The prompt ends with the opening of the last turn; the completion is cut from the rendering of the whole by the prompt's
    length. Conversations that can't be used have a reason, and no prompt or completion: 'turn' (a turn without a
    number, or twice the same), 'role' (a turn without a role), 'end' (the last turn isn't the assistant's), 'prefix' (the whole doesn't begin with the
    prompt), 'blank' (nothing but white space and the turn's end).
    """
    t = turns(conversations, id_col)
    last = F.element_at("turns", -1)
    before = F.slice("turns", 1, F.size("turns") - 1)
    whole = F.array_join(F.transform("turns", rendered), "")
    prompt = F.concat(F.array_join(F.transform(before, rendered), ""), F.lit("<start_of_turn>assistant\n"))
    numbers = F.transform("turns", lambda x: x["turn"])
    made = t.select(id_col, "turns", last["role"].alias("role"), whole.alias("whole"), prompt.alias("prompt"), numbers.alias("numbers"))
    rest = F.expr("substring(whole, length(prompt) + 1)")
    made = made.withColumn("completion", rest)
    both = tried(
        F.struct("prompt", "completion"),
        (F.exists("numbers", lambda x: x.isNull()) | (F.size(F.array_distinct("numbers")) < F.size("numbers")), "turn"),
        (F.exists("turns", lambda x: x["role"].isNull()), "role"),
        (F.col("role") != "assistant", "end"),
        (~F.startswith("whole", F.col("prompt")), "prefix"),
        (F.regexp_replace(F.regexp_replace("completion", "<end_of_turn>", ""), r"(?U)\s+", "") == "", "blank"),
    )
    return made.select(id_col, both.alias("t")).select(id_col, "t.value.prompt", "t.value.completion", "t.reason")
