"""A/B comparisons: transcripts of models over clips, CPU use of two windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Models of one comparison.
MOST_MODELS = 100


def ab_compare(clips: DataFrame, transcripts: DataFrame, sidecars: DataFrame, models: DataFrame) -> DataFrame:
    """(model, clip, transcript, device, differs) of all models and clips; differs if the device has a transcript that is another one.

    The models to compare are named by hand, at most MOST_MODELS; each clip is repeated for each.
    """
    names = [r["model"] for r in models.select("model").distinct().limit(MOST_MODELS + 1).collect()]
    if len(names) > MOST_MODELS:
        raise ValueError(f"more than {MOST_MODELS} models")
    each = clips.withColumn("model", F.explode(F.array(*map(F.lit, sorted(names))).cast("array<string>")))
    both = each.join(transcripts, ["model", "clip"], "left").join(sidecars, "clip", "left")
    return both.withColumn("differs", F.coalesce(F.col("device").isNotNull() & ~F.col("device").eqNullSafe(F.col("transcript")), F.lit(False)))


def model_diff(transcripts: DataFrame, a: str, b: str) -> DataFrame:
    """(clip, text_a, text_b) where two models differ."""
    left = transcripts.where(F.col("model") == a).select("clip", F.col("transcript").alias("text_a"))
    right = transcripts.where(F.col("model") == b).select("clip", F.col("transcript").alias("text_b"))
    return left.join(right, "clip").where(~F.col("text_a").eqNullSafe(F.col("text_b")))


def variant_diff(transcripts: DataFrame, base: str) -> DataFrame:
    """(model, clip, variant, transcript) of the ways of decoding, such as without the end's flush or with silence added, whose transcript isn't the base way's."""
    own = transcripts.where(F.col("variant") == base).select("model", "clip", F.col("transcript").alias("__base"))
    others = transcripts.where(F.col("variant") != base).join(own, ["model", "clip"])
    return others.where(~F.col("transcript").eqNullSafe(F.col("__base"))).select("model", "clip", "variant", "transcript")


def two_places(value: Column) -> Column:
    """value to two places: 100 times it to a whole number, halves away from 0, as round() of DuckDB; F.round goes by the digits that are printed, so that 44.825 less its last bit becomes 44.82."""
    return F.round(value * 100, 0) / 100


def cpu_cost(samples: DataFrame, group: str) -> DataFrame:
    """(group, label, pct) per window: used seconds of the elapsed ones in percent, to two places; windows in which the process changed have none."""
    pct = two_places(F.col("ticks") / F.col("clk_tck") / F.nullif(F.col("elapsed"), F.lit(0)) * 100)
    return samples.select(group, "label", F.when(F.col("pid_before").eqNullSafe(F.col("pid_after")), pct).alias("pct"))


def cpu_delta(samples: DataFrame, group: str, first: str, second: str) -> DataFrame:
    """(group, pct_first, pct_second, delta): what the first window, with the feature on, used more than the second; the difference of the rounded values."""
    cost = cpu_cost(samples, group)
    wide = cost.groupBy(group).agg(F.max(F.when(F.col("label") == first, F.col("pct"))).alias("pct_first"), F.max(F.when(F.col("label") == second, F.col("pct"))).alias("pct_second"))
    return wide.withColumn("delta", two_places(F.col("pct_first") - F.col("pct_second")))
