"""Evaluation at a confidence floor, sweeps over all floors, accuracy by stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_call, percent


def fires(floor: Column | float) -> Column:
    """Whether a pick is made at the floor: there is one, and its confidence reaches it."""
    return F.col("pick").isNotNull() & F.coalesce(F.col("conf") >= floor, F.lit(False))


def abstains() -> Column:
    """Whether nothing should fire: the expected label is NONE, in any case."""
    return F.upper(F.col("expect")) == "NONE"


def rates(df: DataFrame) -> DataFrame:
    """precision, abstention and recall from counts; without anything fired or any NONE case they are 1, without positives recall is 0."""

    def share(part: str, whole: str, empty: float) -> Column:
        return F.when(F.col(whole) == 0, F.lit(empty)).otherwise(F.col(part) / F.col(whole))

    return df.withColumns({"precision": share("correct", "fired", 1.0), "abstention": share("abst_pass", "abst_total", 1.0), "recall": share("correct", "pos_total", 0.0)})


def gate_metrics(verdicts: DataFrame, floor: float, groups: list[str] | None = None) -> DataFrame:
    """fired, correct, abst_pass, abst_total, pos_total and the three rates of verdicts (conf, expect, pick).

    Positives are the cases whose expected label isn't NONE; fired and correct count them alone, so
    that a NONE case that fires lowers the abstention and not the precision.
    """
    none, on = F.coalesce(abstains(), F.lit(False)), fires(floor)
    counts = verdicts.groupBy(*(groups or [])).agg(
        F.count_if(~none & on).alias("fired"),
        F.count_if(~none & on & F.coalesce(F.col("pick") == F.col("expect"), F.lit(False))).alias("correct"),
        F.count_if(none & ~on).alias("abst_pass"),
        F.count_if(none).alias("abst_total"),
        F.count_if(~none).alias("pos_total"),
    )
    return rates(counts)


#: Ranges of confidences whose sums are made apart in a sweep.
RANGES = 256


def floor_sweep(verdicts: DataFrame) -> DataFrame:
    """gate_metrics for each confidence that occurs, as floor.

    Rows are counted per confidence first; then running sums from the highest down go over one row for
    each distinct value, in ranges of about as many values each: a range's own sums, and those of all
    ranges above it.
    """
    none = F.coalesce(abstains(), F.lit(False))
    able = F.col("pick").isNotNull() & F.col("conf").isNotNull()
    right = F.coalesce(F.col("pick") == F.col("expect"), F.lit(False))
    per = verdicts.where(able).groupBy(F.col("conf").alias("floor")).agg(F.count_if(~none).alias("n"), F.count_if(~none & right).alias("c"), F.count_if(none).alias("q"))
    cuts = per.agg(F.percentile_approx("floor", [k / RANGES for k in range(1, RANGES)], 4 * RANGES)).first()[0] or []
    bounds = F.array(*(F.lit(float(x)) for x in sorted(set(cuts)))).cast("array<double>")
    per = per.withColumn("range", F.size(F.filter(bounds, lambda x: x <= F.col("floor"))))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = per.groupBy("range").agg(*(F.sum(x).alias(x) for x in "ncq"))
    ranges = ranges.select("range", *(F.coalesce(F.sum(x).over(above), F.lit(0)).alias(f"{x}_above") for x in "ncq"))
    within = Window.partitionBy("range").orderBy(F.desc("floor")).rowsBetween(Window.unboundedPreceding, 0)
    sums = per.select("floor", "range", *(F.sum(x).over(within).alias(x) for x in "ncq")).join(F.broadcast(ranges), "range")
    totals = verdicts.agg(F.count_if(none).alias("abst_total"), F.count_if(~none).alias("pos_total"))
    swept = sums.crossJoin(F.broadcast(totals)).select(
        "floor",
        (F.col("n") + F.col("n_above")).alias("fired"),
        (F.col("c") + F.col("c_above")).alias("correct"),
        (F.col("abst_total") - F.col("q") - F.col("q_above")).alias("abst_pass"),
        "abst_total",
        "pos_total",
    )
    return rates(swept)


def viable(swept: DataFrame, precision_min: float = 0.9, abstain_min: float = 0.9, min_fired: int = 10, floor_min: float = -0.5) -> DataFrame:
    return swept.where((F.col("precision") >= precision_min) & (F.col("abstention") >= abstain_min) & (F.col("fired") >= min_fired) & (F.col("floor") >= floor_min))


def derive_floor(verdicts: DataFrame, compiled: float, precision_min: float = 0.9, abstain_min: float = 0.9, min_fired: int = 10, floor_min: float = -0.5) -> DataFrame:
    """One row (floor, source): the lowest viable floor over all verdicts, if the spine alone confirms its precision and abstention; else the compiled one.

    verdicts have a source, spine or generated. Without generated ones, without any viable floor or
    without confirmation the source is fallback. Without spine verdicts nothing can be confirmed: an error.
    """
    if not verdicts.where("source = 'spine'").take(1):
        raise ValueError("no spine verdicts")
    best = viable(floor_sweep(verdicts), precision_min, abstain_min, min_fired, floor_min).agg(F.min("floor").alias("floor"))
    row = best.first()
    has_generated = bool(verdicts.where("source <> 'spine'").take(1))
    if row["floor"] is None or not has_generated:
        return verdicts.sparkSession.range(1).select(F.lit(float(compiled)).alias("floor"), F.lit("fallback").alias("source"))
    spine = gate_metrics(verdicts.where("source = 'spine'"), row["floor"])
    good = (F.col("precision") >= precision_min) & (F.col("abstention") >= abstain_min)
    return spine.select(F.when(good, F.lit(row["floor"])).otherwise(F.lit(float(compiled))).alias("floor"), F.when(good, "derived").otherwise("fallback").alias("source"))


NO_CALL = "__none__"


def parse_call(df: DataFrame, known: DataFrame, raw: str = "raw", pattern: str = r"<start_function_call>call:(\w+)\{", hallucination_abstains: bool = False) -> DataFrame:
    """predicted: the known skill called, NONE without a call; an unknown name is marked, and so never right, or counts as none if told so."""
    names = known.select(F.col("name").alias("__name")).distinct()
    both = df.withColumn("__name", first_call(F.col(raw), pattern)).join(names.withColumn("__known", F.lit(True)), "__name", "left")
    unknown = F.lit(NO_CALL) if hallucination_abstains else F.concat(F.lit("__hallucinated:"), F.col("__name"), F.lit("__"))
    return both.withColumn("predicted", F.when(F.col("__name").isNull(), NO_CALL).when(F.col("__known"), F.col("__name")).otherwise(unknown)).drop("__name", "__known")


def unknown_expected(df: DataFrame, known: DataFrame) -> DataFrame:
    """(expected): labels that are expected and that the catalogue lacks."""
    wanted = df.where("expected IS NOT NULL").select("expected").distinct()
    return wanted.join(known.select(F.col("name").alias("expected")), "expected", "left_anti")


def check_expected(df: DataFrame, known: DataFrame) -> None:
    """An error where a label is expected that the catalogue lacks."""
    odd = unknown_expected(df, known).limit(20).collect()
    if odd:
        raise ValueError(f"unknown expected labels: {sorted(r['expected'] for r in odd)}")


def stratified_accuracy(df: DataFrame, stratum: str, correct: str = "correct") -> DataFrame:
    """(stratum, n, n_correct, accuracy) of each stratum and of all, whose stratum is null and is_total true."""
    agg = df.rollup(stratum).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(correct)).alias("n_correct"), (F.grouping(stratum) == 1).alias("is_total"))
    return agg.select(stratum, "is_total", "n", "n_correct", (F.col("n_correct") / F.nullif(F.col("n"), F.lit(0))).alias("accuracy"))


def per_group_floors(groups: DataFrame, rows: DataFrame, group: str, hard: int = 3, warn: int = 10, none: str = "NONE", none_hard: int = 20) -> DataFrame:
    """(group, kept, status): fatal under hard, thin under warn, ok; groups without rows count.

    The group of cases that must abstain, named none, is fatal under none_hard and never thin: fewer
    can't tell a rate of abstention.
    """
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("kept"))
    both = groups.join(counts, group, "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    quiet = F.coalesce(F.col(group) == none, F.lit(False))
    status = F.when(quiet & (F.col("kept") < none_hard), "fatal").when(~quiet & (F.col("kept") < hard), "fatal").when(~quiet & (F.col("kept") < warn), "thin").otherwise("ok")
    return both.withColumn("status", status)


def latency(df: DataFrame, elapsed: str, group: str | None = None) -> DataFrame:
    """(group, n, total_seconds, mean_seconds) of all runs or of each group; sums are of microseconds, so no order of rows changes them."""
    micros = F.sum(F.bround(F.col(elapsed) * 1e6).cast("long"))
    agg = df.groupBy(*([group] if group else [])).agg(F.count(elapsed).alias("n"), (micros / F.lit(1e6)).alias("total_seconds"))
    return agg.withColumn("mean_seconds", F.col("total_seconds") / F.nullif(F.col("n"), F.lit(0)))


def max_width(df: DataFrame, name: str) -> DataFrame:
    """One row (width): characters of the longest name, 0 without any."""
    return df.agg(F.coalesce(F.max(F.length(name)), F.lit(0)).cast("long").alias("width"))


def report(metrics: DataFrame, label: str) -> DataFrame:
    """A line of text for each row of gate metrics; what fired is told of all positives."""
    line = F.concat(F.lit(f"{label}: precision "), percent(F.col("precision")), F.lit(", abstention "), percent(F.col("abstention")), F.lit(", recall "), percent(F.col("recall")))
    return metrics.select(F.concat(line, F.format_string(", %d of %d fired", "fired", "pos_total")).alias("line"))


def share(part: Column, whole: Column) -> Column:
    """'part/whole', whole numbers."""
    return F.format_string("%d/%d", part, whole)


def floor_report(metrics: DataFrame, label: str, floor: Column) -> DataFrame:
    """(line): a line of text for each row of gate metrics at a floor, with the counts behind each rate."""
    abstention = F.concat(F.lit("abstention "), share(F.col("abst_pass"), F.col("abst_total")), F.lit(" ("), percent(F.col("abstention")), F.lit(")"))
    precision = F.concat(F.lit("precision "), share(F.col("correct"), F.col("fired")), F.lit(" fired ("), percent(F.col("precision")), F.lit(")"))
    recall = F.concat(F.lit("recall "), share(F.col("correct"), F.col("pos_total")), F.lit(" ("), percent(F.col("recall")), F.lit(")"))
    return metrics.select(F.concat(F.format_string(f"{label.replace('%', '%%')} @ %.4f: ", floor), F.concat_ws(", ", abstention, precision, recall)).alias("line"))


def eval_report(runs: DataFrame, stratum: str, correct: str, elapsed: str, strata: list[str]) -> DataFrame:
    """(k, line) of a summary: each of the strata in their order, all, and the time a run takes; a stratum without runs has no percentage.

    One aggregate with partial sums of whole microseconds; a line each comes out of it.
    """
    counts = [(F.count_if(F.col(stratum) == x).alias(f"n{k}"), F.count_if((F.col(stratum) == x) & F.col(correct)).alias(f"c{k}")) for k, x in enumerate(strata)]
    micros = F.coalesce(F.sum(F.bround(F.col(elapsed) * 1e6).cast("long")), F.lit(0))
    row = runs.agg(*(c for pair in counts for c in pair), F.count(F.lit(1)).alias("n"), F.count_if(F.col(correct)).alias("c"), (micros / 1e6).alias("total"))

    def line(name: str, part: str, whole: str) -> Column:
        told = F.when(F.col(whole) > 0, F.concat(F.lit(" ("), percent(F.col(part) / F.col(whole)), F.lit(")"))).otherwise("")
        return F.concat(F.lit(f"  {name:5s}: "), share(F.col(part), F.col(whole)), told)

    lines = [line(x, f"c{k}", f"n{k}") for k, x in enumerate(strata)] + [line("total", "c", "n")]
    mean = F.when(F.col("n") > 0, F.format_string("%.3f", F.col("total") / F.nullif(F.col("n"), F.lit(0)))).otherwise("-")
    lines += [F.concat(F.lit("  Average inference time: "), mean, F.lit("s per query")), F.concat(F.lit("  Total time: "), F.format_string("%.1fs for %d queries", "total", "n"))]
    return row.select(F.posexplode(F.array(*lines)).alias("k", "line"))
