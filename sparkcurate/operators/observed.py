"""Guards that watch rows on their way to a sink: counted in the pass that writes them, and what was written counts only if all of them hold."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class GuardError(ValueError):
    """What guards have seen, by their names."""

    def __init__(self, failures: dict[str, str]) -> None:
        super().__init__("; ".join(f"{name}: {what}" for name, what in sorted(failures.items())))
        self.failures = failures


@dataclass
class Guards:
    """Conditions on the rows of one or more frames that go into one sink."""

    observations: list[tuple[Observation, list[str]]] = field(default_factory=list)

    def watch(self, df: DataFrame, bad: dict[str, Column], example: Column | None = None) -> DataFrame:
        """df, of which the rows are counted for which a condition in bad holds, by its name; the least example of each is told."""
        observation = Observation(f"guards-{uuid.uuid4().hex}")
        told = F.lit(None).cast("string") if example is None else example.cast("string")
        counts = []
        for k, condition in enumerate(bad.values()):
            holds = F.coalesce(condition, F.lit(False))
            counts += [F.count_if(holds).alias(f"n{k}"), F.min(F.when(holds, told)).alias(f"x{k}")]
        self.observations.append((observation, list(bad)))
        return df.observe(observation, *counts)

    def need(self, df: DataFrame, name: str, condition: Column, least: int = 1) -> DataFrame:
        """df, of which at least so many rows must meet a condition."""
        observation = Observation(f"guards-{uuid.uuid4().hex}")
        self.observations.append((observation, [(name, least)]))
        return df.observe(observation, F.count_if(F.coalesce(condition, F.lit(False))).alias("n0"))

    def failures(self) -> dict[str, str]:
        """What the frames showed, after an action on what they went into."""
        out = {}
        for observation, names in self.observations:
            seen = observation.get
            for k, name in enumerate(names):
                n = seen.get(f"n{k}") or 0
                if isinstance(name, tuple):
                    if n < name[1]:
                        out[name[0]] = f"{n} rows, {name[1]} are needed"
                elif n:
                    example = seen.get(f"x{k}")
                    out[name] = f"{n} rows" + (f", such as {example!r}" if example is not None else "")
        return out


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, hadoop


def write_guarded(df: DataFrame, path: str, guards: Guards, partition_by: tuple[str, ...] = (), form: str = "parquet") -> None:
    """Writes df, one pass over its inputs, beside path, and moves it there if no guard has failed; else it goes and GuardError tells all that failed.

    Nobody sees rows that a guard refuses. path must not be there yet.
    """
    spark = df.sparkSession
    fs, goal, hadoop = _fs(spark, path)
    if fs.exists(goal):
        raise FileExistsError(path)
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}.unchecked"
    try:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.format(form).save(beside)
        found = guards.failures()
        if found:
            raise GuardError(found)
        fs.mkdirs(goal.getParent())
        if not fs.rename(hadoop.Path(beside), goal):
            raise FileExistsError(path)
    finally:
        fs.delete(hadoop.Path(beside), True)
