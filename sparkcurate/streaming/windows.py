"""Count windows over keyed streams of samples, with the rest flushed at the end, and event-time windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Samples of a window of a tenth of a second.
WINDOW_SAMPLES = 1_600


def count_windows(df: DataFrame, key: str, pos: str, value: Column, size: int = WINDOW_SAMPLES) -> DataFrame:
    """(key, window, n, total) of each size positions; the last window of a key may be shorter."""
    return df.groupBy(key, F.floor(F.col(pos) / size).alias("window")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def stream_count_windows(stream: DataFrame, key: str, value: str, size: int, end: str) -> DataFrame:
    """(key, window, n, total) of each size rows as they arrive; a batch with a row whose end flag is set flushes what is left after it.

    State per key: number of the window, rows and sum in it. Batches of rows are summed whole.
    """
    out, state_schema = "key string, window long, n long, total double", "window long, n long, total double"

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        window, n, total = state.get if state.exists else (0, 0, 0.0)
        for pdf in batches:
            values = pdf[value].to_numpy(dtype=float)
            # windows end after the rows that fill them; the first takes in what the state holds
            ends = np.arange(size - n, len(values) + 1, size)
            before = np.concatenate([[0], ends])
            sums = np.add.reduceat(values[: ends[-1]], before[:-1]) if len(ends) else np.zeros(0)
            rest = values[before[-1] :]
            if len(ends):
                sums[0] += total
                yield pd.DataFrame({"key": k[0], "window": window + np.arange(len(ends)), "n": size, "total": sums})
                window, n, total = window + len(ends), 0, 0.0
            n, total = n + len(rest), total + float(rest.sum())
            if n and bool(pdf[end].any()):
                yield pd.DataFrame({"key": [k[0]], "window": [window], "n": [n], "total": [total]})
                window, n, total = window + 1, 0, 0.0
        state.update((int(window), int(n), float(total)))

    keyed = stream.select(F.col(key).cast("string").alias("key"), value, end)
    return keyed.groupBy("key").applyInPandasWithState(step, out, state_schema, "append", "NoTimeout")


def event_windows(events: DataFrame, length: str, late: str | None = None) -> DataFrame:
    """(start, event_type, n, total) in tumbling windows of event time; for streams late is the watermark."""
    if late:
        events = events.withWatermark("ts", late)
    agg = events.groupBy(F.window("ts", length), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return agg.select(F.col("window.start").alias("start"), "event_type", "n", "total")
