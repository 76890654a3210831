"""Windows of a set number of samples over live keyed streams: samples in any order, silence at the end, a timer that flushes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUT = "key string, window long, n long, total double"
#: The state store that lists and timers need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SampleWindows(StatefulProcessor):
    """Windows of size samples by their positions, for one key.

    State: one value with the first position of the next window and its number, the last time, whether a timer runs, and
    the samples that wait, as bytes: 8 a position, then 8 a value. So it holds less than a window of samples in sequence, and
    those that came before their turn, and a key takes one read and one write a batch, each of which is a call to the JVM.
    """

    def __init__(self, size: int, pad: int, idle_ms: int) -> None:
        self.size, self.pad, self.idle_ms = size, pad, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("samples", "pos long, window long, last long, timed boolean, held binary")

    def _read(self) -> tuple[int, int, int, bool, np.ndarray, np.ndarray]:
        first, window, last, timed, held = self.state.get() or (0, 0, 0, False, b"")
        half = len(held) // 2
        return first, window, last, timed, np.frombuffer(held[:half], np.int64), np.frombuffer(held[half:], np.float64)

    def _windows(self, key, first: int, values: np.ndarray) -> Iterator[Row]:
        starts = np.arange(0, len(values), self.size)
        sizes = np.minimum(self.size, len(values) - starts)
        for k, (n, total) in enumerate(zip(sizes.tolist(), np.add.reduceat(values, starts).tolist(), strict=True)):
            yield Row(key=key, window=first + k, n=n, total=total)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, window, last, timed, pos, value = self._read()
        came = [(r.pos, r.value, r.ms) for r in rows]
        pos, value = np.append(pos, np.array([r[0] for r in came], np.int64)), np.append(value, np.array([r[1] for r in came], np.float64))
        last = max([last, *(r[2] for r in came)])
        order = np.argsort(pos, kind="stable")
        pos, value = pos[order], value[order]
        # a position that was told before, or that a window has, counts once
        once = (pos >= first) & np.concatenate([[True], pos[1:] != pos[:-1]])
        pos, value = pos[once], value[once]
        run = int(np.argmin(np.append(pos == first + np.arange(len(pos)), False)))
        whole = run // self.size * self.size
        if whole:
            yield from self._windows(key[0], window, value[:whole])
        if not timed:
            self.handle.registerTimer(last + self.idle_ms)
        self._keep(first + whole, window + whole // self.size, last, True, pos[whole:], value[whole:])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first, window, last, _, pos, value = self._read()
        if last + self.idle_ms > timerValues.getCurrentWatermarkInMs():  # samples came since: the timer is set on only now, not at each batch
            self.handle.registerTimer(last + self.idle_ms)
            return
        value = np.append(value, np.zeros(self.pad))
        if len(value):
            yield from self._windows(key[0], window, value)
        end = int(pos[-1]) + 1 if len(pos) else first
        self._keep(end, window + -(-len(value) // self.size), last, False, pos[:0], value[:0])

    def _keep(self, first: int, window: int, last: int, timed: bool, pos: np.ndarray, value: np.ndarray) -> None:
        self.state.update((int(first), int(window), int(last), timed, pos.tobytes() + value.tobytes()))

    def close(self) -> None:
        pass


def live_windows(stream: DataFrame, key: str, pos: str, value: str, ts: str, size: int, pad: int = 0, idle: int = 10, late: str = "1 minute") -> DataFrame:
    """(key, window, n, total) of each size samples, as soon as all of them are there, by their positions from 0 on.

    Samples of a key may come in any order, in a batch and between batches, up to late after others in event
    time (ts). When the watermark has passed a key's last sample by idle seconds, pad samples of silence are appended and what
    is left is flushed: windows in order of position, gaps closed, the last one shorter. Samples that come after that go on with
    the next position and window. A position that repeats counts once; rows with a null position, value or time are ignored, and a null key is a key.
    The session must keep its state in RocksDB (PROVIDER).
    """
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(pos).cast("long").alias("pos"), F.col(value).cast("double").alias("value"), F.col(ts).alias("ts"))
    rows = rows.where("pos IS NOT NULL AND value IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", late)
    rows = rows.withColumn("ms", F.unix_millis("ts"))
    return rows.groupBy("key").transformWithState(SampleWindows(size, pad, idle * 1_000), OUT, "append", "EventTime")
