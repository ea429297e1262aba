"""Stateful operators over event streams, each with a batch form of the same result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lodegraph.operators.ordering import carry_forward, islands
from lodegraph.plans.session import ship

WINDOW_US, MOST = 60_000_000, 10


def limit_fold(start: int | None, count: int, at: int, window: int, most: int) -> tuple[int, int, bool]:
    """A window opens at a key's first event and lasts ``window``; the first ``most`` events in it are allowed."""
    if start is None or at - start > window:
        return at, 1, True
    return start, count + 1, count + 1 <= most


def rate_limit(df: DataFrame, key: str, order: str, at: str, window: int = WINDOW_US, most: int = MOST) -> DataFrame:
    """(key, order, at, allowed) in batch. Rows of a key run through one task in order, in constant memory: only
    the open window is kept, however many rows a key has."""
    ship(df.sparkSession)
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, start, count = None, None, 0
        for b in batches:
            out = []
            for k, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k != now:
                    now, start, count = k, None, 0
                start, count, ok = limit_fold(start, count, t, window, most)
                out.append(ok)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.bool_())], [key, order, at, "allowed"])

    rows = df.select(key, order, at).repartition(key).sortWithinPartitions(key, at, order)
    return rows.mapInArrow(run, f"`{key}` {kinds[key]}, `{order}` {kinds[order]}, `{at}` {kinds[at]}, allowed boolean")


def limit_step(key: str, at: str, window: int, most: int, rows: int = 10_000):
    """The fold of a trigger: all events of a key in it by time, however many frames they come in, on top of the open
    window. Of an event only its time is held. The state goes when the watermark has passed the window's end."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        start, count = state.get if state.exists else (None, 0)
        times = np.sort(np.concatenate([np.empty(0, "i8"), *(f[at].to_numpy("i8") for f in frames)]))
        for i in range(0, len(times), rows):
            ok = []
            for t in times[i : i + rows].tolist():
                start, count, allowed = limit_fold(start, count, t, window, most)
                ok.append(allowed)
            yield pd.DataFrame({key: k[0], at: times[i : i + rows], "allowed": ok})
        if start is not None:
            state.update((start, count))
            state.setTimeoutTimestamp(max((start + window) // 1000 + 1, state.getCurrentWatermarkMs() + 1))

    return step


def rate_limit_stream(df: DataFrame, key: str, at: str, window: int = WINDOW_US, most: int = MOST, late: str = "1 minute") -> DataFrame:
    """The same over a stream, by event time (``at`` in microseconds): events of a trigger are taken in order, events
    later than ``late`` behind the newest are left out, and a replay gives the same result as the first run."""
    ship(df.sparkSession)
    kind = dict(df.dtypes)[key]
    d = df.select(key, at, F.timestamp_micros(at).alias("__ts")).withWatermark("__ts", late)
    return d.groupBy(key).applyInPandasWithState(limit_step(key, at, window, most), f"`{key}` {kind}, `{at}` bigint, allowed boolean", "start bigint, count bigint", "append", GroupStateTimeout.EventTimeTimeout)


def windowed_counts(df: DataFrame, at: str, by: list[str], size: str, late: str | None = None) -> DataFrame:
    """Tumbling-window counts, for batch and (with a bound on lateness) for streams."""
    d = df.withWatermark(at, late) if late and df.isStreaming else df
    return d.groupBy(F.window(at, size).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def session_state(df: DataFrame, by: str, order: list[str], cols: list[str]) -> DataFrame:
    """What a conversation has settled so far: the last value of each column up to and with each turn."""
    return carry_forward(df.withColumns({f"last_{c}": F.col(c) for c in cols}), [by], order, [f"last_{c}" for c in cols])


def last_turns(df: DataFrame, by: str, order: list[str], key: str, value: str, n: int = 5) -> DataFrame:
    """(key, turns): the last n values of a conversation up to each row, oldest first; nulls are left out.

    Rows are numbered over range partitions and each is handed to the n rows it belongs to, so a conversation of any
    length is spread. ``order`` is a total order whose first column is not null.
    """
    d = islands(df.select(key, by, *[c for c in order if c not in (key, by)], F.col(value).alias("__v")), [by], order, F.lit(True), "__pos")
    to = d.select(by, key, "__v", F.posexplode(F.sequence(F.col("__pos"), F.col("__pos") + n - 1)).alias("__i", "__to"))
    got = to.groupBy(by, "__to").agg(F.max(F.when(F.col("__i") == 0, F.col(key))).alias(key), F.bool_or(F.col("__i") == 0).alias("__own"), F.sort_array(F.collect_list(F.when(F.col("__v").isNotNull(), F.struct((-F.col("__i")).alias("i"), F.col("__v").alias("v"))))).alias("x"))
    return got.filter("__own").select(key, F.col("x.v").alias("turns"))
