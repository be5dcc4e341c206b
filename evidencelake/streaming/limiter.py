"""The sliding-window limiter: a hit is accepted if fewer than ``limit`` accepted hits are younger than ``window`` seconds.

Rejected hits are not remembered, so a decision depends on earlier decisions
and no plain window expresses it. Batch: the hits of a key in order. Stream: the
accepted times of a key are its state.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def decide(times: list[float], limit: int, window: float, held: deque | None = None) -> list[bool]:
    """Decisions on hits at rising times; ``held`` are the accepted times so far."""
    held = deque() if held is None else held
    out = []
    for t in times:
        while held and held[0] <= t - window:
            held.popleft()
        out.append(len(held) < limit)
        if out[-1]:
            held.append(t)
    return out


def _decided_schema(hits: DataFrame, key: str, seq: str) -> str:
    return f"{key} {hits.schema[key].dataType.simpleString()}, {seq} {hits.schema[seq].dataType.simpleString()}, accepted boolean"


def _seconds(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp")) / 1e6


def limited(hits: DataFrame, key: str, ts: str, seq: str, limit: int, window: float = 60.0) -> DataFrame:
    """(key, seq, accepted) of every hit, in batch.

    The hits of one key are decided in order by nature, so they pass through one
    task; it reads them sorted and holds the accepted times of one key only
    (``limit`` of them at most), whatever the number of its hits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = object(), deque()
        for batch in batches:
            keys, times = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            accepted: list[bool] = []
            start = 0
            for end in range(1, len(keys) + 1):
                if end < len(keys) and keys[end] == keys[start]:
                    continue
                if keys[start] != now:
                    now, held = keys[start], deque()
                accepted += decide(times[start:end], limit, window, held)
                start = end
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(accepted, pa.bool_())], names=[key, seq, "accepted"])

    timed = hits.select(key, seq, _seconds(ts).alias("_t"))
    return timed.repartition(key).sortWithinPartitions(key, "_t", seq).mapInArrow(run, _decided_schema(hits, key, seq))


def limited_stream(hits: DataFrame, key: str, ts: str, seq: str, limit: int, window: float = 60.0, delay: str = "1 minute") -> DataFrame:
    """The same on a stream whose hits of a key arrive in order; a key is forgotten once the watermark is ``window`` beyond its last accepted hit."""

    def run(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = deque(state.get[0]) if state.exists else deque()
        pdf = pd.concat(list(parts)).sort_values(["_t", seq])
        accepted = decide(pdf["_t"].tolist(), limit, window, held)
        state.update((list(held),))
        if held:
            state.setTimeoutTimestamp(max(int((held[-1] + window) * 1000), state.getCurrentWatermarkMs()) + 1)
        yield pdf[[key, seq]].assign(accepted=accepted)

    timed = hits.withWatermark(ts, delay).select(key, seq, ts, _seconds(ts).alias("_t"))
    return timed.groupBy(key).applyInPandasWithState(run, _decided_schema(hits, key, seq), "held array<double>", "append", GroupStateTimeout.EventTimeTimeout)


def first_wins_stream(rows: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """The first arrival of each key, remembered for ``delay`` of event time."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
