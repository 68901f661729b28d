"""Streaming forms of the ordered operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_gap_runs(stream: DataFrame, key: str, ts: str, max_gap: int) -> DataFrame:
    """key, ts, run_id of each event: a run starts where the step from the
    key's last event is greater than ``max_gap``.  State: last ts and run.

    Events of one micro-batch are ordered; a batch must not hold events older
    than those of batches before, or they join the run that is open.
    """
    kind = stream.schema[key].dataType.simpleString()

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, run = state.get if state.exists else (None, 0)
        stamps = sorted(t for pdf in batches for t in pdf[ts].tolist())
        out = []
        for t in stamps:
            run += last is not None and t - last > max_gap
            last = t if last is None else max(last, t)
            out.append(run)
        if stamps:
            state.update((last, run))
        yield pd.DataFrame({key: [k[0]] * len(stamps), ts: stamps, "run_id": out})

    return stream.select(key, ts).groupBy(key).applyInPandasWithState(step, f"`{key}` {kind}, `{ts}` long, run_id long", "last long, run long", "append", GroupStateTimeout.NoTimeout)


def stream_window_counts(stream: DataFrame, event_time: str, key: str, width: str, late: str) -> DataFrame:
    """Events by key and tumbling window, closed by a watermark."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, width), key).agg(F.count(F.lit(1)).alias("n")).select("window.start", "window.end", key, "n")
