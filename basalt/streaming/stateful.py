"""Keyed state with timers: one final row for each key once the watermark has passed it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State store that keeps state with timers on disk, under the query's checkpoint.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SESSION = "key string, sessions int, n long, total double, first_ts timestamp, last_ts timestamp"


class Sessions(StatefulProcessor):
    """Runs of a key's rows that are at most ``gap`` seconds apart, to the millisecond. A run is closed by a timer when
    the watermark has passed its end; a row that comes after that opens the next one. Rows that
    repeat an id within a run's state count once."""

    def __init__(self, gap: float) -> None:
        self.gap = int(gap * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "id long", "ts long, value double")
        self.closed = handle.getValueState("closed", "n int")

    def _timer(self, end: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old if isinstance(old, int) else old[0])
        self.handle.registerTimer(end + self.gap)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for row in frame.itertuples():
                if not self.open.containsKey((row.event_id,)):
                    self.open.updateValue((row.event_id,), (row.ts.value // 1_000_000, float(row.value)))
        held = [v[0] for _, v in self.open.iterator()]
        if held:
            self._timer(self._runs(sorted(held))[0][1])
        yield from ()

    def _runs(self, times: list[int]) -> list[tuple[int, int]]:
        runs = [[times[0], times[0]]]
        for t in times[1:]:
            if t - runs[-1][1] > self.gap:
                runs.append([t, t])
            runs[-1][1] = t
        return [(a, b) for a, b in runs]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = sorted((v[0], k[0], v[1]) for k, v in self.open.iterator())
        past = timerValues.getCurrentWatermarkInMs()
        number = self.closed.get()[0] if self.closed.exists() else 0
        out = []
        for start, end in self._runs([t for t, *_ in held]) if held else []:
            if end + self.gap > past:
                self._timer(end)
                break
            inside = [(t, i, v) for t, i, v in held if start <= t <= end]
            number += 1
            at = lambda ms: pd.Timestamp(ms, unit="ms")
            out.append((key[0], number, len(inside), sum(v for *_, v in inside), at(start), at(end)))
            for _, i, _ in inside:
                self.open.removeKey((i,))
        self.closed.update((number,))
        if out:
            yield pd.DataFrame(out, columns=["key", "sessions", "n", "total", "first_ts", "last_ts"])

    def close(self) -> None:
        pass


def sessions(stream: DataFrame, key: str, gap: float) -> DataFrame:
    """Rows ``SESSION`` of a stream with event_id, ts (with a watermark) and value: each key's runs,
    once they are over. State is what is open; it lives under the query's checkpoint, so a query that
    starts again goes on where it was."""
    shaped = stream.where(F.col(key).isNotNull() & F.col("value").isNotNull()).select(F.col(key).cast("string").alias("key"), F.col("event_id").cast("long").alias("event_id"), "ts", F.col("value").cast("double").alias("value"))
    return shaped.groupBy("key").transformWithStateInPandas(Sessions(gap), outputStructType=SESSION, outputMode="append", timeMode="eventTime")


def run_through(result: DataFrame, folder: str) -> DataFrame:
    """Run a stream over all that is there, from where its checkpoint in ``folder`` left off, and
    give the table of all it has put out so far."""
    spark = result.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)
    try:
        query = result.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(result.schema).parquet(f"{folder}/rows")
