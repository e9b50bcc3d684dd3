"""Incremental processing as streams: a seen-set, counters per key, day windows, receipts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.sinks import VersionedTable


def first_seen_stream(stream: DataFrame, key: str, order: str) -> DataFrame:
    """(key, order, seen_count): each key's first row by order within the micro-batch it first comes in, exactly once.

    The state keeps one count a key and no rows, and never expires.
    """
    types = dict(stream.dtypes)

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        first, rows = None, 0
        for pdf in batches:
            rows += len(pdf)
            low = pdf[order].min()
            first = low if first is None or low < first else first
        state.update((n + rows,))
        if n == 0 and rows:
            yield pd.DataFrame({key: [k[0]], order: [first], "seen_count": [rows]})

    return (
        stream.select(key, order).filter(F.col(key).isNotNull()).groupBy(key)
        .applyInPandasWithState(update, f"{key} {types[key]}, {order} {types[order]}, seen_count long", "n long", "append", GroupStateTimeout.NoTimeout)
    )


def day_windows(stream: DataFrame, time: str, keys: list[str], measure: Column, late: str = "1 day") -> DataFrame:
    """(day, keys, n, total) by event day; rows later than `late` are dropped once their day is closed."""
    w = F.window(time, "1 day")
    x = stream.withWatermark(time, late).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(measure).alias("total"))
    return x.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), *keys, "n", "total")


def failure_streaks(stream: DataFrame, key: str, order: str, failed: Column) -> DataFrame:
    """(key, streak, rows): after each micro-batch the running number of failures since the key's last success."""
    types = dict(stream.dtypes)

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak, rows = state.get if state.exists else (0, 0)
        pdf = pd.concat(list(batches)).sort_values(order)
        for bad in pdf["failed"]:
            streak = streak + 1 if bad else 0
        rows += len(pdf)
        state.update((int(streak), int(rows)))
        yield pd.DataFrame({key: [k[0]], "streak": [streak], "rows": [rows]})

    x = stream.select(key, order, failed.cast("boolean").alias("failed")).groupBy(key)
    return x.applyInPandasWithState(update, f"{key} {types[key]}, streak long, rows long", "streak long, rows long", "update", GroupStateTimeout.NoTimeout)


def run_to_table(stream: DataFrame, name: str, mode: str, checkpoint: str | None = None) -> StreamingQuery:
    """Run what is there into a memory table and stop; for tests and small jobs."""
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    q = (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
    q.awaitTermination()
    return q


def upsert_stream(stream: DataFrame, table: VersionedTable, checkpoint: str, merge) -> StreamingQuery:
    """Fold each micro-batch into a versioned table by merge(current, batch); a batch that is run again gives the same table if merge is idempotent."""

    def fold(batch: DataFrame, _: int) -> None:
        current = table.read()
        table.replace(batch if current is None else merge(current, batch))

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
