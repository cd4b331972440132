"""Windows, sessions, deduplication, joins and keyed state over streams.

Watermarks need a timestamp with a zone, so ``event_time`` casts first. All state
is dropped behind the watermark, or kept one row a key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_time(stream: DataFrame, time: str, delay: str) -> DataFrame:
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def tumbling(stream: DataFrame, time: str, width: str, by: Sequence[str], *aggregates: Column) -> DataFrame:
    got = stream.groupBy(F.window(time, width).alias("_w"), *by).agg(*aggregates)
    return got.select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *[c for c in got.columns if c != "_w"])


def session_counts(stream: DataFrame, time: str, gap: str, by: Sequence[str]) -> DataFrame:
    got = stream.groupBy(*by, F.session_window(time, gap).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return got.select(*by, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "n")


def deduplicated(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stream.dropDuplicatesWithinWatermark(list(keys))


def stream_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, within: str) -> DataFrame:
    """Inner join of rows of a key whose right time follows the left by at most ``within``; both sides need watermarks."""
    a, b = left.alias("a"), right.alias("b")
    near = (F.col(f"b.{right_time}") >= F.col(f"a.{left_time}")) & (F.col(f"b.{right_time}") <= F.col(f"a.{left_time}") + F.expr(f"interval {within}"))
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & near)


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, total) after each batch: one row of state a key."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, n bigint, total double", "n bigint, total double", "update", GroupStateTimeout.NoTimeout)
