"""Operators over timed rows, in batch."""

from __future__ import annotations

from collections.abc import Sequence

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame


def sessions(events: DataFrame, by: Sequence[str], time: str, gap: str, *aggregates: Column) -> DataFrame:
    """Sessions of a key: rows at most ``gap`` apart (an interval such as '30 minutes')."""
    got = events.groupBy(*by, F.session_window(F.col(time), gap).alias("_w")).agg(*aggregates)
    rest = [c for c in got.columns if c not in {*by, "_w"}]
    return got.select(*by, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *rest)


def deduplicated_latest(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order``, as one aggregate with a map-side part."""
    rest = [c for c in rows.columns if c not in by]
    last = F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_last")
    return rows.groupBy(*by).agg(last).select(*[c if c in by else F.col(f"_last.{c}").alias(c) for c in rows.columns])


def gap_filled(counts: DataFrame, by: Sequence[str], time: str, step: str, value: str) -> DataFrame:
    """``counts`` with a row for every ``step`` between a key's first and last time; new values are null.

    Times are made in blocks of 1,000 steps, so that no row holds the whole span of a key.
    """
    span = counts.groupBy(*by).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    blocks = span.select(*by, "_b", F.explode(F.expr(f"sequence(_a, _b, (interval {step}) * 1000)")).alias("_a"))
    grid = blocks.select(*by, F.explode(F.expr(f"sequence(_a, least(_b, _a + (interval {step}) * 999), interval {step})")).alias(time))
    return grid.join(counts.select(*by, time, value), [*by, time], "left")
