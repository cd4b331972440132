"""Clustered layouts: rows in the order of interleaved bits of several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

#: Bits of each column that are interleaved; a column is cut at 2^BITS - 1 approximate quantiles.
BITS = 8


def interleaved(rows: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on the curve: bits of each column's quantile number by turns. Nulls come first.

    The quantiles are a bounded number of values, read by one aggregate.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    as_number = {c: F.col(c).cast("double") if rows.schema[c].dataType.typeName() not in ("timestamp", "timestamp_ntz", "date") else F.unix_micros(F.col(c).cast("timestamp")).cast("double") for c in columns}
    found = rows.agg(*[F.percentile_approx(as_number[c], shares, 10_000).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    place = F.lit(0).cast("bigint")
    for i, c in enumerate(columns):
        ends = sorted(set(found[i] or ()))
        steps = F.array(*map(F.lit, ends)) if ends else F.expr("cast(array() as array<double>)")
        number = F.coalesce(F.size(F.filter(steps, _up_to(as_number[c]))), F.lit(0)).cast("bigint")
        spread = [F.shiftleft(F.shiftright(number, b).bitwiseAND(F.lit(1).cast("bigint")), b * len(columns) + i) for b in range(bits)]
        place = reduce(lambda a, b: a.bitwiseOR(b), spread, place)
    return place


def _up_to(value: Column):
    return lambda end: end <= value


def clustered(rows: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """``rows`` dealt by ranges of ``interleaved`` over about ``files`` partitions, each sorted by it."""
    placed = rows.withColumn("_place", interleaved(rows, columns, bits))
    return placed.repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place")
