"""Numbers and running sums over a whole table in one order, without a single task that sees it all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql.types import IntegerType, StructField, StructType

from brindle.sources import scratch


def globally_ordered(rows: DataFrame, order: Sequence[Column], number: str = "row_number", sums: Mapping[str, str] | None = None, partitions: int | None = None) -> DataFrame:
    """``rows`` with their number in ``order`` from 1, and running sums (new name to column) up to each row.

    Two passes over rows that are dealt by ranges of the order and written: totals of each range, added
    up on the driver (a row a range), then a window within each range that begins with what lies before
    it. ``order`` must tell rows apart, or which of equal rows comes first is open. Nulls add nothing to
    a sum, which is null before the first value. Sums are of integers or decimals, so that no order of
    adding shows.
    """
    spark, sums = rows.sparkSession, dict(sums or {})
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark, "ordered")
    rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema(StructType([*rows.schema.fields, StructField("_range", IntegerType())])).parquet(path)
    totals = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(c).cast("decimal(38,6)")).alias(f"_s{i}") for i, c in enumerate(sums.values())])
    begins, before = [], [0, *[None] * len(sums)]
    for r in sorted(totals.collect(), key=lambda r: r["_range"]):
        begins.append((r["_range"], *before))
        before = [before[0] + r["_n"], *[a if b is None else (a or Decimal(0)) + b for a, b in zip(before[1:], r[2:], strict=True)]]
    names = ", ".join(["_range int", "_before bigint", *[f"_b{i} decimal(38,6)" for i in range(len(sums))]])
    met = dealt.join(F.broadcast(spark.createDataFrame(begins, names)), "_range")
    within = Window.partitionBy("_range").orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = [(F.row_number().over(within) + F.col("_before")).alias(number)]
    for i, (name, c) in enumerate(sums.items()):
        own = F.sum(F.col(c).cast("decimal(38,6)")).over(running)
        total = F.when(own.isNull(), F.col(f"_b{i}")).otherwise(own + F.coalesce(f"_b{i}", F.lit(0)))
        made.append(total.cast(_sum_type(rows, c)).alias(name))
    return met.select(*rows.columns, *made)


def _sum_type(rows: DataFrame, column: str) -> str:
    kind = rows.schema[column].dataType
    if kind.typeName() in ("byte", "short", "integer", "long"):
        return "bigint"
    if kind.typeName() == "decimal":
        return f"decimal(38,{min(kind.scale, 6)})"
    raise ValueError(f"{column} is {kind.simpleString()}; running sums are of integers or decimals")
