"""Joins: as-of, range, and equi-joins that hold under skew."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

#: Bytes of a side that ``sized_join`` may broadcast.
MAX_BROADCAST = 64 << 20


def as_of_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, prefix: str = "right_", slots: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time; all left rows stay.

    Both sides are stacked and one window per key carries the last right row
    forward as a struct, so null payloads are carried as they are. One shuffle, no
    pairs.

    ``slots``, a function of time that never falls (such as the date), cuts keys
    with very many rows: windows then run per key and slot, each of which begins
    with the last right row of the slots before. Those rows come from a partial
    aggregate, one per key and slot, so only they meet by key alone. The result
    does not depend on it. Among right rows of a key at one time any may be taken.
    """
    payload = [c for c in right.columns if c not in by]
    a = left.select(*by, F.col(left_time).alias("_at"), F.struct(*left.columns).alias("_left"), F.lit(None).alias("_right"), F.lit(1).alias("_side"))
    b = right.where(F.col(right_time).isNotNull()).select(*by, F.col(right_time).alias("_at"), F.lit(None).alias("_left"), F.struct(*payload).alias("_right"), F.lit(0).alias("_side"))
    every, parts = a.unionByName(b), list(by)
    if slots is not None:
        parts = [*by, "_slot"]
        every = every.withColumn("_slot", slots(F.col("_at")))
        ends = every.where(F.col("_at").isNotNull()).groupBy(*parts).agg(F.max_by("_right", F.when(F.col("_side") == 0, F.col("_at"))).alias("_end"))
        before = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        begins = ends.select(*parts, F.last("_end", ignorenulls=True).over(before).alias("_right"), F.lit(-1).alias("_side")).where(F.col("_right").isNotNull())
        every = every.unionByName(begins, allowMissingColumns=True)
    w = Window.partitionBy(*parts).orderBy(F.expr("_side >= 0"), "_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = every.withColumn("_last", F.last("_right", ignorenulls=True).over(w)).where("_side = 1")
    matched = F.when(F.col("_at").isNotNull(), F.col("_last"))
    return met.select(*[F.col(f"_left.{c}").alias(c) for c in left.columns], *[matched[c].alias(prefix + c) for c in payload])


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float, on: Sequence[str] = ()) -> DataFrame:
    """Pairs with ``low <= point <= high``: an equi-join on intervals of ``width``, then the exact test.

    A range is repeated for each interval it meets, so ``width`` should be about
    the usual length of a range; the result does not depend on it.
    """
    a = points.withColumn("_bucket", F.floor(F.col(point) / width))
    spread = F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))
    b = ranges.where(F.col(low) <= F.col(high)).withColumn("_bucket", F.explode(spread))
    return a.join(b, [*on, "_bucket"]).where((F.col(point) >= F.col(low)) & (F.col(point) <= F.col(high))).drop("_bucket")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], salts: int, how: str = "inner") -> DataFrame:
    """An equi-join whose left keys are spread over ``salts`` parts and whose right rows are repeated for each.

    For hot keys on the left where more than a join follows on the same keys, so
    that adaptive execution cannot split them. ``how``: inner, left, left_semi or
    left_anti, as the right side is the one that repeats.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} would repeat right rows")
    hashed: Column = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    a = left.withColumn("_salt", hashed)
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [*on, "_salt"], how).drop("_salt")


def row_bytes(rows: DataFrame) -> Column:
    """About the bytes of a row: octets of strings and binaries, JSON of nested values, 8 for all others."""
    out = F.lit(8 * len(rows.columns))
    for f in rows.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            out = out + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind in ("array", "map", "struct"):
            out = out + F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
    return out


def sized_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", max_bytes: int = MAX_BROADCAST) -> DataFrame:
    """A join that broadcasts ``right`` if it is found to stay within ``max_bytes``.

    The planner's estimate comes from compressed files, so where it fits the rows are measured as well.
    """
    small = int(str(right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= max_bytes
    if small:
        small = (right.select(F.sum(row_bytes(right))).first()[0] or 0) <= max_bytes
    return left.join(F.broadcast(right) if small else right, list(on), how)
