"""Top rows and exact quantiles per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window


def top_per_group(rows: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; the planner limits groups before it shuffles them (WindowGroupLimit)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def weighted_sample(rows: DataFrame, by: Sequence[str], key: str, weight: str, k: int, seed: str = "") -> DataFrame:
    """Exactly ``k`` rows of each group (all of a smaller one), without replacement, by chances in proportion to ``weight``.

    A row's number -ln(u) / weight, for u in (0, 1] from the digest of its ``key`` and the seed, is
    exponential, and the least ``k`` are the sample: the same ones however rows are dealt, and groups
    are cut to ``k`` rows before they move. Rows whose weight is null or not positive are never taken;
    ties of the number go to the lesser key.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / float(1 << 52)
    taken = rows.where(F.col(weight) > 0).withColumn("_e", -F.log(u) / F.col(weight))
    return top_per_group(taken, by, [F.asc("_e"), F.asc(key)], k, "_k").drop("_e", "_k")


#: Relative accuracy of the approximate quantiles that enclose exact ones; groups of up to twice as many rows are taken whole.
ACCURACY = 10_000


def exact_quantiles(rows: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, float], accuracy: int = ACCURACY) -> DataFrame:
    """Interpolated quantiles of a group, by name; nulls are left out.

    Approximate quantiles a little below and above a wanted one enclose it for certain, whatever the
    values are. Rows under the lower end are counted, and the values between are counted by value, so a
    value that very many rows have is one row. What is sorted is some ``4 / accuracy`` of a group.
    """
    rows = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    slack = 4 / accuracy
    ends = [max(0.0, p - slack) for p in shares.values()] + [min(1.0, p + slack) for p in shares.values()]
    found = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, accuracy).alias("_e"))
    few = F.col("_n") <= 2 * accuracy
    wanted = [
        F.struct(
            F.lit(k).alias("name"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("at"),
            F.when(~few & F.lit(p - slack > 0), F.get("_e", F.lit(i))).alias("low"), F.when(~few & F.lit(p + slack < 1), F.get("_e", F.lit(i + len(shares)))).alias("high"),
        )
        for i, (k, p) in enumerate(shares.items())
    ]
    asked = found.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.array(*wanted).alias("_w"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)])
    met = rows.join(asked, same).select(*by, "_v", F.explode("_w").alias("_w"))
    # below the lower end: one row a group and quantile, by a null value; values over the upper end don't count
    within = met.where(F.col("_w.high").isNull() | (F.col("_v") <= F.col("_w.high")))
    placed = within.select(*by, "_w", F.when(F.col("_w.low").isNull() | (F.col("_v") >= F.col("_w.low")), F.col("_v")).alias("_v"))
    counts = placed.groupBy(*by, "_w", "_v").agg(F.count(F.lit(1)).alias("_m"))
    ordered = Window.partitionBy(*by, "_w").orderBy(F.asc_nulls_first("_v"))
    counts = counts.withColumn("_upto", F.sum("_m").over(ordered)).withColumn("_before", F.col("_upto") - F.col("_m"))
    at = lambda f: F.max(F.when((F.col("_before") <= f(F.col("_w.at"))) & (f(F.col("_w.at")) < F.col("_upto")), F.col("_v")))
    got = counts.groupBy(*by, "_w").agg(at(F.floor).alias("_x"), at(F.ceil).alias("_y"))
    named = F.col("_x") + (F.col("_w.at") - F.floor(F.col("_w.at"))) * (F.col("_y") - F.col("_x"))
    return got.withColumn("_q", named).groupBy(*by).agg(*[F.max(F.when(F.col("_w.name") == k, F.col("_q"))).alias(k) for k in shares])
