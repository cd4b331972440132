"""Queries by the engine's own mechanisms: its connector, upserts, sketches, user aggregates, table functions and global order."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from brindle.functions import longest_streak, register_tables
from brindle.operators import clustered, globally_ordered, weighted_sample
from brindle.plans.catalog import query
from brindle.sources import scratch, table, with_segments
from brindle.streaming import Upserts, upserted


@query("""
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
WHERE o_custkey BETWEEN 20 AND 60 AND o_orderdate >= TIMESTAMP '2000-01-01'
""")
def orders_from_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders go through the segment connector, laid out by customer and date; a filter on both reads few segments."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    path = scratch(spark, "segments")
    with_segments(spark)
    clustered(orders, ["o_custkey", "o_orderdate"], 16).write.format("segments").mode("append").save(path)
    back = spark.read.format("segments").load(path)
    return back.where("o_custkey >= 20 AND o_custkey <= 60 AND o_orderdate >= timestamp_ntz'2000-01-01'")


@query("""
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1
""")
def latest_event_by_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user, from a stream that brings events in three batches, out of order."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    folder, checkpoint = scratch(spark, "upserts-in"), scratch(spark, "upserts-checkpoint")
    kept = Upserts(scratch(spark, "upserts"), events.schema, ["user_id"], ["ts", "event_id"])
    for k in (2, 0, 1):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k).write.mode("append").parquet(folder)
        upserted(spark.readStream.schema(events.schema).parquet(folder), kept, checkpoint)
    return kept.read(spark).select("user_id", "event_id", "event_type", "value")


@query("""
SELECT event_type, count(DISTINCT event_id) AS events, count(DISTINCT user_id) AS users, true AS hll_within, true AS theta_within, true AS kll_within FROM events GROUP BY event_type
""")
def sketches_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches kept by type and day, merged by type, against exact results.

    Within: the distinct events by HLL (2^12 registers) and theta (2^12 values) within five standard
    errors (1.63 % each), and the rank of the median by KLL (k = 200) within 0.0133 * 2 of a half.
    """
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", "ts", "value")
    daily = events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.hll_sketch_agg("event_id", 12).alias("hll"), F.theta_sketch_agg("event_id", 12).alias("theta"), F.kll_sketch_agg_double("value", 200).alias("kll")
    )
    path = scratch(spark, "sketches")
    daily.write.parquet(path)
    merged = spark.read.schema(daily.schema).parquet(path).groupBy("event_type").agg(
        F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("by_hll"), F.theta_sketch_estimate(F.theta_union_agg("theta")).alias("by_theta"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("kll"), F.lit(0.5)).alias("mid"),
    )
    exact = events.groupBy("event_type").agg(F.countDistinct("event_id").alias("events"), F.countDistinct("user_id").alias("users"))
    ranks = events.join(merged, "event_type").groupBy("event_type").agg(F.avg((F.col("value") <= F.col("mid")).cast("double")).alias("rank"))
    near = lambda c: F.abs(F.col(c) - F.col("events")) <= 5 * 0.0163 * F.col("events") + 0.5
    return exact.join(merged, "event_type").join(ranks, "event_type").select(
        "event_type", "events", "users", near("by_hll").alias("hll_within"), near("by_theta").alias("theta_within"),
        (F.abs(F.col("rank") - 0.5) <= 2 * 0.0133 + 1 / F.col("events")).alias("kll_within"),
    )


@query("""
WITH h AS (SELECT DISTINCT user_id, date_diff('day', TIMESTAMP '1970-01-01', date_trunc('day', ts)) AS v FROM events),
r AS (SELECT user_id, v, v - row_number() OVER (PARTITION BY user_id ORDER BY v) AS g FROM h),
s AS (SELECT user_id, min(v) AS start, count(*) AS length FROM r GROUP BY user_id, g)
SELECT user_id, CAST(start AS BIGINT) AS start, length FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY length DESC, start) = 1
""")
def longest_daily_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of days on which a user did something, by an aggregate of its own with partial states."""
    days = table(spark, sf_dir, "events").select("user_id", F.unix_date(F.to_date("ts")).cast("bigint").alias("day"))
    return longest_streak(days, ["user_id"], "day")


@query("""
WITH a AS (
  SELECT *, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER w AS v FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), b AS (
  SELECT *, last_value(CASE WHEN event_type = 'click' AND v IS NOT NULL THEN event_id END IGNORE NULLS) OVER w AS c,
    last_value(CASE WHEN event_type = 'click' AND v IS NOT NULL THEN v END IGNORE NULLS) OVER w AS cv FROM a
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT user_id, cv AS view_id, c AS click_id, event_id AS purchase_id FROM b WHERE event_type = 'purchase' AND c IS NOT NULL
""")
def purchase_funnels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View, click, purchase by a table function over each user's events in order."""
    register_tables(spark)
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return spark.sql("SELECT f.* FROM funnel(TABLE(SELECT * FROM {events}) PARTITION BY user_id ORDER BY (ts, event_id)) f", events=events)


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS number,
  CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running
FROM orders
""")
def orders_in_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and running totals over all orders by date."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.floor("o_totalprice").alias("price"))
    return globally_ordered(orders, [F.asc("o_orderdate"), F.asc("o_orderkey")], "number", {"running": "price"}).select("o_orderkey", F.col("number").cast("bigint").alias("number"), "running")


@query("""
SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY
    -ln((CAST('0x' || md5(CAST(o_orderkey AS VARCHAR) || 'sample')[1:13] AS BIGINT) + 1) / 4503599627370496.0::DOUBLE) / o_totalprice, o_orderkey) AS k FROM orders WHERE o_totalprice > 0)
WHERE k <= 40
""")
def orders_sampled_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty orders of each priority, by chances in proportion to their price, the same ones on every run."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return weighted_sample(orders, ["o_orderpriority"], "o_orderkey", "o_totalprice", 40, "sample")
