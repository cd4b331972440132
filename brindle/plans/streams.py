"""Queries that run a stream over the given tables to its end, each with SQL for DuckDB."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from brindle.plans.catalog import query
from brindle.sources import table
from brindle.streaming import late_day_totals

_BATCHES = 6


@query(f"""
WITH arrived AS (
  SELECT user_id, ts, CAST(floor(value * 100) AS BIGINT) AS amount,
    least({_BATCHES - 1}, CAST(floor(date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts + to_hours(CASE WHEN event_id % 50 = 7 THEN 240 WHEN event_id % 20 = 3 THEN 5 ELSE 0 END))) / 120) AS BIGINT)) AS batch FROM events
), seen AS (
  SELECT b.batch, (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM arrived WHERE arrived.batch < b.batch) AS mark FROM (SELECT DISTINCT batch FROM arrived) b
), judged AS (SELECT *, mark IS NULL OR ts > mark AS taken FROM arrived JOIN seen USING (batch))
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (WHERE taken) AS n, CAST(coalesce(sum(amount) FILTER (WHERE taken), 0) AS BIGINT) AS amount, count(*) FILTER (WHERE NOT taken) AS dropped
FROM judged GROUP BY ALL
""")
def late_user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of users by day, streamed in order of arrival: one event in 20 comes five hours late, one in 50 ten days."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.floor(F.col("value") * 100).alias("amount"))
    late = F.when(F.col("event_id") % 50 == 7, 240).when(F.col("event_id") % 20 == 3, 5).otherwise(0)
    hours = F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))) / 3600) + late
    batch = F.least(F.lit(_BATCHES - 1), F.floor(hours / 120)).cast("int")
    got = late_day_totals(events.withColumn("batch", batch), "user_id", "ts", "amount", "batch", _BATCHES, "1 day")
    return got.withColumn("day", F.col("day").cast("string"))
