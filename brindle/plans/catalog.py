"""Queries over the given tables: a Spark plan and, beside it, SQL for DuckDB.

Sums of doubles are rounded on both sides, as their order differs; integer
results are cast to one type. Filters are ranges on plain columns, so they reach
the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession, Window

from brindle.functions import cosine, exact_share, jaro
from brindle.operators import as_of_join, deduplicated_latest, exact_quantiles, gap_filled, range_join, salted_join, sessions, sized_join, top_per_group
from brindle.sources import table

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str


QUERIES: dict[str, Entry] = {}


def query(sql: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = Entry(f, sql)
        return f

    return add


def queries() -> dict[str, Query]:
    return {k: e.run for k, e in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in QUERIES.items()}


def _revenue():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


# ---- aggregation ----


@query("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
  round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL
""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02'").groupBy("l_returnflag", "l_linestatus")
        .agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(_revenue()), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))
    )


@query("""
SELECT r_name, n_name, CAST(grouping(r_name) AS INTEGER) * 2 + CAST(grouping(n_name) AS INTEGER) AS level, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)
""")
def rollup_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = sized_join(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"])
    met = sized_join(table(spark, sf_dir, "customer"), nation.withColumnRenamed("n_nationkey", "c_nationkey"), ["c_nationkey"])
    got = met.rollup("r_name", "n_name").agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    return got.select("r_name", "n_name", "level", "customers", "balance")


@query("""
SELECT event_type, count(DISTINCT user_id) AS users, count(*) FILTER (WHERE value > 50) AS large, round(median(value), 4) AS mid,
  round(stddev_samp(value), 6) AS spread, round(quantile_cont(value, 0.9), 4) AS p90
FROM events GROUP BY event_type
""")
def event_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "value")
    got = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.count_if(F.col("value") > 50).alias("large"), F.round(F.stddev_samp("value"), 6).alias("spread"))
    ranked = exact_quantiles(events, ["event_type"], "value", {"mid": 0.5, "p90": 0.9})
    return got.join(ranked, "event_type", "left").select("event_type", "users", "large", F.round("mid", 4).alias("mid"), "spread", F.round("p90", 4).alias("p90"))


@query("""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p
FROM orders GROUP BY o_orderpriority
""")
def pivot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c.lower())
    return got.select("o_orderpriority", *[zero(c) for c in "FOP"])


@query("""
SELECT p_partkey, field, amount FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part)
UNPIVOT (amount FOR field IN (size, price))
""")
def unpivot_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return part.unpivot("p_partkey", ["size", "price"], "field", "amount")


# ---- joins ----


@query("""
SELECT o_orderkey, o_orderdate, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15'
GROUP BY ALL ORDER BY revenue DESC, o_orderkey LIMIT 10
""")
def shipping_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders").where("o_orderdate < timestamp_ntz'1998-03-15'").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").where("l_shipdate > timestamp_ntz'1998-03-15'").select(F.col("l_orderkey").alias("o_orderkey"), _revenue().alias("r"))
    per_order = lines.groupBy("o_orderkey").agg(F.sum("r").alias("r"))  # keyed as the join, so it costs no shuffle of its own
    met = per_order.join(orders.join(customers, "o_custkey", "left_semi"), "o_orderkey")
    return met.select("o_orderkey", "o_orderdate", F.round("r", 2).alias("revenue")).orderBy(F.desc("revenue"), "o_orderkey").limit(10)


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def customers_with_large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(large, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(keys, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query("""
SELECT s_suppkey, n_name, coalesce(lines, 0) AS lines FROM supplier FULL JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN (SELECT l_suppkey, count(*) AS lines FROM lineitem GROUP BY 1) l ON l_suppkey = s_suppkey
""")
def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("lines"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    met = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(nation, "s_nationkey", "full")
    return met.join(lines, "s_suppkey", "left").select("s_suppkey", "n_name", F.coalesce("lines", F.lit(0)).alias("lines"))


@query("""
SELECT c.event_id, c.user_id, p.event_id AS purchase_id, p.value AS purchase_value
FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
ON c.user_id = p.user_id AND c.ts >= p.ts
""")
def last_purchase_before_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    clicks, purchases = (events.where(F.col("event_type") == k).drop("event_type") for k in ("click", "purchase"))
    met = as_of_join(clicks, purchases, ["user_id"], "ts", "ts", slots=F.to_date)
    return met.select("event_id", "user_id", F.col("right_event_id").alias("purchase_id"), F.col("right_value").alias("purchase_value"))


@query("""
SELECT a.p_partkey, b.p_partkey AS near_key FROM part a JOIN part b
ON a.p_retailprice BETWEEN b.p_retailprice - 0.5 AND b.p_retailprice + 0.5 AND a.p_size = b.p_size
""")
def parts_of_similar_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs, self pairs and both orders included; merged by key, as a broadcast would leave them to the few tasks that read a small table."""
    part = table(spark, sf_dir, "part")
    ranges = part.select(F.col("p_partkey").alias("near_key"), "p_size", (F.col("p_retailprice") - 0.5).alias("low"), (F.col("p_retailprice") + 0.5).alias("high"))
    return range_join(part.select("p_partkey", "p_size", "p_retailprice"), ranges.hint("merge"), "p_retailprice", "low", "high", 1.0, ["p_size"]).select("p_partkey", "near_key")


@query("""
WITH b AS (SELECT p_brand, avg(p_retailprice) - 40 AS low, avg(p_retailprice) + 40 AS high FROM part GROUP BY p_brand)
SELECT b.p_brand, count(*) AS parts FROM b JOIN part ON p_retailprice BETWEEN low AND high GROUP BY b.p_brand
""")
def parts_about_brand_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many parts, of any brand, have a price within 40 of a brand's mean: every part meets a range a brand at most."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_retailprice")
    means = part.groupBy("p_brand").agg(F.avg("p_retailprice").alias("mean")).select("p_brand", (F.col("mean") - 40).alias("low"), (F.col("mean") + 40).alias("high"))
    return range_join(part.select("p_retailprice"), means, "p_retailprice", "low", "high", 80.0).groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"))


@query("SELECT event_id, event_type, n AS type_total FROM events JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) USING (event_type)")
def events_with_type_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    totals = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("type_total"))
    return salted_join(events, totals, ["event_type"], 16)


# ---- windows, ranking, sets ----


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, CAST(k AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 3
""")
def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("""
SELECT event_id, user_id, lag(value) OVER w AS before, round(avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS mean3,
  CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS INTEGER) AS type_rank
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def user_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.lag("value").over(w).alias("before"),
        F.round(F.avg("value").over(w.rowsBetween(-2, 0)), 6).alias("mean3"),
        F.dense_rank().over(Window.partitionBy("user_id").orderBy("event_type")).alias("type_rank"),
    )


@query("""
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, s
""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", "30 minutes", F.count(F.lit(1)).alias("n"))


@query("""
SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL
""")
def hourly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return got.select(F.col("w.start").alias("hour"), "event_type", "n", "total")


@query("""
SELECT start, event_type, count(*) AS n FROM (
  SELECT unnest([b, b - INTERVAL 30 MINUTE]) AS start, event_type FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS b, event_type FROM events)) GROUP BY ALL
""")
def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour", "30 minutes").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return got.select(F.col("w.start").alias("start"), "event_type", "n")


@query("""
WITH d AS (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n FROM events WHERE value > 90 GROUP BY ALL),
g AS (SELECT event_type, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM d GROUP BY event_type)
SELECT event_type, day, n FROM g LEFT JOIN d USING (event_type, day)
""")
def daily_counts_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").where("value > 90").groupBy("event_type", F.window("ts", "1 day")["start"].alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return gap_filled(days, ["event_type"], "day", "1 day", "n")


@query("""
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1
""")
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return deduplicated_latest(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("""
SELECT 'both' AS side, k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'customers', k FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'extra', k FROM (SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)
""")
def nation_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select("s_nationkey")
    named = lambda df, side: df.select(F.lit(side).alias("side"), "k")
    return named(c.intersect(s), "both").union(named(c.subtract(s), "customers")).union(named(c.exceptAll(s), "extra"))


# ---- scalar functions ----


@query(r"""
SELECT c_custkey, upper(c_mktsegment) AS segment, CAST(length(c_name) AS BIGINT) AS name_length, regexp_extract(c_name, '[0-9]+') AS digits,
  round(abs(c_acctbal), 1) AS balance, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'much' END AS class,
  md5(c_name) AS digest, CAST(c_custkey % 7 AS BIGINT) AS rest, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded
FROM customer
""")
def customer_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.upper("c_mktsegment").alias("segment"), F.length("c_name").cast("bigint").alias("name_length"),
        F.regexp_extract("c_name", "[0-9]+", 0).alias("digits"), F.round(F.abs("c_acctbal"), 1).alias("balance"),
        F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "some").otherwise("much").alias("class"),
        F.md5("c_name").alias("digest"), (F.col("c_custkey") % 7).alias("rest"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"),
    )


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(isodow(o_orderdate) AS INTEGER) AS dow,
  CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS age, strftime(o_orderdate, '%Y-%m') AS month
FROM orders
""")
def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates(table(spark, sf_dir, "orders"))


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(isodow(o_orderdate) AS INTEGER) AS dow,
  CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS age, strftime(o_orderdate, '%Y-%m') AS month
FROM orders
""")
def order_dates_of_all_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates(table(spark, sf_dir, "orders"))


def _dates(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), (F.weekday("o_orderdate") + 1).alias("dow"),
        F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate").alias("age"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )


@query("""
SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum,
  array_to_string(list_sort(list_distinct(list(event_type))), ',') AS types FROM events GROUP BY user_id
""")
def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k_sum"),
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"),
    )


@query("""
SELECT label, count(*) AS n, round(avg(list_cosine_similarity(embedding, c)), 4) AS mean_cosine
FROM embeddings JOIN (SELECT label AS l, embedding AS c FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1) ON label = l GROUP BY label
""")
def cosine_to_first_of_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    first = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("c"))
    return vectors.join(first, "label").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(cosine("embedding", "c")), 4).alias("mean_cosine"))


@query("""
SELECT l_shipmonth, returned, total, round(returned / total, 6) AS share FROM (
  SELECT strftime(l_shipdate, '%Y-%m') AS l_shipmonth, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) AS total FROM lineitem GROUP BY 1)
""")
def return_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("l_shipmonth")).agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count(F.lit(1)).alias("total"))
    return got.withColumn("share", F.round(exact_share("returned", "total"), 6))


@query("""
WITH turns AS (SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS chars FROM conversations)
SELECT conv_id, count(*) AS turns, sum(chars)::BIGINT AS chars, string_agg(role, '>' ORDER BY turn) AS roles FROM turns GROUP BY conv_id
""")
def conversation_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("chars"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.sum("chars").alias("chars"), F.array_join(ordered["role"], ">").alias("roles"))


_GIVEN = "(SELECT nullif(user_id % 7, 3) AS k, nullif(event_id % 4, 0) AS v, nullif(event_type, 'view') AS s FROM events) AS t"


@query(f"""
SELECT k, count(*) AS n, count(v) AS some, CAST(sum(v) AS BIGINT) AS total, max(s) AS last, count(*) FILTER (WHERE v > 1) AS more,
  count(*) FILTER (WHERE NOT (v > 1)) AS less, count(*) FILTER (WHERE k IN (SELECT v FROM {_GIVEN})) AS met FROM {_GIVEN} GROUP BY k
""")
def null_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls in grouping, aggregates, filters and a semi-join; the tables hold none, so values are made null."""
    given = table(spark, sf_dir, "events").selectExpr("nullif(user_id % 7, 3) AS k", "nullif(event_id % 4, 0) AS v", "nullif(event_type, 'view') AS s")
    met = given.join(given.select(F.col("v").alias("k")).distinct(), "k", "left_semi").groupBy("k").agg(F.count(F.lit(1)).alias("met"))
    got = given.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("some"), F.sum("v").cast("bigint").alias("total"), F.max("s").alias("last"),
        F.count_if(F.col("v") > 1).alias("more"), F.count_if(~(F.col("v") > 1)).alias("less"),
    )
    return got.join(met, "k", "left").withColumn("met", F.coalesce("met", F.lit(0).cast("bigint")))


@query("SELECT p_partkey, CAST(CASE WHEN p_partkey > 0 THEN 1 + (p_partkey - 1) % 9 ELSE 0 END AS BIGINT) AS root FROM part")
def part_digit_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", F.when(key > 0, 1 + (key - 1) % 9).otherwise(F.lit(0)).cast("bigint").alias("root"))


@query("SELECT p_partkey, round(jaro_similarity(p_name, p_type), 6) AS similarity FROM part")
def part_name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python function over Arrow batches, as a user would bring one for what no built-in function does."""

    @F.pandas_udf("double")
    def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaro(x, y) for x, y in zip(a, b, strict=True)])

    return table(spark, sf_dir, "part").select("p_partkey", F.round(similarity("p_name", "p_type"), 6).alias("similarity"))
