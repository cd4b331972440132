"""Sources, operators on awkward rows, and streams."""

from __future__ import annotations

import pyspark.sql.functions as F
import pytest

from brindle import functions, operators, sources, streaming


@pytest.mark.parametrize("kind", ["parquet", "orc", "csv", "json", "xml"])
def test_round_trip(spark, tmp_path, kind):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None), (3, "é,\"x\"", -2.0)], "k bigint, s string, v double")
    extra = {"rowTag": "row"} if kind == "xml" else {}
    sources.write(df, str(tmp_path / "t"), kind, **extra)
    back = sources.read(spark, str(tmp_path / "t"), kind, df.schema, **extra)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_partitioned_write_prunes(spark, tmp_path):
    sources.write(spark.range(100).withColumn("p", F.col("id") % 4), str(tmp_path / "t"), partition_by=("p",))
    read = sources.read(spark, str(tmp_path / "t")).where("p = 1")
    assert read.count() == 25 and "PartitionFilters: [isnotnull(p" in read._jdf.queryExecution().executedPlan().toString()


def test_formats_are_checked(spark):
    with pytest.raises(ValueError, match="schema"):
        sources.read(spark, "/nowhere", "csv")
    with pytest.raises(ValueError, match="not one of"):
        sources.read(spark, "/nowhere", "other")


def test_as_of_join_keeps_nulls_and_ties(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 1, "b"), (2, 9, "c"), (1, None, "d"), (None, 5, "e")], "k int, t int, x string")
    right = spark.createDataFrame([(1, 5, None), (1, 3, "old"), (1, None, "never"), (3, 1, "z")], "k int, t int, y string")
    got = {r.x: (r.right_t, r.right_y) for r in operators.as_of_join(left, right, ["k"], "t", "t").collect()}
    assert got == {"a": (5, None), "b": (None, None), "c": (None, None), "d": (None, None), "e": (None, None)}


@pytest.mark.parametrize("width", [1, 3, 50])
def test_as_of_join_by_slots_equals_one_window_a_key(spark, width):
    left = spark.createDataFrame([(k, t, f"{k}-{t}") for k in (1, 2, 3, None) for t in (None, -5, *range(0, 40, 3))], "k int, t int, x string")
    right = spark.createDataFrame([(1, t, f"r{t}" if t % 2 else None) for t in range(-4, 20, 5)] + [(2, 30, "late"), (None, 2, "n"), (1, None, "never"), (4, 1, "z")], "k int, t int, y string")
    rows = lambda slots: sorted(map(str, operators.as_of_join(left, right, ["k"], "t", "t", slots=slots).collect()))
    got = rows(lambda t: F.floor(t / width))
    assert len(got) == left.count() and got == rows(None)
    assert rows(lambda t: F.lit(0)) == got


def test_range_join_does_not_depend_on_width(spark):
    points = spark.createDataFrame([(i / 3,) for i in range(-30, 60)], "x double")
    ranges = spark.createDataFrame([(i, i - 4.0, i - 4.0 + i % 5) for i in range(12)] + [(99, 5.0, 1.0), (98, None, 1.0)], "k int, a double, b double")
    want = points.crossJoin(ranges).where("x >= a AND x <= b").count()
    assert {operators.range_join(points, ranges, "x", "a", "b", w).count() for w in (0.5, 3.0, 100.0)} == {want}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    left = spark.createDataFrame([(i % 3 or None, i) for i in range(50)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, w string")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(operators.salted_join(left, right, ["k"], 5, how)) == rows(left.join(right, ["k"], how))
    with pytest.raises(ValueError):
        operators.salted_join(left, right, ["k"], 5, "full")


def test_sized_join_changes_strategy(spark):
    a, b = spark.range(1000), spark.range(10)
    plan = lambda limit: operators.sized_join(a, b, ["id"], max_bytes=limit)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(10**6).lower() and "broadcast" not in plan(1).lower()


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 2.0]), (None, [1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(functions.cosine("a", "b")).collect()]
    assert got[0] == pytest.approx(2**-0.5) and got[1:] == [None, None, None]


@pytest.fixture
def stream(spark, data, tmp_path):
    def make(batches=3):
        src = spark.read.parquet(f"{data}/events.parquet").orderBy("ts")
        src.repartitionByRange(batches, "ts").sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
        return spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    return make


def drained(df, mode="append"):
    q = df.writeStream.format("memory").queryName("drained").outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table("drained")


def test_stream_tumbling_equals_batch(spark, data, stream):
    got = drained(streaming.tumbling(streaming.event_time(stream(1), "ts", "1 hour"), "ts", "1 hour", ["event_type"], F.count(F.lit(1)).alias("n")))
    batch = streaming.tumbling(spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", ["event_type"], F.count(F.lit(1)).alias("n"))
    assert got.exceptAll(batch).isEmpty() and got.count() >= batch.count() - 10  # the last windows stay open


def test_stream_totals_equal_batch(spark, data, stream):
    got = drained(streaming.running_totals(stream(), "user_id", "value"), "update").groupBy("user_id").agg(F.max("n").alias("n"))
    batch = spark.read.parquet(f"{data}/events.parquet").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    assert got.exceptAll(batch).isEmpty() and got.count() == batch.count()


def test_stream_deduplication(spark, data, stream):
    got = drained(streaming.deduplicated(streaming.event_time(stream(), "ts", "60 days"), ["user_id"]))
    assert got.count() == spark.read.parquet(f"{data}/events.parquet").select("user_id").distinct().count()


def test_stream_sessions_equal_batch(spark, data, stream):
    got = drained(streaming.session_counts(streaming.event_time(stream(1), "ts", "1 hour"), "ts", "30 minutes", ["user_id"]))
    batch = streaming.session_counts(spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "30 minutes", ["user_id"])
    assert got.exceptAll(batch).isEmpty() and got.count() >= batch.count() - 10


def test_stream_join_equals_batch(spark, data, stream):
    one = streaming.event_time(stream(1), "ts", "1 hour")
    clicks = one.where("event_type = 'click'").select("user_id", "ts")
    buys = one.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("at"))
    got = drained(streaming.stream_join(clicks, buys, "user_id", "ts", "at", "1 day").select("a.user_id", "ts", "at"))
    events = spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    b = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("at"))
    want = events.where("event_type = 'click'").select("user_id", "ts").join(b, "user_id").where("at >= ts AND at <= ts + interval 1 day")
    assert got.exceptAll(want.select("user_id", "ts", "at")).isEmpty() and got.count() == want.count()


def test_text_and_binary_files_and_views(spark, data, tmp_path):
    sources.write(spark.createDataFrame([("a",), ("é b",)], "value string"), str(tmp_path / "t"), "text")
    assert sorted(r.value for r in sources.read(spark, str(tmp_path / "t"), "text").collect()) == ["a", "é b"]
    assert b"".join(sorted(bytes(r.content) for r in sources.read(spark, str(tmp_path / "t"), "binaryFile", pathGlobFilter="*.txt").collect())) == "a\né b\n".encode()
    sources.register(spark, data, ["region"])
    assert spark.sql("SELECT count(*) FROM region").first()[0] == 5


def test_exact_quantiles_equal_percentile(spark):
    df = spark.createDataFrame([(i % 3 or None, float(i * i % 97)) for i in range(200)] + [(7, 1.0), (8, None), (9, 2.0), (9, 2.0)], "k int, v double")
    got = {r.k: (r.a, r.b) for r in operators.exact_quantiles(df.where("k IS NOT NULL"), ["k"], "v", {"a": 0.5, "b": 0.9}, 8).collect()}
    want = {r.k: (r.a, r.b) for r in df.where("k IS NOT NULL AND v IS NOT NULL").groupBy("k").agg(F.percentile("v", 0.5).alias("a"), F.percentile("v", 0.9).alias("b")).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_gaps_over_blocks(spark):
    df = spark.sql("SELECT 1 AS k, timestamp_ntz'2000-01-01' AS day, 5L AS n UNION ALL SELECT 1, timestamp_ntz'2008-01-01', 6L UNION ALL SELECT 2, timestamp_ntz'2001-01-01', 7L")
    got = operators.gap_filled(df, ["k"], "day", "1 day", "n")
    assert got.count() == 2923 + 1 and got.select("k", "day").distinct().count() == 2924 and got.where("n IS NOT NULL").count() == 3
