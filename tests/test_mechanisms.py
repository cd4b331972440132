"""The connector, the upsert sink, streams with custom state, user aggregates, table functions and global order."""

from __future__ import annotations

import datetime
import json
import random
import re

import pyspark.sql.functions as F
import pytest

from brindle import functions, operators, sources, streaming

ROWS = "k bigint, s string, t timestamp_ntz, v double, b binary"


def some_rows(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("s"), F.col("id") % 10)).alias("s"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("t"), (F.col("id") / 3).alias("v"), F.col("id").cast("string").cast("binary").alias("b"),
    )


# ---- connector ----


@pytest.fixture
def segments(spark, tmp_path):
    sources.with_segments(spark)
    return str(tmp_path / "table")


def loaded(spark, path):
    return spark.read.format("segments").load(path)


def test_segments_round_trip_and_append(spark, segments):
    rows = some_rows(spark)
    rows.repartition(5).write.format("segments").mode("append").save(segments)
    assert sorted(map(str, loaded(spark, segments).collect())) == sorted(map(str, rows.collect()))
    assert [(f.name, f.dataType) for f in loaded(spark, segments).schema] == [(f.name, f.dataType) for f in rows.schema]
    rows.where("k < 10").write.format("segments").mode("append").save(segments)
    assert loaded(spark, segments).count() == 410 and loaded(spark, segments).select("v").count() == 410
    rows.where("k < 3").write.format("segments").mode("overwrite").save(segments)
    assert sorted(r.k for r in loaded(spark, segments).collect()) == [0, 1, 2]
    rows.limit(0).write.format("segments").mode("overwrite").save(segments)
    assert loaded(spark, segments).count() == 0
    with pytest.raises(Exception, match="no table"):
        loaded(spark, segments + "-other").count()


@pytest.mark.parametrize(
    ("condition", "most"),
    [("k = 37", 1), ("k >= 350", 2), ("k IN (1, 399)", 2), ("t < timestamp_ntz'2020-01-02'", 1), ("k > 390 AND v < 3", 1), ("s = 'zzz'", 1), ("k <= 40 AND s IS NULL", 2), ("k IS NULL", 1), ("v > 100", 3), ("s LIKE 's1%'", 8)],
)
def test_segments_leaves_out_what_filters_cannot_meet(spark, segments, condition, most):
    rows = some_rows(spark)
    rows.repartitionByRange(8, "k").write.format("segments").mode("append").save(segments)
    read = loaded(spark, segments).where(condition)
    assert sorted(r.k for r in read.collect()) == sorted(r.k for r in rows.where(condition).collect())
    assert read.rdd.getNumPartitions() <= most <= loaded(spark, segments).rdd.getNumPartitions() == 8


def test_segments_failed_task_leaves_no_rows(spark, segments):
    rows = some_rows(spark)
    rows.write.format("segments").mode("append").save(segments)
    broken = rows.repartition(4).withColumn("v", F.when(F.col("k") == 399, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        broken.write.format("segments").mode("append").save(segments)
    assert loaded(spark, segments).count() == 400


def test_segments_two_commits_of_one_version(tmp_path):
    from brindle.sources.segments import Store

    store = Store(str(tmp_path / "t"))
    store.commit({"version": 0, "schema": None, "segments": []})
    with pytest.raises(RuntimeError, match="another job"):
        store.commit({"version": 0, "schema": None, "segments": []})


def test_clustered_layout_skips_on_either_column(spark, segments):
    r = random.Random(1)
    rows = spark.createDataFrame([(r.randrange(10_000), r.randrange(10_000), None if i % 50 == 0 else i) for i in range(20_000)], "a int, b int, c int")
    operators.clustered(rows, ["a", "b"], 64).write.format("segments").mode("append").save(segments)
    every = loaded(spark, segments).rdd.getNumPartitions()
    for condition in ("a BETWEEN 100 AND 500", "b BETWEEN 9000 AND 9400"):
        read = loaded(spark, segments).where(condition)
        assert read.count() == rows.where(condition).count() > 0 and read.rdd.getNumPartitions() < every / 3
    both = loaded(spark, segments).where("a < 600 AND b < 600")
    assert both.count() == rows.where("a < 600 AND b < 600").count() and both.rdd.getNumPartitions() <= every / 10
    assert operators.clustered(rows.limit(0), ["a"], 4).count() == 0


# ---- upserts ----


def test_upserts_do_nothing_when_a_batch_comes_again(spark, tmp_path):
    schema = "k int, at int, v string"
    table = streaming.Upserts(str(tmp_path / "t"), schema, ["k"], ["at"], buckets=4)
    batch = lambda *rows: spark.createDataFrame(rows, schema)
    state = lambda: {r.k: r.v for r in table.read(spark).collect()}
    assert state() == {}
    table.write(batch((1, 5, "a"), (2, 5, "b"), (None, 1, "n"), (1, 4, "old")), 0)
    assert state() == {1: "a", 2: "b", None: "n"}
    table.write(batch((1, 9, "again"), (3, 1, "c")), 0)
    assert state() == {1: "a", 2: "b", None: "n"}
    table.write(batch((1, 3, "late"), (2, 6, "new"), (3, 1, "c"), (None, 2, "m")), 1)
    want = {1: "a", 2: "new", 3: "c", None: "m"}
    assert state() == want
    before = table.manifest(spark)
    table.write(batch((2, 7, "x")), 1)
    assert table.manifest(spark) == before and state() == want
    assert len(set(before["folders"].values())) <= 2 and before["batch"] == 1


def test_upserts_take_up_a_batch_that_failed_before_its_manifest(spark, tmp_path, monkeypatch):
    schema = "k int, at int, v string"
    table = streaming.Upserts(str(tmp_path / "t"), schema, ["k"], ["at"])
    rows = spark.createDataFrame([(i, 1, "x") for i in range(50)], schema)
    table.write(rows, 0)
    with monkeypatch.context() as m:
        m.setattr(streaming.Upserts, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            table.write(rows.withColumn("at", F.lit(2)).withColumn("v", F.lit("y")), 1)
    assert {r.v for r in table.read(spark).collect()} == {"x"}
    table.write(rows.withColumn("at", F.lit(2)).withColumn("v", F.lit("y")), 1)
    got = table.read(spark)
    assert {r.v for r in got.collect()} == {"y"} and got.count() == 50


# ---- streams with custom state ----


def test_day_totals_go_on_after_a_restart(spark, tmp_path):
    own = streaming.with_rocks(spark)
    at = lambda d, h: datetime.datetime(2024, 1, d, h)
    batches = [
        [(1, at(1, 1), 10), (1, at(1, 23), 5), (2, at(2, 1), 7)],
        [(1, at(1, 5), 1), (1, at(4, 0), 2), (2, at(2, 2), 1)],  # the watermark was at the first of January, 1 o'clock
        [(1, at(2, 0), 100), (2, at(9, 0), 3), (None, at(8, 0), 4)],  # the first is behind the third of January
        [(1, at(20, 0), 0)],
    ]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for rows in batches:
        spark.createDataFrame(rows, "u bigint, t timestamp_ntz, a bigint").write.mode("append").parquet(str(tmp_path / "in"))
        source = own.readStream.schema("u bigint, t timestamp_ntz, a bigint").parquet(str(tmp_path / "in"))
        streaming.drained(streaming.day_totals(source, "u", "t", "a", "1 day"), out, checkpoint)
    got = sorted((r.u or 0, r.day_ms // 86_400_000 - 19_722, r.n, r.amount) for r in spark.read.parquet(out).collect())
    assert got == [(0, 8, 1, 4), (1, 1, 3, 16), (1, 4, 1, 2), (2, 2, 2, 8), (2, 9, 1, 3)]


def test_day_totals_keep_a_state_for_a_bucket_of_keys_and_not_for_each_key(spark, tmp_path):
    own = streaming.with_rocks(spark)
    rows = "u bigint, t timestamp, a bigint"
    at = lambda d, h: datetime.datetime(2024, 1, d, h, tzinfo=datetime.UTC)
    users = [2**60 + i for i in range(1500)]
    batches = [
        [(u, at(d, i % 24), i) for i, u in enumerate(users) for d in (3, 4)] + [(None, at(4, 1), 7), (None, at(4, 2), None), (5, None, 1), (6, at(4, 3), None)],
        [(u, at(4, 23), 1) for u in users[::2]] + [(None, at(4, 5), 2), (users[0], at(2, 0), 100)],  # the last is behind the third of January, 23 o'clock
        [(1, at(20, 0), 0)],
    ]
    out, checkpoint, timers = str(tmp_path / "out"), str(tmp_path / "checkpoint"), []
    for b in batches:
        spark.createDataFrame(b, rows).write.mode("append").parquet(str(tmp_path / "in"))
        source = own.readStream.schema(rows).parquet(str(tmp_path / "in"))
        totals = streaming.day_totals(source, "u", "t", "a", "1 day")
        query = totals.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        timers += [p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress]
    want = {}
    for u, t, a in batches[0] + batches[1][:-1]:
        if t is not None:
            n, amount = want.get((u, t.day), (0, 0))
            want[u, t.day] = n + 1, amount + (a or 0)
    got = {(r.u, r.day_ms // 86_400_000 - 19_722): (r.n, r.amount) for r in spark.read.parquet(out).collect()}
    assert got == want and spark.read.parquet(out).count() == len(want) == 3002
    assert 0 < sum(timers) <= 300  # there are 3,003 days of users


def test_day_totals_of_other_kinds_of_keys(spark, tmp_path):
    own = streaming.with_rocks(spark)
    at = lambda d, h: datetime.datetime(2024, 1, d, h)
    keys = {"string": ["a", "", "b'\u00e9", None], "double": [0.5, float("inf"), None], "date": [datetime.date(2020, 1, d) for d in (1, 2)] + [None]}
    for k, (kind, some) in enumerate(keys.items()):
        rows, where = f"u {kind}, t timestamp_ntz, a bigint", lambda x: str(tmp_path / f"{k}-{x}")  # noqa: B023, E731
        for b in ([(u, at(1, 2), 2) for u in some], [(u, at(1, 3), 3) for u in some for _ in range(2)], [(some[0], at(9, 0), 0)]):
            spark.createDataFrame(b, rows).coalesce(1).write.mode("append").parquet(where("in"))
            streaming.drained(streaming.day_totals(own.readStream.schema(rows).parquet(where("in")), "u", "t", "a", "1 day", buckets=1), where("out"), where("checkpoint"))
        assert sorted((str(r.u), r.n, r.amount) for r in spark.read.parquet(where("out")).collect()) == sorted((str(u), 3, 8) for u in some)


def test_state_has_no_more_stores_than_asked_for_or_than_the_caller_has(spark):
    mine = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stores = lambda n=None: int(streaming.with_rocks(spark, n).conf.get("spark.sql.shuffle.partitions"))
    assert (stores(), stores(2), stores(mine + 1)) == (mine, 2, mine) and mine > 2


def test_first_seen_forgets_after_its_time_to_live(spark, tmp_path):
    own = streaming.with_rocks(spark)

    def run(name, ttl, n):
        for _ in range(n):
            spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k bigint, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / f"{name}-in"))
            source = own.readStream.schema("k bigint, v string").parquet(str(tmp_path / f"{name}-in"))
            streaming.drained(streaming.first_seen(source, ["k"], ttl), str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-checkpoint"), once=True)
        return sorted(r.k for r in spark.read.parquet(str(tmp_path / f"{name}-out")).collect())

    assert run("long", 3_600_000, 2) == [1, 2]
    assert run("short", 1, 2) == [1, 1, 2, 2]


def test_late_day_totals_of_no_rows(spark):
    empty = spark.createDataFrame([], "u bigint, t timestamp_ntz, a bigint, batch int")
    assert streaming.late_day_totals(empty, "u", "t", "a", "batch", 2, "1 day").count() == 0


# ---- aggregates, table functions, order ----


def test_longest_streak_merges_partial_states(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None]), r.choice([None, *range(-20, 60)])) for _ in range(300)] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v bigint")
    want = {}
    for k in {k for k, _ in rows}:
        values, best = {v for g, v in rows if g == k and v is not None}, (None, 0)
        for v in sorted(values):
            n = next(n for n in range(1, 200) if v + n not in values)
            best = (v, n) if n > best[1] else best
        want[k] = best
    for n in (1, 7):
        assert {x.k: (x.start, x.length) for x in functions.longest_streak(df.repartition(n), ["k"], "v").collect()} == want


def test_folded_passes_states_on(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 300).alias("k"), F.lit(1).cast("bigint").alias("v"))
    got = functions.folded(df.repartition(3), ["k"], "v", lambda: 0, lambda s, values: s + sum(values), lambda a, b: a + b, lambda s: (s,), "n bigint").collect()
    assert sorted((r.k, r.n) for r in got) == [(k, 4 if k < 100 else 3) for k in range(300)]


def test_funnel_of_a_user_with_very_many_events(spark):
    functions.register_tables(spark)
    n = 60_000
    kinds = F.element_at(F.array(*map(F.lit, ("view", "click", "purchase", "error"))), (F.col("id") % 4 + 1).cast("int"))
    events = spark.range(n).select(F.lit(1).cast("bigint").alias("user_id"), F.col("id").alias("event_id"), kinds.alias("event_type"))
    events = events.union(spark.createDataFrame([(2, 1, "click"), (2, 2, "purchase"), (2, 3, "view"), (2, 4, "purchase"), (None, 1, "view")], "user_id bigint, event_id bigint, event_type string"))
    got = spark.sql("SELECT f.* FROM funnel(TABLE(SELECT * FROM {e}) PARTITION BY user_id ORDER BY event_id) f", e=events).collect()
    assert sorted(map(tuple, got)) == [(1, k, k + 1, k + 2) for k in range(0, n, 4)]


def test_global_order_needs_no_single_task(spark):
    r = random.Random(2)
    rows = [(i, r.choice([None, 1, 2, 5]), r.choice([None, 3, -4, 10**12])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k int, v bigint")
    got = operators.globally_ordered(df.repartition(6), [F.asc_nulls_last("k"), F.desc("id")], "n", {"total": "v"}, 7)
    order = sorted(rows, key=lambda x: (x[1] is None, x[1] or 0, -x[0]))
    want, total = {}, None
    for n, (i, _, v) in enumerate(order, 1):
        total = total if v is None else (total or 0) + v
        want[i] = (n, total)
    assert {x.id: (x.n, x.total) for x in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan
    assert re.search(r"hashpartitioning\(_range", plan)
    assert operators.globally_ordered(df.limit(0), [F.asc("id")]).count() == 0
    with pytest.raises(ValueError, match="running sums"):
        operators.globally_ordered(df.withColumn("v", F.lit(1.5)), [F.asc("id")], sums={"t": "v"})


@pytest.mark.parametrize("hot", [None, 7.0])
def test_exact_quantiles_under_outliers_and_hot_values(spark, hot):
    n = 60_000
    value = (F.xxhash64("id") % 1000) / 7.0
    if hot is not None:
        value = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(value)
    df = spark.range(n).select((F.col("id") % 2).alias("k"), F.when(F.col("id") == 5, 1e15).otherwise(value).alias("v"))
    got = operators.exact_quantiles(df, ["k"], "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0})
    want = df.groupBy("k").agg(*[F.percentile("v", p).alias(c) for c, p in zip("abcde", (0.0, 0.25, 0.5, 0.9, 1.0), strict=True)])
    as_rows = lambda d: {r.k: [pytest.approx(r[c]) for c in "abcde"] for r in d.collect()}
    assert {r.k: [r[c] for c in "abcde"] for r in got.collect()} == as_rows(want)


def test_sized_join_measures_text_not_its_files(spark, tmp_path):
    spark.range(3000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("s")).write.parquet(str(tmp_path / "t"))
    right = spark.read.parquet(str(tmp_path / "t"))
    plan = lambda limit: operators.sized_join(spark.range(10).withColumnRenamed("id", "k"), right, ["k"], max_bytes=limit)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(4_000_000).lower() and "broadcast" not in plan(2_000_000).lower()


def test_weighted_sample_is_exact_and_follows_weights(spark):
    rows = spark.range(6000).select((F.col("id") % 2).alias("g"), F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, None).otherwise(F.when(F.col("id") % 4 < 2, 9.0).otherwise(1.0)).alias("w"))
    take = lambda n, seed="": sorted(r.k for r in operators.weighted_sample(rows.repartition(n), ["g"], "k", "w", 300, seed).collect())
    one = take(1)
    assert len(one) == 600 and one == take(5) != take(1, "x") and all(k % 10 for k in one)
    heavy = sum(k % 4 < 2 for k in one) / 600
    assert 0.84 < heavy < 0.94  # nine tenths of the weight
    assert operators.weighted_sample(rows.where("k < 4"), ["g"], "k", "w", 300).count() == 3


def test_jaro():
    assert functions.jaro("martha", "marhta") == pytest.approx(0.944444, abs=1e-6)
    assert functions.jaro("", "") == 1.0 and functions.jaro("", "a") == 0.0 and functions.jaro(None, "a") is None
    assert json.dumps(functions.jaro("abc", "xyz")) == "0.0"
