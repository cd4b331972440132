"""Totals of a key by day under a watermark, closed by timers: custom state with one emission per day.

Keys are dealt over buckets by hash, and a state is the sums of a bucket's keys on a day, as a state, a
timer or a call of Python for each key and day costs far more than the rows do. Each has an event-time
timer at the day's end; once the watermark has passed that, the totals of its keys are emitted and
forgotten, so state holds the days that are still open only. Rows behind the watermark are dropped one
by one by the engine before they come here. State lives in RocksDB, so only a bucket's day at a time
need fit in memory, and a restart takes it up from the checkpoint. Null keys have a bucket of their own.

``first_seen`` keeps keys for a time to live of processing time instead, which the store enforces.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType

from brindle.sources import scratch

DAY_MS = 86_400_000
BUCKETS = 64
_NULLS = -1  # the bucket of null keys
_PARTITION_ROWS = 500_000  # of a whole stream, for a store of state
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _summed(parts: Sequence[tuple]) -> tuple:
    """Parts of (keys, counts, amounts) as one, with each key once."""
    codes, keys = pd.factorize(pd.concat([pd.Series(k) for k, _, _ in parts], ignore_index=True), use_na_sentinel=False)
    n, amount = np.zeros((2, len(keys)), "int64")
    np.add.at(n, codes, np.concatenate([x for _, x, _ in parts]))
    np.add.at(amount, codes, np.concatenate([x for _, _, x in parts]))
    return keys, n, amount


class DayTotals(StatefulProcessor):
    """Rows (key, ``amount``) of a bucket and day to (key, day_ms, n, amount), a row for each key once the day has ended."""

    def __init__(self, key: str, kind: str):
        self.key, self.kind = key, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", f"keys array<{self.kind}>, n array<bigint>, amount array<bigint>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts, known = [], self.sums.get()
        if known is None:
            self.handle.registerTimer(int(key[1]) + DAY_MS)
        else:
            parts.append(known)
        for frame in rows:
            keys = pd.Series([None] * len(frame), dtype=object) if key[0] == _NULLS else frame[self.key]
            parts.append((keys, np.ones(len(frame), "int64"), frame["amount"].to_numpy()))
            if len(parts) == 64:
                parts = [_summed(parts)]
        keys, n, amount = _summed(parts)
        self.sums.update(([None] if key[0] == _NULLS else keys.tolist(), n.tolist(), amount.tolist()))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.sums.get()
        if known is not None:
            keys, n, amount = known
            self.sums.clear()
            yield pd.DataFrame({self.key: keys, "day_ms": int(key[1]), "n": n, "amount": amount})

    def close(self) -> None:
        pass


class FirstSeen(StatefulProcessor):
    """The first row of a key, and again once ``ttl_ms`` have passed since the key was last emitted."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        for frame in rows:
            if not known and len(frame):
                known = True
                self.seen.update((True,))
                yield frame.head(1)

    def close(self) -> None:
        pass


def with_rocks(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of its own whose streams keep state in RocksDB; the caller's settings of time and shuffles hold in it.

    ``partitions``: at most so many stores of state, each of which is opened and written in every batch.
    """
    own = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(name, spark.conf.get(name))
    if partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", min(partitions, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # else each store takes 4 MB of disk when it is opened
    return own


def day_totals(stream: DataFrame, key: str, time: str, amount: str, delay: str, buckets: int = BUCKETS) -> DataFrame:
    """(key, day_ms, n, amount) of each day of each key, once the watermark ``delay`` behind ``time`` has passed its end.

    ``buckets`` stays with a checkpoint; a bucket's keys of a day are one state and must fit in memory. A key
    that is not a number comes back as null, as pandas tells them no further.
    """
    kind = stream.schema[key].dataType
    at = stream.withColumn("_at", F.col(time).cast("timestamp")).where(F.col("_at").isNotNull()).withWatermark("_at", delay)
    bucket = F.when(F.col(key).isNull(), _NULLS).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("bigint").alias("_bucket")
    day = (F.floor(F.unix_millis("_at") / DAY_MS) * DAY_MS).cast("bigint").alias("_day_ms")
    own = F.coalesce(key, F.lit(0).cast(kind)).alias(key) if isinstance(kind, IntegralType) else F.col(key)  # with nulls pandas has floats for whole numbers
    rows = at.select(bucket, day, own, "_at", F.coalesce(F.col(amount).cast("bigint"), F.lit(0)).alias("amount")).groupBy("_bucket", "_day_ms")
    return rows.transformWithStateInPandas(DayTotals(key, kind.simpleString()), f"{key} {kind.simpleString()}, day_ms bigint, n bigint, amount bigint", "append", "eventtime")


def first_seen(stream: DataFrame, keys: Sequence[str], ttl_ms: int) -> DataFrame:
    """One row of each key in ``ttl_ms`` of processing time."""
    return stream.groupBy(*keys).transformWithStateInPandas(FirstSeen(ttl_ms), stream.schema, "append", "processingtime")


def _span(delay: str) -> timedelta:
    """A delay such as "1 day" or "90 minutes"."""
    n, unit = delay.split()
    return timedelta(**{unit.rstrip("s") + "s": int(n)})


def drained(stream: DataFrame, out: str, checkpoint: str, once: bool = False) -> None:
    """Runs a stream to the end of what there is, into Parquet; called again with the same folders it goes on from there.

    ``once``: in one batch. State in processing time needs it, as it always asks for another batch.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
    (writer.trigger(once=True) if once else writer.trigger(availableNow=True)).start().awaitTermination()


def late_day_totals(events: DataFrame, key: str, time: str, amount: str, batch: str, batches: int, delay: str) -> DataFrame:
    """``day_totals`` of a table that arrives in ``batches`` (numbered by the column ``batch``), and how many rows came too late.

    (key, day, n, amount, dropped): ``n`` and ``amount`` of the rows that the stream took. The stream
    is started anew for each batch and goes on from its checkpoint. A row after the last moves the
    watermark past all days.
    """
    spark = events.sparkSession
    folder, out, checkpoint = (scratch(spark, f"ledger-{x}") for x in ("in", "out", "checkpoint"))
    rows = events.select(key, time, amount, batch)
    n, last = rows.agg(F.count(F.lit(1)), F.max(time)).first()
    if last is None:
        return rows.select(key, F.to_date(time).alias("day"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("amount"), F.lit(0).cast("bigint").alias("dropped"))
    stores = max(6, -(-n // _PARTITION_ROWS))
    own = with_rocks(spark, stores)
    end = rows.limit(1).select(F.lit(None).cast(rows.schema[key].dataType).alias(key), F.lit(last + 3 * (timedelta(days=1) + _span(delay))).cast(rows.schema[time].dataType).alias(time), F.lit(None).cast("bigint").alias(amount), F.lit(batches).alias(batch))
    for k in range(batches + 1):
        (rows.where(F.col(batch) == k) if k < batches else end).drop(batch).write.mode("append").parquet(folder)
        source = own.readStream.schema(rows.drop(batch).schema).parquet(folder)
        drained(day_totals(source.withColumn(amount, F.coalesce(amount, F.lit(0))), key, time, amount, delay, max(BUCKETS, 8 * stores)), out, checkpoint)
    taken = spark.read.schema(f"{key} {rows.schema[key].dataType.simpleString()}, day_ms bigint, n bigint, amount bigint").parquet(out)
    taken = taken.select(F.col(key).alias("_key"), F.expr("date_add(date'1970-01-01', cast(day_ms / 86400000 as int))").alias("_day"), "n", "amount")
    every = rows.groupBy(key, F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("_all"))
    met = every.join(taken, F.col(key).eqNullSafe(F.col("_key")) & (F.col("day") == F.col("_day")), "left")
    zero = F.lit(0).cast("bigint")
    return met.select(key, "day", F.coalesce("n", zero).alias("n"), F.coalesce("amount", zero).alias("amount"), (F.col("_all") - F.coalesce("n", zero)).alias("dropped"))
