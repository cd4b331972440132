"""A table of the latest row of each key, kept by a stream; a batch that comes again changes nothing.

Keys are dealt over a fixed number of buckets by hash. A batch rewrites the buckets that its keys fall
into, in a folder of its own, and then swaps the manifest: a file per batch that names the folder of
every bucket and is renamed into place whole. Readers take the manifest of the greatest batch. A batch
that has a manifest is skipped, so a replay after a restart does nothing; one that failed before its
manifest is written again from the state that it began with, and what it left is not looked at.

The latest row has the greatest of the order columns, so rows may come late and in any order. Null keys
are a key of their own. One stream at a time writes a table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

BUCKETS = 16


class Upserts:
    """The table at ``path`` with rows of ``schema`` (a DDL string or struct), one of each ``keys``."""

    def __init__(self, path: str, schema, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS):
        self.path, self.schema, self.keys, self.order, self.buckets = path.rstrip("/"), schema, list(keys), list(order), buckets

    def manifest(self, spark: SparkSession) -> dict:
        """{"batch": number or -1, "folders": {bucket: folder}}."""
        folder, files = self._at(spark, "manifests")
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        known = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")
        if not known:
            return {"batch": -1, "folders": {}}
        path, _ = self._at(spark, f"manifests/{known[-1]:012d}.json")
        stream = files.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of the last batch."""
        return self._rows(spark, self.manifest(spark)["folders"])

    def write(self, batch: DataFrame, number: int) -> None:
        """Takes a batch in; the function of ``foreachBatch``."""
        spark = batch.sparkSession
        known = self.manifest(spark)
        if number <= known["batch"]:
            return
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")
        hit = [str(r["bucket"]) for r in batch.select(bucket).distinct().collect()]  # ``buckets`` rows at most
        new = batch.unionByName(self._rows(spark, {b: f for b, f in known["folders"].items() if b in hit}))
        columns = new.columns
        latest = F.max_by(F.struct(*columns), F.struct(*self.order, *[c for c in columns if c not in self.order])).alias("r")
        rows = new.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(self.keys)]).agg(latest).select("r.*").withColumn("bucket", bucket)
        folder = f"batch={number}"
        rows.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")
        self._commit(spark, {"batch": number, "folders": known["folders"] | dict.fromkeys(hit, folder)})

    def _rows(self, spark: SparkSession, folders: dict[str, str]) -> DataFrame:
        paths = [f"{self.path}/{folder}/bucket={b}" for b, folder in sorted(folders.items())]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def _at(self, spark: SparkSession, name: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _commit(self, spark: SparkSession, manifest: dict) -> None:
        name = f"{manifest['batch']:012d}.json"
        hidden, files = self._at(spark, f"manifests/.{name}")
        stream = files.create(hidden, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not files.rename(hidden, self._at(spark, f"manifests/{name}")[0]):
            raise RuntimeError(f"batch {manifest['batch']} has been committed meanwhile")


def upserted(stream: DataFrame, table: Upserts, checkpoint: str) -> None:
    """Runs a stream to the end of what there is, into ``table``."""
    query = stream.writeStream.foreachBatch(table.write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
