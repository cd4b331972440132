"""One way in and out for every format that Spark ships.

Schemas are given or, for self-describing formats, read from the files; text
formats never infer one, as that would read the data twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("parquet", "orc", "csv", "json", "xml", "text", "binaryFile")
_DESCRIBED = {"parquet", "orc", "text", "binaryFile"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    """Temporary views of the folder's tables, for SQL."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


def read(spark: SparkSession, path: str, kind: str = "parquet", schema: StructType | str | None = None, **options: str) -> DataFrame:
    if kind not in FORMATS:
        raise ValueError(f"format {kind!r} is not one of {FORMATS}")
    if schema is None and kind not in _DESCRIBED:
        raise ValueError(f"{kind} files need a schema")
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write(df: DataFrame, path: str, kind: str = "parquet", partition_by: tuple[str, ...] = (), mode: str = "errorifexists", **options: str) -> None:
    """Write ``df``; rows are brought together by the partition columns first, so each value gets few files."""
    if kind not in FORMATS or kind == "binaryFile":
        raise ValueError(f"format {kind!r} cannot be written")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.format(kind).options(**options).mode(mode).partitionBy(*partition_by).save(path)
