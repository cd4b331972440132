"""What the operators share: input shaping, staged tables, words, sorted runs.

Shapes that hold for every operator of this subpackage:

* a null text has no characters, words, lines or spans (it counts as empty);
* rows that repeat are all returned, each with the result of its document;
* columns are found by their exact name; other columns whose names differ from
  a needed or produced one by case only, or repeat it, are left out of the way.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

#: A-Z to a-z and every other ASCII byte outside [0-9a-z] to a space; bytes over 0x7F stay.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: The same words for JVM regular expressions, after lowering A-Z.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text after lowering A-Z."""
    return text.translate(WORD_TABLE).split() if text else []


def lower_ascii(c: Column) -> Column:
    """Lower A-Z only, whatever the locale."""
    return F.translate(c, _UPPER, _UPPER.lower())


def shaped(df: DataFrame, needed: Sequence[str], made: Iterable[str] = ()) -> DataFrame:
    """``df`` with each needed column once and none that clashes with ``made``.

    Columns are taken by position, so names that repeat or differ by case only
    cannot make a reference ambiguous.  A needed column that is missing is an
    error that names it.
    """
    names, keep, taken = df.columns, [], {m.lower() for m in made} - {n.lower() for n in needed}
    for n in needed:
        if n not in names:
            raise ValueError(f"column {n!r} is missing; there are {names}")
    first = {n: names.index(n) for n in needed}
    lowered = {n.lower() for n in needed}
    for i, n in enumerate(names):
        if first.get(n) == i:
            keep.append((i, n))
        elif n.lower() not in lowered and n.lower() not in taken:
            taken.add(n.lower())
            keep.append((i, n))
    if len(keep) == len(names):
        return df
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"c{i}").alias(n) for i, n in keep])


#: Bytes of an Arrow batch where the session sets no bound; rows of any length then reach Python in small batches.
BATCH_BYTES = 8 << 20


def in_small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, where the session has not done so."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.conf.get(key, None):
        spark.conf.set(key, str(BATCH_BYTES))


_local: list[str] = []
_staged: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share, from ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder of this machine serves a local
    master; with any other master it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share: staged tables go there")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="brindle-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends in files that outlive executors.

    The table lasts until ``dropped``, ``clear_staged`` or the end of this process.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _staged[path] = spark
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_at = path
    return back


def dropped(df: DataFrame) -> None:
    """Delete a staged table that no later result is derived from."""
    _delete(df._staged_at, df.sparkSession)


def clear_staged() -> None:
    """Delete every staged table of this process; results that are derived from them can't be read any more."""
    for path, spark in list(_staged.items()):
        _delete(path, spark)


def _delete(path: str, spark: SparkSession) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _staged.pop(path, None)


@atexit.register
def _at_end() -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended before
        clear_staged()


_held: dict = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept in this worker under ``key`` until another key or ``let_go`` takes its place."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Give up the tables that an earlier stage left in this worker, which Spark uses again."""
    if _held:
        _held.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def appended(df: DataFrame, columns: dict[str, str], batch_fn, source: str, holds: bool = False) -> DataFrame:
    """``df`` plus ``columns`` (name to DDL type), computed from the column ``source``.

    ``batch_fn`` gets an Arrow array of the source column and returns one list
    or Arrow array per new column.  The other columns pass through untouched,
    and rows neither move nor change in number. ``holds``: it uses ``held``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    in_small_batches(df.sparkSession)
    made = _parse_datatype_string(", ".join(f"`{k}` {t}" for k, t in columns.items()))
    kinds = [f.type for f in to_arrow_schema(made)]
    schema = StructType([*df.schema.fields, *made.fields])
    at = df.columns.index(source)
    names = [*df.columns, *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holds:
            let_go()
        for batch in batches:
            for part in pieces(batch, at):
                got = batch_fn(part.column(at))
                new = [x if isinstance(x, pa.Array) else pa.array(x, type=k) for x, k in zip(got, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=names)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, at: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose column ``at`` holds about ``limit`` bytes at most, one row at least."""
    n = batch.num_rows
    size = batch.column(at).nbytes
    step = n if size <= limit else max(1, n * limit // size)
    for i in range(0, n, step):
        yield batch.slice(i, step)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of equal leading ``keys`` columns from sorted batches, as (key, rows of the other columns)."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is then evaluated once wherever the optimizer puts it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running(values: str, step: str) -> str:
    """SQL for the running results of ``step`` (over ``a`` and ``x``, 0 at first) on an array of ints.

    In blocks of about the root of its length, as a growing array is copied at every step.
    """
    within = f"aggregate({{}}, cast(array() as array<int>), (s, x) -> concat(s, array({let('a', 'if(size(s) = 0, 0, s[size(s) - 1])', step)})))"
    blocks = f"transform(sequence(0, (size(v) - 1) div w), k -> {within.format('slice(v, int(k) * w + 1, w)')})"
    before = let("t", within.format("transform(r, y -> y[size(y) - 1])"), f"flatten(transform(r, (y, k) -> {let('a', 'if(k = 0, 0, t[k - 1])', f'transform(y, x -> {step})')}))")
    return let("v", values, f"if(size(v) = 0, v, {let('w', 'int(ceil(sqrt(size(v))))', let('r', blocks, before))})")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
