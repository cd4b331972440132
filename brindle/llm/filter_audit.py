"""Audit of how five document filters interact, in every order of application.

A document fails

* ``A`` with under 50 words, ``B`` if 100 * distinct words < 65 * words, words being maximal
  ``[^\\x20\\x09-\\x0D]+``, case-sensitive;
* ``C`` if 100 * ``[A-Z]`` characters > 5 * code points, ``D`` if it holds any of ``#$%&*|``;
* ``E`` if its text is that of any smaller doc_id, anywhere in the table.

1. Each task judges A to D and folds equal texts: a text that it has met goes on with its least
   doc_id only, and all other rows of it are known to fail E. The fold holds ``FOLD_BYTES`` of
   texts at most and passes the one that was met longest ago on.
2. What is left is an RDD of (xxhash of the text, text and row), dealt out by that fingerprint. A
   task keeps a chain for each fingerprint: the full texts that share it, each with its least
   doc_id. The rows of every other doc_id are emitted as failing E.
3. Rows (doc_id, part, failures) without texts take their labels by a join, and ``combineByKey``
   adds vectors of counts by mask of failures up for each part, before and after the shuffle.
4. A part's vector of 32 masks gives its 120 orders of 5 steps by two products with 0/1 matrices.

So a text, source or doc_id that a third of all rows share costs a row for each task. Partitions of
the fingerprint hold about ``ROUTED_BYTES`` of texts, as counted before.

Defined results: a null text counts as empty (it fails A, and E beside a smaller doc_id that is
empty too); a null source is the part of the empty string. Rows that repeat are counted each, and
equal doc_ids do not make one another fail E, whatever their texts; a null doc_id counts as larger
than all others, and two of them as equal. A document is good if any row of its doc_id in the labels
says so, toxic likewise; null doc_ids have no labels. Very long texts are taken whole. An empty
table gives no rows. ``source`` and ``doc_id`` must be there; other columns are not looked at.
"""

from __future__ import annotations

import itertools
from collections import Counter, OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pyspark.sql.functions as F
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from brindle.llm.common import in_small_batches, let_go, shaped

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
STEPS = len(FILTERS)
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"
#: Bytes of texts that a task folds at once, and that a partition of fingerprints holds on average.
FOLD_BYTES, ROUTED_BYTES = 32 << 20, 64 << 20

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_E = 1 << FILTERS.index("E")


def failures(text: str) -> int:
    """The mask of A to D that a text fails; bit i stands for the i-th filter."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes: ASCII white space only
    upper = len(data) - len(data.translate(None, _UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > UPPER_PERCENT * len(text)) << 2
        | (len(data.translate(None, SYMBOLS)) < len(data)) << 3
    )


def _order(doc_id) -> tuple:
    return (doc_id is None, doc_id)


class Text:
    """A text's mask, its least doc_id and how many rows of which part have that id."""

    __slots__ = ("least", "mask", "parts")

    def __init__(self, mask: int, least, parts: Counter):
        self.mask, self.least, self.parts = mask, least, parts

    def add(self, doc_id, parts: Counter) -> Iterator[tuple]:
        """Takes rows of this text in and gives those (doc_id, part, mask, rows) that now fail E."""
        if doc_id == self.least:
            self.parts.update(parts)
            return
        if _order(doc_id) < _order(self.least):
            doc_id, self.least, parts, self.parts = self.least, doc_id, self.parts, parts
        for part, n in parts.items():
            yield doc_id, part, self.mask | _E, n

    def rows(self) -> Iterator[tuple]:
        for part, n in self.parts.items():
            yield self.least, part, self.mask, n


def fold(rows: Iterable, limit: int = FOLD_BYTES) -> Iterator[tuple]:
    """From (doc_id, text, part), (fingerprint, (text, mask, doc_id, parts)) of texts and (negative, failing row) of others."""
    let_go()
    met: OrderedDict[str, Text] = OrderedDict()
    held = 0
    for doc_id, text, part in rows:
        if (known := met.get(text)) is not None:
            met.move_to_end(text)
            for row in known.add(doc_id, Counter({part: 1})):
                yield -1 - xxhash.xxh64_intdigest(repr(row[0])), row
            continue
        met[text] = Text(failures(text), doc_id, Counter({part: 1}))
        held += len(text)
        while held > limit and len(met) > 1:
            oldest, x = met.popitem(last=False)
            held -= len(oldest)
            yield _routed(oldest, x)
    for text, x in met.items():
        yield _routed(text, x)


def _routed(text: str, x: Text) -> tuple:
    data = text.encode("utf-8", "surrogatepass")
    return xxhash.xxh64_intdigest(data), (data, x.mask, x.least, x.parts)


def chain(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Rows (doc_id, part, mask, n) from what ``fold`` gives, all of whose equal texts are in this partition."""
    chains: dict[int, dict[bytes, Text]] = {}
    for fingerprint, row in rows:
        if fingerprint < 0:
            yield row
            continue
        data, mask, doc_id, parts = row
        same = chains.setdefault(fingerprint, {})  # texts that collide in the fingerprint are told apart in full
        if data in same:
            yield from same[data].add(doc_id, parts)
        else:
            same[data] = Text(mask, doc_id, parts)
    for same in chains.values():
        for x in same.values():
            yield from x.rows()


def judged(docs: DataFrame, partitions: int | None = None) -> RDD:
    """(doc_id, part, mask of failures, rows) over the whole table; rows equal in all but the last may come several times."""
    docs = shaped(docs, ["doc_id", "text", "source"])
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    if partitions is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // ROUTED_BYTES))
    return docs.rdd.mapPartitions(fold).partitionBy(partitions, lambda k: k).mapPartitions(chain)


def _matrices() -> tuple[np.ndarray, ...]:
    """0/1 by (order and step, mask): kept, removed, redundant; the step's filter."""
    masks = np.arange(1 << STEPS)
    kept, removed, redundant, own = [], [], [], []
    for order in ORDERS:
        before = 0
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            fails, gone = (masks & bit) > 0, (masks & before) > 0
            removed.append(fails & ~gone)
            redundant.append(fails & gone)
            before |= bit
            kept.append((masks & before) == 0)
            own.append(FILTERS.index(letter))
    return *(np.array(x, np.int64) for x in (kept, removed, redundant)), np.array(own)


def orders(counts: np.ndarray) -> Iterator[tuple]:
    """(order, step, COUNTS) of a part, from its (rows, good, toxic) by mask of failures."""
    kept, removed, redundant, own = _matrices()
    total, good, toxic = counts.astype(np.int64)
    gone = removed @ total
    alone = total[1 << own]
    shapley = np.bincount(own, weights=gone, minlength=STEPS) if gone.max(initial=0) < 1 << 44 else np.array([sum(map(int, gone[own == f])) for f in range(STEPS)], object)
    table = (kept @ total, gone, redundant @ total, alone, removed @ good, removed @ toxic, shapley[own])
    for i, row in enumerate(zip(*table, strict=True)):
        yield ORDERS[i // STEPS], i % STEPS + 1, *map(int, row)


def _counted(vector: np.ndarray, row: tuple) -> np.ndarray:
    mask, n, good, toxic = row
    vector[:, mask] += (n, n * good, n * toxic)
    return vector


def audit(docs: DataFrame, labels: DataFrame, partitions: int | None = None) -> DataFrame:
    """``part``, ``filter_order``, ``step`` and COUNTS: 600 rows for each part of ``docs``."""
    spark = docs.sparkSession
    in_small_batches(spark)
    kind = docs.schema[docs.columns.index("doc_id")].dataType
    schema = StructType([StructField("doc_id", kind), StructField("part", StringType()), StructField("mask", IntegerType()), StructField("n", LongType())])
    rows = spark.createDataFrame(judged(docs, partitions), schema, verifySchema=False)
    known = shaped(labels, ["doc_id", "quality", "toxic"]).where("doc_id IS NOT NULL").groupBy("doc_id")
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    zero = F.lit(0)
    labelled = rows.join(known, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic"))
    empty = lambda row: _counted(np.zeros((3, 1 << STEPS), np.int64), row)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = labelled.rdd.map(lambda r: (r[0], tuple(r[1:]))).combineByKey(empty, _counted, lambda a, b: a + b, n, xxhash.xxh64_intdigest)
    out = vectors.flatMap(lambda kv: [(kv[0], *row) for row in orders(kv[1])])
    columns = [StructField("part", StringType()), StructField("filter_order", StringType()), StructField("step", IntegerType())]
    return spark.createDataFrame(out, StructType([*columns, *(StructField(c, LongType()) for c in COUNTS)]), verifySchema=False)
