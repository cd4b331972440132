"""Benchmark decontamination: a broadcast hash set of test n-grams against token windows.

An item of ten words or more gives all its windows of ten words; a shorter one
gives one window of all its words. Document words become ids of the benchmark's
vocabulary, windows with a foreign word are ruled out by a running count, the
others are looked up by a rolling hash, and each hash hit is verified word by
word. Documents are scanned where they lie: no shuffle.

The broadcast index is built only after the benchmark's words and bytes have been
counted and stay within ``MAX_INDEX_WORDS`` and ``MAX_INDEX_BYTES``. Beyond them windows
and documents meet by a join on the window instead (``scan_by_join``), with equal
results: windows of all lengths come from one pass, and those whose hash no test has
are dropped before they move while the tests' hashes are ``MAX_HASHES`` at most.

Defined results: null and empty texts have no words and are clean; items without
words give no window; an item whose id is null makes hits but is not listed; an
empty benchmark leaves every document clean and an empty table gives an empty
result; very long texts are scanned whole; documents without doc_id and repeated
rows are all judged; input columns named like a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from brindle.llm.common import NON_WORD, appended, let, lower_ascii, running, shaped, staged, words_of

WINDOW = 10
#: Words of all benchmark items together up to which the index is broadcast (some 250 bytes each in a worker).
MAX_INDEX_WORDS = 500_000
#: Bytes of all items together up to which they are collected, words or not.
MAX_INDEX_BYTES = 64 << 20
#: Distinct window hashes of the tests that the join path broadcasts, of 8 bytes and a length each.
MAX_HASHES = 4_000_000

FOUND = {"n_words": "bigint", "n_hit": "bigint", "items": "array<string>", "hits": "array<struct<start:bigint,end:bigint>>"}

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Index:
    """Windows of the benchmark by length: sorted hashes, and exact windows with their items."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[int, dict[bytes, set[str]]] = {}
        for item, text in items:
            words = words_of(text)
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32)
            k = min(width, len(ids))
            for i in range(len(ids) - k + 1 if k else 0):
                windows.setdefault(k, {}).setdefault(ids[i : i + k].tobytes(), set()).update([item] * (item is not None))
        self.windows = {k: {w: sorted(names) for w, names in x.items()} for k, x in windows.items()}
        self.hashes = {k: np.unique(self.hash(np.frombuffer(b"".join(x), np.int32).reshape(-1, k).T)) for k, x in self.windows.items()}

    @staticmethod
    def hash(columns: np.ndarray) -> np.ndarray:
        h = np.zeros(columns.shape[1], np.uint64)
        for c in columns:
            h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        return h

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: its words, the merged spans of hit words, its items sorted as strings."""
        get = self.vocabulary.get
        ids: list[int] = []
        bounds = [0]
        for t in texts:
            ids += [get(w, 0) for w in words_of(t)]
            ids.append(0)  # no window spans two texts
            bounds.append(len(ids))
        a = np.array(ids, np.int32)
        foreign = np.concatenate([[0], np.cumsum(a == 0)])
        begins, ends, items = [], [], [set() for _ in texts]
        for k, exact in self.windows.items():
            if len(a) < k:
                continue
            at = np.flatnonzero(foreign[k:] == foreign[:-k])
            h = self.hash(np.stack([a[at + i] for i in range(k)]))
            known = self.hashes[k]
            at = at[known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h]
            owner = np.searchsorted(bounds, at, side="right") - 1
            for p, d in zip(at.tolist(), owner.tolist(), strict=True):
                names = exact.get(a[p : p + k].tobytes())
                if names is not None:
                    begins.append(p)
                    ends.append(p + k)
                    items[d].update(names)
        cover = np.zeros(len(a) + 1, np.int64)
        np.add.at(cover, begins, 1)
        np.add.at(cover, ends, -1)
        edge = np.diff(np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        for s, e, d in zip(first.tolist(), last.tolist(), (np.searchsorted(bounds, first, side="right") - 1).tolist(), strict=True):
            spans[d].append((s - bounds[d], e - bounds[d]))
        return [(bounds[d + 1] - bounds[d] - 1, spans[d], sorted(items[d])) for d in range(len(texts))]


def index_size(benchmark: DataFrame) -> tuple[int, int]:
    """An upper bound of the benchmark's words, and its bytes, counted before anything is collected."""
    text = F.coalesce("text", F.lit(""))
    sizes = shaped(benchmark, ["text"]).select(F.sum(F.size(F.split(text, NON_WORD))).alias("n"), F.sum(F.octet_length(text)).alias("bytes"))
    found = sizes.first()
    return found["n"] or 0, found["bytes"] or 0


def scan(docs: DataFrame, benchmark: DataFrame, max_index_words: int = MAX_INDEX_WORDS, max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit``, ``items`` and ``hits`` (spans of word numbers)."""
    docs = shaped(docs, ["text"], FOUND)
    words, size = index_size(benchmark)
    if words > max_index_words or size > max_index_bytes:
        return scan_by_join(docs, benchmark)
    rows = shaped(benchmark, ["item_id", "text"]).select(F.col("item_id").cast("string"), F.encode(F.coalesce("text", F.lit("")), "UTF-8")).collect()
    index = docs.sparkSession.sparkContext.broadcast(Index([(r[0], bytes(r[1])) for r in rows]))

    def batch(column: pa.Array) -> list[list]:
        found = index.value.scan(column.to_pylist())
        return [
            [n for n, _, _ in found],
            [sum(e - s for s, e in spans) for _, spans, _ in found],
            [names for _, _, names in found],
            [[{"start": s, "end": e} for s, e in spans] for _, spans, _ in found],
        ]

    return appended(docs.withColumn("_bytes", F.encode("text", "UTF-8")), FOUND, batch, "_bytes").drop("_bytes")


def _words(text: str) -> F.Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NON_WORD), lambda w: w != "")


def scan_by_join(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, max_hashes: int = MAX_HASHES) -> DataFrame:
    """As ``scan``, for a benchmark too large to broadcast: windows meet by their hash and are equal word by word.

    Distinct texts move once by a digest, to fold copies, and once more with their
    rows at the end; in between a window moves only where its hash is a test's. What
    meets is written before it is gathered by document, so that the join of a window
    that very many documents hold can be split.
    """

    def windows(words: str, k: int) -> F.Column:
        one = lambda i: F.concat_ws(" ", F.slice(words, i + 1, F.lit(k)))
        some = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.struct(F.lit(k).alias("k"), F.xxhash64(one(i)).alias("hash"), i.alias("start"), one(i).alias("window")))
        return F.when(F.size(words) >= k, some).otherwise(F.expr("cast(array() as array<struct<k:int,hash:bigint,start:int,window:string>>)"))

    items = shaped(benchmark, ["item_id", "text"]).select(F.col("item_id").cast("string").alias("item"), _words("text").alias("w")).where(F.size("w") > 0)
    own = F.coalesce(*[F.when(F.least(F.lit(width), F.size("w")) == k, windows("w", k)) for k in range(1, width + 1)])
    tests = staged(items.select("item", F.explode(own).alias("x")).select("item", "x.k", "x.hash", "x.window").distinct(), "test-windows")
    hashes = tests.select("k", "hash").distinct()
    counted = hashes.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()  # ``width`` rows at most
    lengths = sorted(r["k"] for r in counted)
    keyed = docs.withColumn("_doc", F.md5(F.coalesce("text", F.lit(""))))
    told = keyed.select("_doc", "text").dropDuplicates(["_doc"]).select("_doc", _words("text").alias("w"))
    every = told.select("_doc", F.explode(F.flatten(F.array(*[windows("w", k) for k in lengths]))).alias("x")).select("_doc", "x.*") if lengths else docs.sparkSession.createDataFrame([], "_doc string, k int, hash bigint, start int, window string")
    if sum(r["n"] for r in counted) <= max_hashes:
        every = every.join(F.broadcast(hashes), ["k", "hash"], "left_semi")
    pairs = staged(every.join(tests, ["k", "hash", "window"]).select("_doc", "start", "k", "item"), "test-hits")
    met = pairs.groupBy("_doc").agg(F.collect_set(F.struct("start", "k")).alias("met"), F.array_sort(F.collect_set("item")).alias("items"))
    # spans begin where a window starts beyond all earlier ends, and end at the greatest end before the next begins
    spans = let(
        "g", running("transform(s, x -> x.start + x.k)", "greatest(a, x)"),
        let("b", "filter(sequence(0, size(s) - 1), i -> i = 0 or s[i].start > g[i - 1])",
            "transform(b, (i, n) -> named_struct('start', bigint(s[i].start), 'end', bigint(g[if(n + 1 < size(b), b[n + 1], size(s)) - 1])))"),
    )
    kind = "array<struct<start:bigint,end:bigint>>"
    hits = let("s", "coalesce(array_sort(met), cast(array() as array<struct<start:int,k:int>>))", f"if(size(s) = 0, cast(array() as {kind}), {spans})")
    done = told.join(met, "_doc", "left").select(
        "_doc", F.size("w").cast("bigint").alias("n_words"), F.expr("coalesce(items, cast(array() as array<string>))").alias("items"), F.expr(hits).alias("hits")
    )
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    done = done.select("_doc", "n_words", n_hit.alias("n_hit"), "items", "hits")
    return keyed.join(done, "_doc").drop("_doc")


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or with the hit words cut from ``text`` (``remove="spans"``)."""
    names = docs.columns
    found = scan(docs, benchmark)
    if remove == "documents":
        return found.where("n_hit = 0").select(*[n for n in names if n in found.columns])
    at = found.columns.index("hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [without(t, h) if h else t for t, h in zip(b.column(b.schema.get_field_index("text")).to_pylist(), b.column(at).to_pylist(), strict=True)]
            k = b.schema.get_field_index("text")
            yield b.set_column(k, b.schema.field(k), pa.array(texts, b.schema.field(k).type))

    return found.mapInArrow(cut, found.schema).select(*[n for n in names if n in found.columns])


def without(text: str, hits: list[dict]) -> str:
    """``text`` less the characters from the first to the last word of each span of word numbers."""
    b = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(b)]
    out, last = [], 0
    for h in hits:
        out.append(b[last : at[h["start"]][0]])
        last = at[h["end"] - 1][1]
    return b"".join([*out, b[last:]]).decode("utf-8", "surrogatepass")
