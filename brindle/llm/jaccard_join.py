"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of five-word shingles (``common.words_of``; a text of one to four
words is one shingle).  The join finds all pairs of texts with Jaccard
similarity of at least ``THRESHOLD`` and returns, for every row, its copies' id,
its class (connected component of links) and its number of links.

1. Texts with equal shingle sets fold into one representative, so copies are
   never expanded; their number becomes a weight.
2. Representatives meet in buckets of ``BANDS`` x ``ROWS`` MinHash values. A pair
   at the threshold misses all bands with probability (1 - 0.8^3)^24 = 3e-8.
   A bucket whose members are those of a bucket of an earlier band goes (told by
   128-bit digests of the members): its pairs have met there.
3. MinHash values are compared ``STEP`` at a time; a pair is dropped when the
   posterior P(J >= threshold | matches so far), from a uniform prior, falls
   under ``TOLERANCE``. A bucket of over ``CHUNK`` members is cut into chunks by a
   hash, and pairs of chunks are separate groups. A pair is judged in the first
   band it shares only, so no two groups judge it twice; members that share the
   key of an earlier band are set apart as a whole, so that the cells examined
   stay near the pairs that are new. Groups emit the members
   that still have a partner, never pairs.
4. Those members' shingle sets, made again from their texts, meet in groups of
   their own, cut by the bytes of the sets and by members (``GROUP_BYTES``,
   ``GROUP_MEMBERS``). There the same pairs survive again and are verified exactly. A group emits,
   per member, the weight of its links and the least member it is linked with,
   directly or not.
5. Classes are the components of those star edges, by repeated minimum labels
   with path halving over staged tables.

Work is linear in rows plus the pairs of different texts that share a bucket, of
which every link must be counted; rows moved are linear in rows times chunks of
their bucket.

Defined results: null texts and texts without words have no shingles; such a row
is alone in its class and has no links (``copy_id`` null, ``class_id`` its
doc_id). ``copy_id`` is the least doc_id of the texts with the same shingles and
``class_id`` that of the class, null ids left out. Very long texts are sets of as
many shingles, verified whole.
``n_links`` counts the other rows that are linked, copies included, so repeated
rows count each other.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import Column, DataFrame

from brindle.llm.common import appended, dropped, in_small_batches, let_go, runs, shaped, staged, words_of

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 3
HASHES = BANDS * ROWS
STEP, TOLERANCE = 12, 1e-6
CHUNK = 2048
#: Bytes of shingle sets, and members, that each side of a group of exact verification has on average at most.
GROUP_BYTES, GROUP_MEMBERS = 8 << 20, 256
#: Bytes of dense shingle columns, and pairs of members, that one group holds at once.
SLAB, BLOCK = 16 << 20, 1 << 20

_rng = np.random.default_rng(20_240_229)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_FOLD = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((known[w] if w in known else known.setdefault(w, digest(w)) for w in words), np.uint64, len(words))
    k = min(width, len(words))
    out = np.full(len(words) - k + 1, len(words) if len(words) < width else 0, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def minhash(s: np.ndarray, block: int = 4096) -> np.ndarray:
    """HASHES minima, each mixed down to 16 bits; two that differ meet by chance once in 65,536."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), block):
        low = np.minimum(low, (s[i : i + block] * _A[:, None] + _B[:, None]).min(1))
    low ^= low >> np.uint64(32)
    return (low * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)).astype(np.uint16)


def band_keys(sigs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each signature and band; the band's number takes part."""
    v = sigs.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), v.shape[:2])
    for i in range(ROWS):
        key = (key ^ v[:, :, i]) * _FOLD[i]
        key ^= key >> np.uint64(31)
    return key


@cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of values compared, the fewest matches that keep a pair.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), and P(J >= t) is
    the binomial sum of C(n + 1, k) t^k (1 - t)^(n + 1 - k) over k <= m.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def survivors(sigs: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) that Bayesian pruning keeps."""
    need = least_matches()
    matches = np.zeros(len(i), np.int32)
    for n in range(0, HASHES, STEP):
        if len(i) == 0:
            break
        matches += (sigs[i, n : n + STEP] == sigs[j, n : n + STEP]).sum(1, dtype=np.int32)
        ok = matches >= need[n + STEP]
        i, j, matches = i[ok], j[ok], matches[ok]
    return i, j


def apart(keys: np.ndarray, left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Blocks of members (left and right, or one set) that hold each pair that shares no earlier band once, and few that share one.

    The largest part that shares the key of a band leaves its own pairs out, and goes on against the
    rest of the members. So a bucket whose members are nearly those of an earlier one is nearly free.
    """
    todo = [(left, right, 0)]
    while todo:
        a, b, k = todo.pop()
        cells = len(a) * len(a if b is None else b)
        if cells < (2 if b is None else 1) ** 2:
            continue
        if k == keys.shape[1] or cells < 4096:
            yield a, b
            continue
        own = keys[a, k]
        values, counts = np.unique(own, return_counts=True)
        if b is None:
            most = counts.argmax()
            if 4 * counts[most] < len(a):
                todo.append((a, None, k + 1))
                continue
            inside = own == values[most]
            todo += [(a[inside], a[~inside], k + 1), (a[~inside], None, k)]
            continue
        other, many = np.unique(keys[b, k], return_counts=True)
        common, i, j = np.intersect1d(values, other, assume_unique=True, return_indices=True)
        worth = counts[i] * many[j]
        if not len(common) or 8 * worth.max() < cells:
            todo.append((a, b, k + 1))
            continue
        key = common[worth.argmax()]
        inside = own == key
        todo += [(a[inside], b[keys[b, k] != key], k + 1), (a[~inside], b, k)]


def alive(band: int, own: bool, sides: list[int], sigs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of surviving index pairs of a group, within it or between its two chunks.

    Pairs that share an earlier band are left to it.
    """
    keys = band_keys(sigs)[:, :band]
    side = np.array(sides)
    left, right = (np.arange(len(side)), None) if own else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    for a, b in apart(keys, left, right):
        alone, b = b is None, a if b is None else b
        step = max(1, BLOCK // max(1, len(b)))
        for start in range(0, len(a), step):
            some = a[start : start + step]
            fresh = some[:, None] < b[None, :] if alone else np.ones((len(some), len(b)), bool)
            for k in range(min(band, 2)):
                fresh &= keys[some, k][:, None] != keys[b, k][None, :]
            i, j = np.nonzero(fresh)
            i, j = some[i], b[j]
            for k in range(2, band):
                new = keys[i, k] != keys[j, k]
                i, j = i[new], j[new]
            i, j = survivors(sigs, i, j)
            if len(i):
                yield i, j


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted (bucket, c1, c2, band, side, key, sig, cuts), the members that keep a partner, by group of verification."""
    let_go()
    out: list[tuple] = []
    for (bucket, c1, c2, band), rows in runs(batches, 4):
        if len(rows) < 2:
            continue
        sigs = np.frombuffer(b"".join(r[2] for r in rows), np.uint16).reshape(-1, HASHES)
        cuts = rows[0][3]
        part = np.array([int.from_bytes(r[1][:8], "little") % cuts for r in rows])
        met = np.empty(0, np.int64)  # member and the other's part, as one number
        for i, j in alive(band, c1 == c2, [r[0] for r in rows], sigs):
            met = np.unique(np.concatenate([met, i * cuts + part[j], j * cuts + part[i]]))
        for k, other in zip((met // cuts).tolist(), (met % cuts).tolist(), strict=True):
            own = int(part[k])
            out.append((rows[k][1], bucket, min(own, other), max(own, other), band, int(own > other), rows[k][2]))
        if len(out) > 10_000:
            yield _batch(out, _MEMBER)
            out = []
    if out:
        yield _batch(out, _MEMBER)


_MEMBER = pa.schema([("key", pa.binary()), ("bucket", pa.int64()), ("c1", pa.int32()), ("c2", pa.int32()), ("band", pa.int32()), ("side", pa.int32()), ("sig", pa.binary())])
_LINKED = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("least", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, crossings: np.ndarray | None = None, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose exact Jaccard similarity reaches the threshold; ``crossings``: sizes of all intersections, if known."""
    size = np.array([len(s) for s in sets])
    fit = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
    i, j = i[fit], j[fit]
    if crossings is not None:
        both = crossings[i, j]
    else:
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    ok = both >= threshold * (size[i] + size[j] - both) - 1e-9
    return i[ok], j[ok]


def _crossings(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of dense slabs of shingle columns."""
    n = len(sets)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in sets])[order]
    every = every[order]
    del order
    fresh = np.concatenate([[True], every[1:] != every[:-1]])
    count = np.diff(np.append(np.flatnonzero(fresh), len(every)))
    everywhere = count == n
    shared = (count > 1) & ~everywhere
    use = np.repeat(shared, count)
    column = np.repeat((np.cumsum(shared) - 1).astype(np.int32), count)[use]
    rows = rows[use]
    del every, fresh, use
    out = np.full((n, n), float(everywhere.sum()), np.float32)
    width = max(1, SLAB // (4 * n))
    dense = np.zeros((n, width), np.float32)
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        dense[:] = 0
        dense[rows[a:b], column[a:b] - start] = 1
        out += dense @ dense.T
    return np.rint(out).astype(np.int32)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted (bucket, c1, c2, band, side, key, sig, weight, set), links and star edges per member."""
    let_go()
    out: list[tuple] = []
    for (_, c1, c2, band), rows in runs(batches, 4):
        rows = list({r[1]: r for r in rows}.values())
        if len(rows) < 2:
            continue
        sets = [np.frombuffer(r[4], np.uint64) for r in rows]
        sigs = np.frombuffer(b"".join(r[2] for r in rows), np.uint16).reshape(-1, HASHES)
        weight = np.array([r[3] for r in rows])
        names = [r[1] for r in rows]
        links = np.zeros(len(rows), np.int64)
        up = list(range(len(rows)))
        crossings = None
        for i, j in alive(band, c1 == c2, [r[0] for r in rows], sigs):
            if crossings is None and len(i) > 4 * len(sets):
                crossings = _crossings(sets)
            i, j = similar(sets, i, j, crossings)
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            _unite(up, i, j, names)
        out += [(names[k], int(links[k]), names[_root(up, k)]) for k in np.flatnonzero(links).tolist()]
        del rows, sets, crossings
        if len(out) > 10_000:
            yield _batch(out, _LINKED)
            out = []
    if out:
        yield _batch(out, _LINKED)


def _root(up: list[int], x: int) -> int:
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def _unite(up: list[int], i: np.ndarray, j: np.ndarray, names: list[bytes]) -> None:
    """Joins the components of pairs; the member of the least name is the root."""
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = _root(up, a), _root(up, b)
        if x != y:
            if names[y] < names[x]:
                x, y = y, x
            up[y] = x


def signatures(texts: DataFrame) -> DataFrame:
    """``texts`` (bytes) plus ``key`` (128-bit digest of the shingle set), ``sig``, ``bands`` and ``size``; null without words."""

    def batch(column: pa.Array) -> list[list]:
        keys, sigs, bands, sizes = [], [], [], []
        for t in column:
            s = shingles(t.as_py())
            keys.append(_key(s) if len(s) else None)
            sig = minhash(s) if len(s) else None
            sigs.append(None if sig is None else sig.tobytes())
            bands.append(None if sig is None else band_keys(sig)[0].view(np.int64))
            sizes.append(len(s))
        return [keys, sigs, bands, sizes]

    return appended(texts, {"key": "binary", "sig": "binary", "bands": "array<bigint>", "size": "bigint"}, batch, "bytes").drop("bytes")


def _key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``texts`` (bytes, key, others) with ``set``, the shingles, for rows whose text has that key."""

    def batch(column: pa.Array) -> list[list]:
        sets = [shingles(t.as_py()) for t in column]
        return [[s.tobytes() for s in sets], [_key(s) for s in sets]]

    out = appended(texts, {"set": "binary", "again": "binary"}, batch, "bytes")
    return out.where("again = key").drop("bytes", "again")


def components(edges: DataFrame) -> DataFrame:
    """(key, root): the least key of each component of ``edges`` (a, b).

    Labels take the minimum over neighbours, then over their label's label, until
    nothing changes. Aggregates are partial before they shuffle, so a hub costs
    one row per task; the join on a hub's label is split by adaptive execution.
    """
    edges = edges.where("a <> b").select("a", "b")
    both = staged(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("key"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        hop = labels.join(near, F.col("key") == F.col("a")).select("key", F.least("root", "near").alias("step"), F.col("root").alias("old"))
        far = labels.select(F.col("key").alias("step"), F.col("root").alias("jump"))
        new = staged(hop.join(far, "step").select("key", F.least("step", "jump").alias("root"), "old"), "labels")
        dropped(labels)
        labels = new
        if labels.where("root <> old").isEmpty():
            dropped(both)
            return labels.select("key", "root")


def join(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``doc_id``, ``copy_id``, ``class_id``, ``n_links``: a row for each row of ``docs``."""
    return classes(docs, chunk).select(
        "doc_id",
        F.col("of.doc_id").alias("copy_id"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )


def one_of_each(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with one document of each class: that of the least doc_id, ids that are null last.

    A document without words is a class of its own. Rows equal in doc_id and
    text are one document, of which one row stays.
    """
    docs = shaped(docs, ["doc_id", "text"], ["_row"])
    names = docs.columns
    stay = classes(docs, chunk).where(F.col("key").isNull() | (F.col("row") == F.col("first.row"))).select(F.col("row").alias("_row")).distinct()
    # The rows are dealt by the one key of the join, which serves to drop repeats as well.
    return docs.withColumn("_row", _row()).join(stay, "_row", "left_semi").dropDuplicates(["_row"]).select(*names)


def _row() -> Column:
    """A 128-bit digest of doc_id and text; a null text counts as empty."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit("")))))


def classes(docs: DataFrame, chunk: int = CHUNK, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """For each row ``doc_id``, ``row`` (a digest of doc_id and text), ``key``, ``of`` (the first of its copies), ``first`` (of its class) and ``n_links``."""
    in_small_batches(docs.sparkSession)
    docs = shaped(docs, ["doc_id", "text"]).select("doc_id", _row().alias("row"), F.encode("text", "UTF-8").alias("bytes"))
    full = staged(signatures(docs), "signatures")
    reps = staged(
        full.where("key IS NOT NULL").groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("weight"), F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("of"),
            F.min("sig").alias("sig"), F.min("bands").alias("bands"), F.min("size").alias("size"),
        ),
        "representatives",
    )
    signed = staged(full.select("doc_id", "row", "key"), "members")
    dropped(full)

    spread = reps.select("key", "size", F.posexplode("bands").alias("band", "bucket"))
    crowded = spread.groupBy("band", "bucket").agg(
        F.count(F.lit(1)).alias("members"), F.sum("size").alias("volume"),
        *[F.bit_xor(F.xxhash64(F.lit(i), "key")).alias(f"d{i}") for i in (1, 2)],
    ).where("members > 1")
    apart = crowded.groupBy("members", "d1", "d2").agg(F.min(F.struct("band", "bucket", "volume")).alias("of")).select("of.band", "of.bucket", "of.volume", "members")
    n = F.ceil(F.col("members") / F.lit(chunk)).cast("int")
    cuts = F.greatest(F.ceil(F.col("volume") * 8 / F.lit(group_bytes)), F.ceil(F.col("members") / F.lit(GROUP_MEMBERS))).cast("int")
    met = (
        spread.join(apart, ["band", "bucket"]).select("key", "band", "bucket", cuts.alias("cuts"), n.alias("n"), F.pmod(F.xxhash64("key"), n).cast("int").alias("own"))
        .select("key", "band", "bucket", "cuts", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
        .select("bucket", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "band", (F.col("own") > F.col("other")).cast("int").alias("side"), "key", "cuts")
    )
    group = ["bucket", "c1", "c2", "band"]
    kept = staged(
        met.join(reps.select("key", "sig"), "key").select(*group, "side", "key", "sig", "cuts")
        .repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(_prune, "key binary, bucket bigint, c1 int, c2 int, band int, side int, sig binary"),
        "paired",
    )

    needed = kept.select("key").distinct().join(reps.select("key", "weight", "of"), "key")
    few = needed.select("key", "weight", F.col("of.row").alias("row")).hint("shuffle_hash")  # texts stream past, unsorted
    found = docs.select("row", "bytes").join(few, "row")
    sets = shingle_sets(found.select("key", "weight", "bytes"))
    verified = staged(
        kept.join(sets, "key").select(*group, "side", "key", "sig", "weight", "set")
        .repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(_verify, "key binary, links bigint, least binary"),
        "links",
    )
    dropped(kept)
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(verified.select(F.col("key").alias("a"), F.col("least").alias("b")))
    named = reps.select("key", "weight", "of").join(links, "key", "left").join(roots, "key", "left")
    named = named.withColumn("root", F.coalesce("root", "key"))
    firsts = named.groupBy("root").agg(F.min("of").alias("first"))
    told = staged(
        named.join(firsts, "root").select("key", "of", "first", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classes"
    )
    dropped(reps)
    dropped(verified)
    return signed.join(told, "key", "left")
