"""Product-quantised codes of vectors, by Lloyd rounds over heaps of slack.

Vectors become integers floor(1024 * x) and are cut into ``PARTS`` equal parts, each with a codebook
that starts as the parts of the ``ENTRIES`` least vec_ids. Each of ``ROUNDS`` rounds assigns every
part to its nearest entry (squared Euclidean distance, ties to the lower index) and moves entries to
floor(sum / count) of their parts; unused ones stay. A last assignment gives codes and errors.

Vectors are packed into rows of blocks, once; a block is a row of the staged table of each round and
holds its own heaps, so every round is one pass without a shuffle and a lost task is read again.

* For each part position and entry a block keeps a heap of its parts, keyed by lower minus upper: the
  distance to the second nearest entry less that to the nearest, plus the drift the entry had then.
* When entries have moved, an entry's cumulative drift grows by its own move and the largest move of
  any other. While the least key of a heap is not above it, the part is popped; only popped parts are
  compared with all entries again, exactly, and pushed on the heap of the nearest. Heaps whose top is
  safe are not looked into.
* A block reports sums and counts as changes against its last assignment. They are added up within
  tasks and then by entry; the driver gets one codebook (``ENTRIES`` * length numbers).

Distances are integers: by products of doubles while all terms stay under 2^53, by 64-bit integers
under 2^63 and by Python's integers beyond. Keys are doubles, so heaps are popped by a margin over
their rounding; a part popped needlessly gets the same entry again.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped.
Vectors of another length than that of the least vec_id whose length is a positive multiple of
``PARTS``, or whose 1024-fold is beyond a double, are kept with null ``code`` and ``error``. Rows equal in vec_id stand
once in the first codebook, with the least vector; a null vec_id comes after all others. With fewer
vec_ids the codebook has fewer entries. Repeated rows are all returned; an error beyond 64 bits is
null, as is a sum. Empty tables give no rows. Other columns are not looked at; without ``label``,
labels are null.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from brindle.llm.common import dropped, in_small_batches, let_go, shaped, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Bytes of vectors as doubles in one block, and of distances that are held at once.
BLOCK_BYTES, SCAN_BYTES = 2 << 20, 8 << 20
#: Key margin relative to the sizes that enter it, and of roots of integers beyond a double.
MARGIN = 1e-9


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as whole doubles, which is exact."""
    return np.floor(values.astype(np.float64) * SCALE)


def _whole(x: np.ndarray, bound: float) -> np.ndarray:
    """``x`` in a type whose sums of 4 * length terms up to the squared bound are exact."""
    room = 4.0 * (x.shape[-1] + 1) * (bound + 1.0) ** 2
    if room < 2**53:
        return x.astype(np.float64)
    if room < 2**63:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every part to every entry."""
    bound = max(float(np.abs(parts).max(initial=0)), float(np.abs(entries).max(initial=0)))
    a, b = _whole(parts, bound), _whole(entries, bound)
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]


def _roots(squares: np.ndarray) -> np.ndarray:
    if squares.dtype == object:
        return np.array([float(math.isqrt(v)) for v in squares.ravel().tolist()]).reshape(squares.shape)
    return np.sqrt(squares.astype(np.float64))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of each part (the first of ties), the slack to the second and the squared distance."""
    found, slack, best = [], [], []
    step = max(1, SCAN_BYTES // (8 * len(entries)))
    for i in range(0, len(parts), step):
        d = distances(parts[i : i + step], entries)
        k = d.argmin(1)
        least = d[np.arange(len(d)), k]
        if len(entries) > 1:
            d[np.arange(len(d)), k] = d.max()
            slack.append(_roots(d.min(1)) - _roots(least))
        else:
            slack.append(np.full(len(d), np.inf))
        found.append(k)
        best.append(least)
    return np.concatenate(found), np.concatenate(slack), np.concatenate(best)


class Heaps:
    """The heaps of one block and part position, with each part's present entry.

    A heap is two arrays in heap order, keys and parts; it becomes a list only while something is popped or pushed.
    """

    def __init__(self, parts: np.ndarray, entries: np.ndarray):
        self.entry, slack, _ = nearest(parts, entries)
        self.drift = np.zeros(len(entries))
        self.heaps = []
        order = np.lexsort((slack, self.entry))  # ascending keys are a heap
        for rows in np.split(order, np.searchsorted(self.entry[order], np.arange(1, len(entries)))):
            self.heaps.append((slack[rows], rows.astype(np.int32)))
        self.rescanned = len(parts)

    def moved(self, parts: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        """Entries have moved from ``old`` to ``new``: rescans the parts whose bounds no longer hold."""
        moves = _roots(_squares(old, new))
        top = np.argsort(moves)[-2:]
        others = np.full(len(moves), moves[top[-1]])
        others[top[-1]] = moves[top[0]] if len(moves) > 1 else 0.0
        self.drift += moves + others
        size = sum(float(np.abs(x).max(initial=0)) for x in (parts, old, new))
        margin = MARGIN * (1 + size) * math.sqrt(parts.shape[1]) + (16 if size > 1 << 26 else 0)
        opened: dict[int, list[tuple[float, int]]] = {}

        def listed(k: int) -> list[tuple[float, int]]:
            if k not in opened:
                opened[k] = list(zip(*(x.tolist() for x in self.heaps[k]), strict=True))
            return opened[k]

        popped = []
        for k, bar in enumerate((self.drift * (1 + MARGIN) + margin).tolist()):
            if len(self.heaps[k][0]) and self.heaps[k][0][0] <= bar:
                heap = listed(k)
                while heap and heap[0][0] <= bar:
                    popped.append(heapq.heappop(heap)[1])
        self.rescanned = len(popped)
        if popped:
            found, slack, _ = nearest(parts[popped], new)
            self.entry[popped] = found
            for i, k, key in zip(popped, found.tolist(), (slack + self.drift[found]).tolist(), strict=True):
                heapq.heappush(listed(k), (key, i))
        for k, heap in opened.items():
            self.heaps[k] = (np.array([x for x, _ in heap], np.float64), np.array([i for _, i in heap], np.int32))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances row by row."""
    bound = max(float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)))
    d = _whole(a, bound) - _whole(b, bound)
    return (d * d).sum(1)


def _changes(parts: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> dict[int, list[int]]:
    """By entry, what its sum of components and its count (last) have gained."""
    moved = np.arange(len(after)) if before is None else np.flatnonzero(before != after)
    out: dict[int, list[int]] = {}
    for sign, entry in ((1, after), *(() if before is None else ((-1, before),))):
        order = moved[np.argsort(entry[moved], kind="stable")]
        cuts = np.flatnonzero(np.diff(entry[order])) + 1
        for rows in np.split(order, cuts) if len(order) else ():
            whole = _whole(parts[rows], float(np.abs(parts[rows]).max()) * len(rows))
            gain = [sign * int(v) for v in whole.sum(0).tolist()] + [sign * len(rows)]
            k = int(entry[rows[0]])
            out[k] = [a + b for a, b in zip(out[k], gain, strict=True)] if k in out else gain
    return out


def _cut(matrix: np.ndarray, part: int) -> np.ndarray:
    width = matrix.shape[1] // PARTS
    return matrix[:, part * width : (part + 1) * width]


def _packed(vectors: DataFrame, length: int) -> DataFrame:
    """Blocks (``rows``: vec_id and label of each, ``matrix``: whole doubles, float32 where they fit, ``state`` null)."""
    kinds = {n: vectors.schema[n].dataType.simpleString() for n in ("vec_id", "label")}
    size = max(1, BLOCK_BYTES // (8 * length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            for i in range(0, batch.num_rows, size):
                piece = batch.slice(i, size)
                if count + piece.num_rows > size:
                    yield block(held)
                    held, count = [], 0
                held.append(piece)
                count += piece.num_rows
        if held:
            yield block(held)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        every = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        flat = every.column(2).flatten().to_numpy(zero_copy_only=False)
        whole = integers(flat)
        small = whole.astype(np.float32)
        data = (small if np.array_equal(small, whole) else whole).tobytes()
        lists = [pa.ListArray.from_arrays(pa.array([0, every.num_rows], pa.int32()), every.column(i)) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*lists, pa.array([data]), pa.array([None], pa.binary()), pa.array([None], pa.binary())], names=["ids", "labels", "matrix", "state", "changes"])

    return vectors.mapInArrow(run, f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, matrix binary, state binary, changes binary")


def _matrix(data: bytes, n: int, length: int) -> np.ndarray:
    return np.frombuffer(data, np.float32 if len(data) == 4 * n * length else np.float64).reshape(n, length)


def _round(blocks: DataFrame, length: int, old: np.ndarray | None, new: np.ndarray) -> DataFrame:
    """Blocks whose parts are assigned to the entries ``new``, and what that changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                ids, data, state = row.column(0), row.column(2)[0].as_py(), row.column(3)[0].as_py()
                matrix = _matrix(data, len(ids.flatten()), length)
                heaps: list[Heaps] = pickle.loads(state) if state else []
                changes = []
                for p in range(PARTS):
                    parts = _cut(matrix, p).astype(np.float64)
                    if state:
                        before = heaps[p].entry.copy()
                        heaps[p].moved(parts, _cut(old, p), _cut(new, p))
                    else:
                        before = None
                        heaps.append(Heaps(parts, _cut(new, p)))
                    changes.append(_changes(parts, before, heaps[p].entry))
                made = [pa.array([pickle.dumps(x, pickle.HIGHEST_PROTOCOL)], pa.binary()) for x in (heaps, changes)]
                yield pa.RecordBatch.from_arrays([*row.columns[:3], *made], names=batch.schema.names)

    return blocks.mapInArrow(run, blocks.schema)


def _gathered(blocks: DataFrame) -> list[tuple[tuple[int, int], list[int]]]:
    """Sums of the blocks' changes by part and entry, whole integers: a table of ``PARTS`` * ``ENTRIES`` rows at most."""
    add = lambda a, b: [x + y for x, y in zip(a, b, strict=True)]

    def of_task(rows: Iterator) -> Iterator[tuple]:
        total: dict[tuple[int, int], list[int]] = {}
        for (data,) in rows:
            for p, changes in enumerate(pickle.loads(data)):
                for k, gain in changes.items():
                    total[p, k] = add(total[p, k], gain) if (p, k) in total else gain
        yield from total.items()

    return blocks.select("changes").rdd.mapPartitions(of_task).reduceByKey(add).collect()


def _started(vectors: DataFrame) -> np.ndarray:
    """The whole doubles of the ``ENTRIES`` least vec_ids; a task passes that many on at most."""
    kind = vectors.schema["vec_id"].dataType
    arrow = to_arrow_type(kind)
    order = lambda key: (key is None, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict = {}
        bar = None
        for batch in batches:
            for i, key in enumerate(batch.column(0).to_pylist()):
                if bar is None or order(key) <= bar:
                    vector = batch.column(2)[i].as_py()
                    least[key] = min(least.get(key, vector), vector)
                    if len(least) >= 2 * ENTRIES:
                        least = {k: least[k] for k in sorted(least, key=order)[:ENTRIES]}
                        bar = order(max(least, key=order))
        few = sorted(least, key=order)[:ENTRIES]
        if few:
            yield pa.RecordBatch.from_arrays([pa.array(few, arrow), pa.array([least[k] for k in few], pa.list_(pa.float64()))], names=["vec_id", "vector"])

    few = vectors.mapInArrow(run, f"vec_id {kind.simpleString()}, vector array<double>").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = few.orderBy(F.asc_nulls_last("vec_id")).limit(ENTRIES).collect()
    return integers(np.array([r.vector for r in rows]))


def codebooks(blocks: DataFrame, length: int, start: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Blocks after the last assignment and the final entries, of which a part's are a cut of the columns."""
    old, new = None, start
    totals: dict[tuple[int, int], list[int]] = {}
    width = length // PARTS
    for k in range(rounds + 1):
        before, blocks = blocks, staged(_round(blocks, length, old, new), "blocks")
        dropped(before)
        if k == rounds:
            break
        for key, gain in _gathered(blocks):
            totals[key] = [a + b for a, b in zip(totals.get(key, [0] * (width + 1)), gain, strict=True)]
        old, new = new, new.astype(object)
        for (part, entry), (*sums, count) in totals.items():
            if count:
                new[entry, part * width : (part + 1) * width] = [s // count for s in sums]
        if np.abs(new).max() < 1 << 53:
            new = new.astype(np.float64)
    return blocks, new


def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` for every kept row of ``vectors``."""
    in_small_batches(vectors.sparkSession)
    if "label" not in vectors.columns:
        vectors = vectors.withColumn("label", F.lit(None).cast("int"))
    vectors = shaped(vectors, ["vec_id", "label", "embedding"]).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    finite = "vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('Infinity'))"
    kept = vectors.where(finite)
    whole = kept.where(f"size(vector) > 0 AND size(vector) % {PARTS} = 0 AND forall(vector, x -> abs(x) < 1e305)")
    first = whole.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), F.size("vector")).select(F.size("vector").alias("n")).first()
    length = first.n if first else 0
    fits = F.expr(f"size(vector) = {length} AND {length} > 0 AND forall(vector, x -> abs(x) < 1e305)")
    odd = kept.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    if not length:
        coded, digest = odd, hashlib.sha256(b"").hexdigest()
    else:
        fit = kept.where(fits)
        blocks, final = codebooks(staged(_packed(fit, length), "blocks"), length, _started(fit), rounds)
        digest = hashlib.sha256(",".join(str(int(v)) for p in range(PARTS) for entry in _cut(final, p).tolist() for v in entry).encode()).hexdigest()
        coded = staged(_codes(blocks, length, final).unionByName(odd), "codes")
        dropped(blocks)
    sums = coded.groupBy("label").agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _codes(blocks: DataFrame, length: int, final: np.ndarray) -> DataFrame:
    kinds = {n: blocks.schema[n].dataType.elementType.simpleString() for n in ("ids", "labels")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                ids, labels = row.column(0).flatten(), row.column(1).flatten()
                matrix = _matrix(row.column(2)[0].as_py(), len(ids), length)
                heaps = pickle.loads(row.column(3)[0].as_py())
                entry = np.stack([h.entry for h in heaps], 1).astype(np.uint8)
                error = [0] * len(ids)
                for p, h in enumerate(heaps):
                    d = _squares(_cut(matrix, p).astype(np.float64), _cut(final, p)[h.entry])
                    error = [a + int(b) for a, b in zip(error, d.tolist(), strict=True)]
                error = [e if e < 1 << 63 else None for e in error]
                code = [bytes(x).hex() for x in entry]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return blocks.select("ids", "labels", "matrix", "state").mapInArrow(run, f"vec_id {kinds['ids']}, label {kinds['labels']}, code string, error bigint")
