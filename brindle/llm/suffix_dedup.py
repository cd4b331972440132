"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts earlier: in a document
of smaller doc_id, or before in the same one. Strings are judged on the input, overlaps count, and
matches never cross documents.

1. Every window of ``LENGTH`` bytes has an anchor: the leftmost of its grams of ``GRAM`` bytes with
   the least polynomial hash. Equal windows have equal anchors at equal offsets, and consecutive
   windows with one anchor make one row: the gram's hash, a keyed 64-bit digest of the bytes that
   the windows cover together (the context), and the place. That is a row for some 40 bytes.
2. Tasks fold rows of equal gram and context, so that a passage that a third of all documents hold
   costs a row per ``FOLD`` rows; all but the first occurrence are repeats as a whole. The rest meets
   by gram. What meets no other row goes; equal contexts fold again; grams with several contexts
   have these cut from the texts.
3. Contexts of a gram are suffix-sorted from the gram to the right, and from the gram to the left in
   the reversed bytes, by a mergesort of all grams at once. Two suffixes are compared by their longest
   common extension, found by binary search over prefix polynomial hashes, so in logarithmic time.
   Neighbours of the sorted order are then verified byte by byte, which proves it; a collision has
   its rows sorted by their bytes instead.
4. Neighbours' extensions cut each order into classes of equal suffixes. Windows at one offset from
   a gram are equal if both their classes are; all but the first of them are repeats.
5. Repeats are gathered by document, where covered bytes are removed.

Rows of a gram with over ``limit`` rows (a gram that is common with ever other surroundings) are left
to a plainer exact way: their windows meet by 128-bit digests, of which the least place is kept by a
partial aggregate, so that no task holds such a group. Texts move twice (for contexts, for results),
places otherwise.

Defined results: a null text counts as empty and nothing of it goes, as of all texts under ``LENGTH``
bytes; very long texts are cut into overlapping slabs. doc_id must be an integer column; a null one
comes after all others. Documents of one doc_id but different texts are ordered by a hash of the text;
rows equal in doc_id and text are one document and all get its result. An empty table gives an empty
result. Columns of the input that are named like a result are left out.
"""

from __future__ import annotations

import gc
import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import IntegralType

from brindle.llm.common import appended, dropped, in_small_batches, let_go, shaped, staged

LENGTH, GRAM = 100, 24
#: Bytes that are hashed at once; positions in a slab take ``_POS`` bits.
_POS = 20
SLAB = (1 << _POS) - LENGTH
#: Rows that a task folds at once, that one gram may have, and that are sorted at once.
FOLD, LIMIT, ROWS = 1 << 20, 1 << 15, 1 << 15

MADE = {"n_bytes": "bigint", "n_removed": "bigint", "removed": "array<struct<start:bigint,end:bigint>>", "kept": "binary"}

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LAST = (1 << 63) - 1
_PLACE = ("did", "th", "lo", "off", "n")
_ROW = pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("did", pa.int64()), ("th", pa.int32()), ("lo", pa.int32()), ("off", pa.int32()), ("n", pa.int32())])
_MARK = pa.schema([("kind", pa.int32()), ("gram", pa.int64()), *[(c, _ROW.field(c).type) for c in _PLACE]])
_REPEAT = pa.schema([(c, _ROW.field(c).type) for c in ("did", "th", "lo", "n")])
REPEAT, CONTEXT, WINDOWS = 0, 1, 2

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n - 1), modulo 2^64."""
    if len(_powers.get(base, ())) < n:
        row = np.full(1 << (n - 1).bit_length(), base, np.uint64)
        row[0] = 1
        _powers[base] = np.cumprod(row, dtype=np.uint64)
    return _powers[base][:n]


class Hashes:
    """Prefix polynomial hashes of a byte array, modulo 2^64."""

    def __init__(self, data: np.ndarray):
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data) or 1)[: len(data)], out=self.prefix[1:])
        self.inverse = _power(_INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def grams(self, width: int) -> np.ndarray:
        """The mixed hash of every ``width`` bytes."""
        h = (self.prefix[width:] - self.prefix[:-width]) * self.inverse[: len(self.prefix) - width]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minima of all ``width`` consecutive keys."""
    most = np.full((-len(keys)) % width, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([keys, most]).reshape(-1, width)
    head = np.minimum.accumulate(blocks, 1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    n = len(keys) - width + 1
    return np.minimum(tail[:n], head[width - 1 : width - 1 + n])


def anchored(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """For the windows of ``pieces``, by runs of one anchor: piece, first window, windows, anchor less first window, gram's hash."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes) - sizes
    mask = np.uint64((1 << _POS) - 1)
    grams = Hashes(data).grams(GRAM)
    found = (_least(grams & ~mask | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1) & mask).astype(np.int64)
    windows = np.maximum(sizes - LENGTH + 1, 0)
    at = np.arange(windows.sum()) + np.repeat(starts - (np.cumsum(windows) - windows), windows)
    piece = np.repeat(np.arange(len(pieces)), windows)
    anchor = found[at]
    fresh = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])])) if len(at) else np.empty(0, np.int64)
    first, owner = at[fresh], piece[fresh]
    n = np.diff(np.append(fresh, len(at)))
    return owner, first - starts[owner], n, anchor[fresh] - first, grams[anchor[fresh]].view(np.int64)


def _slabs(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text, offset, piece) of about ``SLAB`` bytes; pieces of one text overlap, so that each window is in one."""
    group, held = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, SLAB - LENGTH + 1):
            piece = text[at : at + SLAB]
            if held + len(piece) > SLAB:
                yield group
                group, held = [], 0
            group.append((i, at, piece))
            held += len(piece)
    if group:
        yield group


def occurrences(dids: np.ndarray, ths: np.ndarray, texts: list[bytes], key: bytes) -> Iterator[dict[str, np.ndarray]]:
    """Columns of ``_ROW`` for the windows of ``texts``."""
    digest = hashlib.blake2b
    for group in _slabs(texts):
        owner, lo, n, off, gram = anchored([p for _, _, p in group])
        ends = lo + n + (LENGTH - 1)
        context = b"".join([digest(group[o][2][a:b], digest_size=8, key=key).digest() for o, a, b in zip(owner.tolist(), lo.tolist(), ends.tolist(), strict=True)])
        text = np.array([i for i, _, _ in group])[owner]
        yield {
            "gram": gram, "context": np.frombuffer(context, np.int64), "did": dids[text], "th": ths[text],
            "lo": (lo + np.array([at for _, at, _ in group])[owner]).astype(np.int32), "off": off.astype(np.int32), "n": n.astype(np.int32),
        }


Columns = dict[str, np.ndarray]


def _joined(parts: list[Columns]) -> Columns:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _some(rows: Columns, at: np.ndarray) -> Columns:
    return {k: v[at] for k, v in rows.items()}


def _same_as_before(rows: Columns, *names: str) -> np.ndarray:
    """Whether each row has the values of the row before."""
    n = len(rows[names[0]])
    out = np.ones(n, bool)
    out[:1] = False
    for c in names:
        out[1:] &= rows[c][1:] == rows[c][:-1]
    return out


def folded(rows: Columns) -> tuple[Columns, Columns]:
    """First occurrences of each gram and context, sorted by these, and the repeats, as runs of windows of a document."""
    rows = _some(rows, np.lexsort((rows["lo"], rows["th"], rows["did"], rows["context"], rows["gram"])))
    same = _same_as_before(rows, "gram", "context")
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    own = np.ones(len(same), bool)
    for c in ("did", "th", "lo"):
        own &= rows[c] == rows[c][first]  # a repeated row is the same occurrence
    return _some(rows, np.flatnonzero(~same)), merged(_some({c: rows[c] for c in ("did", "th", "lo", "n")}, np.flatnonzero(same & ~own)))


def merged(repeats: Columns) -> Columns:
    """Runs of windows that touch, joined."""
    rows = _some(repeats, np.lexsort((repeats["lo"], repeats["th"], repeats["did"])))
    end = rows["lo"].astype(np.int64) + rows["n"]
    same = _same_as_before(rows, "did", "th")
    # Within a document the rows of one stage do not nest, so the end before is the furthest.
    touching = same.copy()
    touching[1:] &= rows["lo"][1:] <= end[:-1]
    first = np.flatnonzero(~touching)
    last = np.append(first[1:], len(touching)) - 1 if len(first) else first
    out = _some(rows, first)
    out["n"] = (end[last] - rows["lo"][first]).astype(np.int32)
    return out


def _table(rows: Columns, schema: pa.Schema) -> pa.RecordBatch:
    n = len(next(iter(rows.values())))
    return pa.RecordBatch.from_arrays([pa.array(rows.get(f.name, np.zeros(n, np.int32))).cast(f.type) for f in schema], schema=schema)


def _found(rows: Columns) -> Columns:
    """Repeats as rows of ``_ROW``: dealt out by document, told by ``off`` -1."""
    n = len(rows["lo"])
    return rows | {"gram": (rows["did"].view(np.uint64) * np.uint64(_BASE)).view(np.int64), "context": np.zeros(n, np.int64), "off": np.full(n, -1, np.int32)}


def _occurrences(docs: DataFrame, key: bytes, fold: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: list[Columns] = []

        def out() -> Iterator[pa.RecordBatch]:
            first, repeats = folded(_joined(held))
            for rows in (first, _found(repeats)):
                if len(rows["lo"]):
                    yield _table(rows, _ROW)
            held.clear()

        for batch in batches:
            dids, ths = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for rows in occurrences(dids, ths, batch.column(2).to_pylist(), key):
                held.append(rows)
                if sum(len(h["lo"]) for h in held) >= fold:
                    yield from out()
        if held:
            yield from out()

    return docs.mapInArrow(run, "gram bigint, context bigint, did bigint, th int, lo int, off int, n int")


def _columns(batch: pa.RecordBatch, names: tuple[str, ...] | list[str]) -> Columns:
    return {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names}


def marked(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by gram: repeats, contexts that must be compared, and windows of grams with over ``limit`` rows."""
    let_go()
    held: list[Columns] = []
    count, hot = 0, None

    def mark(rows: Columns, kind: int) -> pa.RecordBatch:
        return _table(rows | {"kind": np.full(len(rows["lo"]), kind, np.int32)}, _MARK)

    def judged(rows: Columns) -> Iterator[pa.RecordBatch]:
        first, repeats = folded(rows)
        if len(repeats["lo"]):
            yield mark(repeats, REPEAT)
        more = _same_as_before(first, "gram")
        more[:-1] |= more[1:]
        if more.any():
            yield mark(_some(first, np.flatnonzero(more)), CONTEXT)

    for batch in batches:
        rows = _columns(batch, _ROW.names)
        gone = rows["off"] < 0
        if gone.any():
            yield mark(_some(rows, np.flatnonzero(gone)), REPEAT)
        over = ~gone & (rows["gram"] == hot) if hot is not None else np.zeros(len(gone), bool)
        if over.any():
            yield mark(_some(rows, np.flatnonzero(over)), WINDOWS)
        rows = _some(rows, np.flatnonzero(~gone & ~over))
        if not len(rows["lo"]):
            continue
        held.append(rows)
        count += len(rows["lo"])
        if rows["gram"][0] == rows["gram"][-1] and len(held) > 1 and held[-2]["gram"][-1] == rows["gram"][0] and count <= limit:
            continue  # the same gram goes on
        every = _joined(held)
        last = int(np.argmax(every["gram"] == every["gram"][-1]))
        if last:
            yield from judged(_some(every, np.arange(last)))
        held = [_some(every, np.arange(last, len(every["lo"])))]
        count = len(held[0]["lo"])
        if count > limit:
            hot = held[0]["gram"][0]
            yield mark(held[0], WINDOWS)
            held, count = [], 0
    if held:
        yield from judged(_joined(held))


# ---- suffix sort ----


class Suffixes:
    """Suffixes (start, length) of ``data``, compared within equal ``group`` numbers, which are contiguous."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray):
        self.data, self.start, self.length, self.group = data, start, length, group
        self.hashes = Hashes(data)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common extensions of suffixes i and j, by hashes."""
        a, b = self.start[i], self.start[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.length[i], self.length[j])
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.hashes.of(a, middle) == self.hashes.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
        return low

    def compared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Negative where suffix i comes before j, 0 where they are equal; a prefix comes first."""
        n = self.extension(i, j)
        return self._next(i, n) - self._next(j, n)

    def _next(self, i: np.ndarray, n: np.ndarray) -> np.ndarray:
        inside = n < self.length[i]
        return np.where(inside, self.data[np.where(inside, self.start[i] + n, 0)].astype(np.int64), -1)

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """The order of suffixes by group, and each one's extension with the one before it in the order (-1: another group)."""
        n = len(self.start)
        begin = np.concatenate([[True], self.group[1:] != self.group[:-1]])
        size = np.diff(np.append(np.flatnonzero(begin), n))
        first, end = np.repeat(np.flatnonzero(begin), size), np.repeat(np.flatnonzero(begin) + size, size)
        order = np.arange(n)
        width = 1
        while len(slot := np.flatnonzero(end - first > width)):
            run, within = np.divmod(slot - first[slot], width)
            odd = run & 1
            base = first[slot] + (run ^ 1) * width
            low, high = np.minimum(base, end[slot]), np.minimum(base + width, end[slot])
            while len(open_ := np.flatnonzero(low < high)):
                middle = (low[open_] + high[open_]) >> 1
                c = self.compared(order[middle], order[slot[open_]])
                after = (c < 0) | (c == 0) & (odd[open_] == 1)
                low[open_], high[open_] = np.where(after, middle + 1, low[open_]), np.where(after, high[open_], middle)
            new = order.copy()
            new[first[slot] + (run - odd) * width + within + low - np.minimum(base, end[slot])] = order[slot]
            order = new
            width *= 2
        extension = np.full(n, -1, np.int64)
        inner = np.flatnonzero(~begin)
        extension[inner] = self.extension(order[inner - 1], order[inner])
        if not self.verified(order, extension, inner):
            return self.sorted_by_bytes()
        return order, extension

    def verified(self, order: np.ndarray, extension: np.ndarray, inner: np.ndarray) -> bool:
        """Whether neighbours have the bytes of their extensions in common and then ascend; if so, the whole order is right."""
        i, j, n = order[inner - 1], order[inner], extension[inner]
        for k in range(int(n.max(initial=0))):
            at = np.flatnonzero(n > k)
            if (self.data[self.start[i[at]] + k] != self.data[self.start[j[at]] + k]).any():
                return False
        a, b = self._next(i, n), self._next(j, n)
        return bool(((a < b) | (a == -1) & (b == -1)).all())

    def sorted_by_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """What ``sorted`` returns, without hashes: for rows among which hashes collide."""
        suffix = [self.data[s : s + n].tobytes() for s, n in zip(self.start.tolist(), self.length.tolist(), strict=True)]
        order = sorted(range(len(suffix)), key=lambda i: (int(self.group[i]), suffix[i]))
        extension = []
        for before, i in zip([-1, *order[:-1]], order, strict=True):
            if before < 0 or self.group[before] != self.group[i]:
                extension.append(-1)
                continue
            a, b = suffix[before], suffix[i]
            extension.append(next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b))))
        return np.array(order, np.int64), np.array(extension, np.int64)


def _classes(order: np.ndarray, extension: np.ndarray, need: int) -> np.ndarray:
    """For each suffix the place of the first one in the order with which it shares ``need`` bytes."""
    at = np.arange(len(order))
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum.accumulate(np.where(extension < need, at, 0))
    return out


def repeated_windows(rows: Columns, contexts: list[bytes]) -> Columns:
    """Of rows sorted by (gram, did, th, lo) with their contexts, the windows that an earlier row of the gram has too."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    size = np.array([len(c) for c in contexts], np.int64)
    start = np.cumsum(size) - size
    off, n = rows["off"].astype(np.int64), rows["n"].astype(np.int64)
    anchor = start + off
    right = Suffixes(data, anchor, size - off, rows["gram"]).sorted()
    left = Suffixes(data[::-1], len(data) - anchor, off, rows["gram"]).sorted()
    gone = np.zeros((len(off), LENGTH - GRAM + 3), bool)  # a false column on either side
    for before in range(LENGTH - GRAM + 1):
        at = np.flatnonzero((off - n < before) & (before <= off))
        if len(at) < 2:
            continue
        both = _classes(*right, LENGTH - before)[at] * len(off) + _classes(*left, before)[at]
        _, first, inverse = np.unique(both, return_index=True, return_inverse=True)
        first = at[first][inverse]
        later = np.zeros(len(at), bool)
        for c in ("did", "th", "lo"):
            later |= rows[c][first] != rows[c][at]
        gone[at[later], off[at[later]] - before + 1] = True
    edge = np.diff(gone.astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return {"did": rows["did"][row], "th": rows["th"][row], "lo": (rows["lo"][row] + begin).astype(np.int32), "n": (end - begin).astype(np.int32)}


def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among rows and contexts, sorted by gram."""
    let_go()
    held, contexts, count = [], [], 0

    def out(rows: Columns, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((rows["lo"], rows["th"], rows["did"], rows["gram"]))
        found = repeated_windows(_some(rows, order), [texts[i] for i in order.tolist()])
        if len(found["lo"]):
            yield _table(merged(found), _REPEAT)

    for batch in batches:
        rows = _columns(batch, ("gram", *_PLACE))
        held.append(rows)
        contexts += batch.column(batch.schema.get_field_index("bytes")).to_pylist()
        count += len(rows["lo"])
        if count > ROWS and held[0]["gram"][0] != rows["gram"][-1]:
            every = _joined(held)
            last = int(np.argmax(every["gram"] == every["gram"][-1]))
            yield from out(_some(every, np.arange(last)), contexts[:last])
            held, contexts, count = [_some(every, np.arange(last, count))], contexts[last:], count - last
    if held:
        yield from out(_joined(held), contexts)


def _cut(found: DataFrame, schema: str, make) -> DataFrame:
    """Rows that ``make`` (did, th, text, place) gives for each place of documents with a list of ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            for did, th, text, places in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows = [row for p in places for row in make(did, th, text, p)]
                for i in range(0, len(rows), 1 << 14):
                    columns = [pa.array(c, kinds[k]) for k, c in enumerate(zip(*rows[i : i + (1 << 14)], strict=True))]
                    yield pa.RecordBatch.from_arrays(columns, names=["gram", "did", "th", "lo", "off", "n", "bytes"])

    return found.mapInArrow(run, schema)


_CONTEXTS = "gram bigint, did bigint, th int, lo int, off int, n int, bytes binary"


def _context(did: int, th: int, text: bytes, p: dict) -> Iterator[tuple]:
    yield p["gram"], did, th, p["lo"], p["off"], p["n"], text[p["lo"] : p["lo"] + p["n"] + LENGTH - 1]


def _windows(did: int, th: int, text: bytes, p: dict) -> Iterator[tuple]:
    for s in range(p["lo"], p["lo"] + p["n"]):
        yield 0, did, th, s, 0, 1, hashlib.blake2b(text[s : s + LENGTH], digest_size=16).digest()


def _places(docs: DataFrame, marks: DataFrame, kind: int) -> DataFrame:
    places = marks.where(F.col("kind") == kind).groupBy("did", "th").agg(F.collect_list(F.struct("gram", "lo", "off", "n")).alias("places"))
    return docs.join(places.hint("shuffle_hash"), ["did", "th"])  # texts stream past, unsorted


def _free(df: DataFrame) -> None:
    """Lets Spark delete shuffle files of results that are staged; it does so as the driver's objects are collected."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def repeats(docs: DataFrame, limit: int = LIMIT, fold: int = FOLD) -> DataFrame:
    """(did, th, lo, n): runs of windows of ``docs`` (did, th, bytes) that also start earlier."""
    key = secrets.token_bytes(16)
    rows = _occurrences(docs, key, fold).repartition("gram").sortWithinPartitions("gram")
    marks = staged(rows.mapInArrow(lambda b: marked(b, limit), "kind int, gram bigint, did bigint, th int, lo int, off int, n int"), "marks")
    del rows
    _free(marks)
    contexts = _cut(_places(docs, marks, CONTEXT), _CONTEXTS, _context).repartition("gram").sortWithinPartitions("gram")
    found = staged(contexts.mapInArrow(resolved, "did bigint, th int, lo int, n int"), "repeats")
    del contexts
    out = marks.where(F.col("kind") == REPEAT).select("did", "th", "lo", "n").union(found)
    if not marks.where(F.col("kind") == WINDOWS).isEmpty():
        windows = staged(_cut(_places(docs, marks, WINDOWS), _CONTEXTS, _windows).select("bytes", "did", "th", "lo", "n"), "windows")
        first = staged(windows.groupBy("bytes").agg(F.min(F.struct("did", "th", "lo")).alias("first")), "first-windows")  # with no aggregate beside it, the join can be split
        met = windows.join(first, "bytes").where(F.struct("did", "th", "lo") != F.col("first"))
        out = out.union(met.select("did", "th", "lo", "n"))
    _free(marks)
    return out


def _key() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("did"), F.shiftright(F.xxhash64(text), 32).cast("int").alias("th")]


def covered(n_bytes: int, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal (start, end) of the bytes that windows starting at ``runs`` (first, count) cover."""
    out: list[tuple[int, int]] = []
    for lo, n in sorted(runs):
        end = lo + n - 1 + LENGTH
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((lo, end))
    return out


def deduplicated(docs: DataFrame, limit: int = LIMIT, fold: int = FOLD) -> DataFrame:
    """``docs`` with the columns of ``MADE``: lengths, removed spans of bytes (end exclusive) and the bytes that stay."""
    in_small_batches(docs.sparkSession)
    docs = shaped(docs, ["doc_id", "text"], [*MADE, "did", "th", "_in"])
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise ValueError("doc_id must be an integer column")
    keyed = docs.select(*_key(), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"))
    runs = repeats(keyed, limit, fold).groupBy("did", "th").agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
    met = docs.select("*", *_key()).join(runs.hint("shuffle_hash"), ["did", "th"], "left")
    met = met.withColumn("_in", F.struct(F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"), "runs"))

    def batch(column: pa.Array) -> list:
        rows = []
        for r in column.to_pylist():
            data, spans = r["bytes"], covered(len(r["bytes"]), [(x["lo"], x["n"]) for x in r["runs"] or ()])
            at = [0, *[x for s in spans for x in s], len(data)]
            kept = b"".join(data[a:b] for a, b in zip(at[::2], at[1::2], strict=True))
            rows.append((len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in spans], kept))
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in MADE]

    names = docs.columns
    out = appended(met.select(*names, "_in"), MADE, batch, "_in")
    return out.select(*names, *MADE)
