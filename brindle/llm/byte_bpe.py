"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each pre-token is a linked list of byte pieces. A pair that can merge waits in
the bucket of its rank, as the position of its left piece (the leftmost comes
first); a bitmap of words of 64 ranks, under a bitmap of the words in use, says
which buckets have entries, and find-first-set on the two gives the least rank
(the upper one, some 800 bits for 50,000 ranks, is one integer). Entries whose piece has gone or whose pair has changed are
stale and skipped when they come up. A pre-token of n bytes costs O(n log n),
however long it is, where rescanning the list would cost O(n^2).

Ids of pre-tokens are kept per worker, packed, in two generations of at most
``KEPT_BYTES`` each; every miss goes through the queue. Rows stay where they are:
no shuffle, and what a worker holds is the vocabulary, those tables and one slice
of texts.

Defined results: a null or empty text has no ids and decodes to no bytes. Texts
are whole; no special tokens; repeated rows are all encoded; an empty table
gives an empty result. Rank files must
hold all 256 single bytes. ``decode`` gives null for null ids.
"""

from __future__ import annotations

from array import array
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from brindle.llm.common import appended, held, shaped
from brindle.llm.pretokens import Splitter, read_ranks

#: Bytes of a generation of kept pre-tokens, what an entry takes beside its own length, and characters of the longest kept.
KEPT_BYTES, ENTRY_BYTES, KEPT_LENGTH = 40 << 20, 150, 40


class Codec:
    """Encoder and decoder for one rank file and one pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        most = max(ranks.values())
        self.pieces: list[bytes | None] = [None] * (most + 1)
        for b, i in ranks.items():
            self.pieces[i] = b
        self.words = [0] * (most // 64 + 1)  # all zero between pre-tokens
        self.packed = np.dtype(np.uint16 if most < 1 << 16 else np.uint32)
        self.split = Splitter(pattern).split
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        get, words, n = self.ranks.get, self.words, len(piece)
        right = list(range(1, n + 1))  # the end of the piece that begins here
        left = list(range(-1, n))  # the beginning of the piece before
        rank = [-1] * (n + 1)  # of the pair that begins here, -1: none or gone
        buckets: dict[int, list[int]] = {}
        upper = 0
        for i in range(n - 1):
            r = get(piece[i : i + 2])
            if r is not None:
                rank[i] = r
                if r in buckets:
                    buckets[r].append(i)  # ascending, so a heap
                else:
                    buckets[r] = [i]
                    w = r >> 6
                    words[w] |= 1 << (r & 63)
                    upper |= 1 << w
        while upper:
            w = (upper & -upper).bit_length() - 1
            word = words[w]
            r = (w << 6) + (word & -word).bit_length() - 1
            bucket = buckets[r]
            if len(bucket) == 1:
                i = bucket[0]
                del buckets[r]
                word &= word - 1
                words[w] = word
                if not word:
                    upper &= upper - 1
            else:
                i = heappop(bucket)
            if rank[i] != r:
                continue  # stale
            j = right[i]
            end = right[i] = right[j]
            rank[j] = rank[i] = -1
            if end < n:
                left[end] = i
                r = get(piece[i : right[end]])
                if r is not None:
                    rank[i] = r
                    if r in buckets:
                        heappush(buckets[r], i)
                    else:
                        buckets[r] = [i]
                        w = r >> 6
                        words[w] |= 1 << (r & 63)
                        upper |= 1 << w
            h = left[i]
            if h >= 0:
                r = get(piece[h:end])
                if r is None:
                    rank[h] = -1
                elif rank[h] != r:
                    rank[h] = r
                    if r in buckets:
                        heappush(buckets[r], h)
                    else:
                        buckets[r] = [h]
                        w = r >> 6
                        words[w] |= 1 << (r & 63)
                        upper |= 1 << w
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : right[i]]])
            i = right[i]
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_packed(text), self.packed)

    def encode_packed(self, text: str | None) -> bytes:
        """The ids as unsigned numbers of the type ``packed``, one after another."""
        tokens = self.split(text) if text else []
        known = self.known
        try:
            return b"".join(map(known.__getitem__, tokens))
        except KeyError:
            if self.held > KEPT_BYTES:  # what is still in use comes back from the older half
                self.older, self.known, self.held = known, {}, 0
                known = self.known
            return b"".join([known.get(t) or self._learn(t) for t in tokens])

    def _learn(self, token: str) -> bytes:
        ids = self.older.get(token) or array(self.packed.char, self.merge(token.encode("utf-8"))).tobytes()
        if len(token) <= KEPT_LENGTH:
            self.known[token] = ids
            self.held += ENTRY_BYTES + len(token) + len(ids)
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker: it holds the vocabulary and the tables of kept pre-tokens."""
    return held(("bpe", path, pattern), lambda: Codec(read_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``ids``, the token ids of the column ``text``."""

    def batch(column: pa.Array) -> list[pa.Array]:
        c = codec(path, pattern)
        return [_lists([c.encode_packed(t) for t in column.to_pylist()], c.packed)]

    return appended(shaped(docs, [text], ["ids"]), {"ids": "array<int>"}, batch, text, holds=True)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``docs`` plus ``decoded``, the bytes of the ids; null for null ids."""

    def batch(column: pa.Array) -> list[list]:
        c = codec(path, pattern)
        return [[None if x is None else c.decode(x) for x in column.to_pylist()]]

    return appended(shaped(docs, [ids], ["decoded"]), {"decoded": "binary"}, batch, ids, holds=True)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``ids`` and ``decoded``, the bytes that those ids stand for, in one pass."""

    def batch(column: pa.Array) -> list:
        c = codec(path, pattern)
        ids = [c.encode_packed(t) for t in column.to_pylist()]
        return [_lists(ids, c.packed), [c.decode(np.frombuffer(x, c.packed).tolist()) for x in ids]]

    return appended(shaped(docs, [text], ["ids", "decoded"]), {"ids": "array<int>", "decoded": "binary"}, batch, text, holds=True)


def _lists(ids: list[bytes], packed: np.dtype) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]) // packed.itemsize
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), packed).astype(np.int32)))


def digests(df: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of a round trip."""
    return df.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
