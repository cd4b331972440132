"""Token counts under a unigram model by dynamic programming shared over a trie.

A pre-token's best segmentation has the least sum of piece costs; among equal
sums, the fewest pieces. The forward score of a prefix depends on that prefix
alone, so distinct pre-tokens go into a byte trie whose nodes keep it: a prefix
that pre-tokens share is scored once, and the node where one ends gives its
count, which is stored. Scores are integers, so ties are exact.

A worker keeps its trie over batches, up to ``MAX_NODES`` nodes; then it begins a
new one, which changes no result. Rows stay where they are: no shuffle.

Costs come from a vocabulary in order of rank by Zipf's law, -ln p = ln(rank + 2)
up to a constant, in millionths, or from any table of the caller's.

Defined results: null and empty texts have no tokens; a pre-token that no pieces
cover has none and counts in ``n_unknown``; repeated rows are all counted; very
long texts are counted whole; an empty table gives an empty result; input columns
named like a count are replaced.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame

from brindle.llm.common import appended, held, shaped
from brindle.llm.pretokens import Splitter, read_ranks

#: Nodes of a worker's trie, and pre-tokens of which it keeps the count.
MAX_NODES, KEPT = 700_000, 400_000
#: Bytes of a prefix up to which its score is kept in the trie, and characters of a pre-token whose count is kept.
DEEPEST, KEPT_LENGTH = 1_024, 64
#: Above any number of pieces of a pre-token: a score is cost * PIECE + pieces.
PIECE = 1 << 40

COUNTS = {"n_pretokens": "bigint", "n_tokens": "bigint", "n_unknown": "bigint"}


def zipf_costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Costs in millionths from ranks."""
    return {piece: round(1e6 * math.log(rank + 2)) for piece, rank in ranks.items()}


class Trie:
    """Forward scores of byte prefixes; node 0 is the empty prefix."""

    def __init__(self, costs: dict[bytes, int]):
        self.costs = {p: c * PIECE + 1 for p, c in costs.items() if p}
        self.longest = max(map(len, self.costs), default=0)
        self.clear()

    def clear(self) -> None:
        self.next: dict[int, int] = {}  # node * 256 + byte to node
        self.score: list[int | None] = [0]

    def count(self, token: bytes) -> int:
        """Pieces of the best segmentation, 0 if there is none."""
        step, score, costs, longest = self.next, self.score, self.costs, self.longest
        node, path = 0, [0]  # the scores of the prefixes so far
        for d, byte in enumerate(token, 1):
            key = node << 8 | byte
            node = step.get(key, 0) if d <= DEEPEST else 0
            if not node:
                best = None
                for b in range(max(0, d - longest), d):
                    if (before := path[b]) is not None and (cost := costs.get(token[b:d])) is not None:
                        total = before + cost
                        if best is None or total < best:
                            best = total
                if d > DEEPEST:
                    path.append(best)
                    node = 0
                    continue
                node = step[key] = len(score)
                score.append(best)
            path.append(score[node])
        return 0 if path[-1] is None else path[-1] % PIECE


class Counter:
    """Counts of texts: pre-tokens, tokens and pre-tokens that no pieces cover."""

    def __init__(self, costs: dict[bytes, int], pattern: str):
        self.split = Splitter(pattern).split
        self.trie = Trie(costs)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count(self, text: str | None) -> tuple[int, int, int]:
        tokens = self.split(text) if text else []
        try:
            counts = list(map(self.known.__getitem__, tokens))
        except KeyError:
            if len(self.known) > KEPT:
                self.older, self.known = self.known, {}
            if len(self.trie.score) > MAX_NODES:
                self.trie.clear()
            known = self.known
            counts = [known[t] if t in known else self._learn(t) for t in tokens]
        return len(tokens), sum(counts), counts.count(0)

    def _learn(self, token: str) -> int:
        n = self.older.get(token)
        if n is None:
            n = self.trie.count(token.encode("utf-8"))
        if len(token) <= KEPT_LENGTH:
            self.known[token] = n
        return n


def counter(path: str, pattern: str) -> Counter:
    """One counter per worker: it holds the vocabulary, the trie and the kept counts."""
    return held(("counts", path, pattern), lambda: Counter(zipf_costs(read_ranks(path)), pattern))


def counted(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` plus the columns of COUNTS, for the pieces of the rank file at ``path``."""

    def batch(column: pa.Array) -> list[list[int]]:
        c = counter(path, pattern)
        return [list(x) for x in zip(*[c.count(t) for t in column.to_pylist()], strict=True)] or [[], [], []]

    return appended(shaped(docs, [text], COUNTS), COUNTS, batch, text, holds=True)
