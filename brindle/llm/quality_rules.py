"""Quality rules: learned decision lists over text statistics.

Sequential covering in the manner of RIPPER: conjunctions of thresholds are
grown on two thirds of the labelled rows by FOIL gain, pruned on the last third,
and kept while they are precise.  The list is emitted as ordered Spark
conditional expressions, so judging is one pass without a shuffle.

The labelled sample is bounded by ``MAX_LABELLED`` rows, the smallest by a hash
of doc_id; that bound is a parameter.  Statistics and verdicts cover every
document.

Defined results: a null or empty text has no words and fails the base rule;
labels that are null count as absent; several labels for one doc_id count as
low quality if any says so; an empty or one-sided label table yields an empty
list, which keeps all that pass the base rule; repeated rows are all judged; very
long texts are counted whole; an empty table gives an empty result; input columns
named like a statistic are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from brindle.llm.common import appended, shaped

MAX_LABELLED = 20_000

#: Characters that count as symbols, and white space that parts words. Fixed values.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))

STATISTICS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "n_distinct_words": "bigint",
    "n_lines": "bigint",
    "n_upper": "bigint",
    "n_lower": "bigint",
    "n_marks": "bigint",
}

WINDOW = 8


def repeated_words(ids: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words which occurs twice or more.

    A hash of each window rules out texts without a repeat; where hashes meet,
    windows are ranked exactly by joining ranks of halves.
    """
    n = len(ids) - width + 1
    if n < 2:
        return 0
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(0x100000001B3) + mixed[k : k + n]
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return 0
    rank, have = ids.astype(np.int64), 1
    while have < width:
        step = min(have, width - have)
        a, b = rank[: len(rank) - step], rank[step:]
        _, rank = np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)
        have += step
    starts = np.bincount(rank)[rank] > 1
    cover = np.zeros(len(ids) + 1, np.int64)
    cover[: len(starts)] += starts
    cover[width : width + len(starts)] -= starts
    return int((np.cumsum(cover) > 0).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The numbers of STATISTICS for one text."""
    if not text:
        return (0,) * len(STATISTICS)
    b = text.encode("utf-8", "surrogatepass")
    words = b.split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    lines, earlier, dup = b.split(b"\n"), set(), 0
    for line in lines:
        if line in earlier:
            dup += 1
        elif line.strip(SPACE):
            earlier.add(line)
    gone = lambda chars: len(b) - len(b.translate(None, chars))
    return (
        len(words), len(text) - gone(SPACE), gone(SYMBOLS), dup, repeated_words(ids),
        len(seen), len(lines), gone(_UPPER), gone(_LOWER), gone(b"!?|"),
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the columns of STATISTICS, counted over whole texts."""

    def batch(column: pa.Array) -> list[list[int]]:
        return [list(c) for c in zip(*[statistics(t) for t in column.to_pylist()], strict=True)] or [[]] * len(STATISTICS)

    return appended(shaped(docs, [text], STATISTICS), STATISTICS, batch, text)


def ratios() -> dict[str, Column]:
    """What rules test, from the statistics alone."""

    def per(a: Column, b: Column) -> Column:
        return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))

    c = F.col
    return {
        "words": c("n_words").cast("double"),
        "word_length": per(c("word_chars"), c("n_words")),
        "symbol_share": per(c("n_symbols"), c("word_chars")),
        "dup_line_share": per(c("n_dup_lines"), c("n_lines")),
        "repeat_share": per(c("n_repeat_words"), c("n_words")),
        "distinct_share": per(c("n_distinct_words"), c("n_words")),
        "upper_share": per(c("n_upper"), c("n_upper") + c("n_lower")),
        "marks_per_word": per(c("n_marks"), c("n_words")),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, '<=' or '>', threshold), with its record on held-out rows."""

    conditions: tuple[tuple[str, str, float], ...]
    covered: int
    precision: float

    def column(self, features: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, op, t in self.conditions:
            out = out & (features[name] <= t if op == "<=" else features[name] > t)
        return out

    def mask(self, values: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(values.values()))), bool)
        for name, op, t in self.conditions:
            out &= values[name] <= t if op == "<=" else values[name] > t
        return out


def learn(
    values: dict[str, np.ndarray], low: np.ndarray, min_precision: float = 0.9, max_rules: int = 24,
    max_conditions: int = 4, thresholds: int = 64, seed: int = 7,
) -> list[Rule]:
    """An ordered list of rules for the rows that ``low`` marks, by sequential covering."""
    n = len(low)
    names = list(values)
    order = np.random.default_rng(seed).permutation(n)
    grow = np.zeros(n, bool)
    grow[order[: n * 2 // 3]] = True
    left, out = np.ones(n, bool), []
    cuts = {k: np.unique(np.quantile(v, np.linspace(0, 1, thresholds + 1))) if n else [] for k, v in values.items()}
    cuts = {k: (c[1:] + c[:-1]) / 2 for k, c in cuts.items() if len(c) > 1}
    cuts |= {k: np.unique(np.concatenate([c, _edges(values[k], low)])) for k, c in cuts.items()}
    while len(out) < max_rules and (left & grow & low).sum() >= 2:
        mask, conditions = left & grow, []
        while len(conditions) < max_conditions and (mask & ~low).any():
            p0, n0 = (mask & low).sum(), (mask & ~low).sum()
            best = (1e-9, None)
            for k in names:
                for t in cuts.get(k, ()):
                    under = values[k] <= t
                    for op, m in (("<=", mask & under), (">", mask & ~under)):
                        if p := (m & low).sum():
                            q = (m & ~low).sum()
                            gain = p * (np.log2(p / (p + q)) - np.log2(p0 / (p0 + n0)))
                            if gain > best[0]:
                                best = (gain, (k, op, float(t)))
            if best[1] is None:
                break
            conditions.append(best[1])
            mask = left & grow & Rule(tuple(conditions), 0, 0.0).mask(values)
        test = left & ~grow
        worth = lambda cs: _worth(Rule(tuple(cs), 0, 0.0).mask(values) & test, low)
        while len(conditions) > 1 and worth(conditions[:-1]) >= worth(conditions):
            conditions.pop()
        rule = Rule(tuple(conditions), 0, 0.0)
        hit = rule.mask(values) & left
        held = hit & test
        precision = (held & low).sum() / max(1, held.sum())
        sure = (hit & low).sum() / max(1, hit.sum())
        if not conditions or held.sum() < 1 or min(precision, sure) < min_precision:
            break
        out.append(Rule(tuple(conditions), int(hit.sum()), float(precision)))
        left &= ~hit
    return out


def _edges(v: np.ndarray, low: np.ndarray, most: int = 64) -> np.ndarray:
    """Middles between neighbouring values whose labels differ, thinned evenly to ``most``."""
    order = np.argsort(v, kind="stable")
    s, y = v[order], low[order]
    at = np.flatnonzero((y[1:] != y[:-1]) & (s[1:] > s[:-1]))
    if len(at) > most:
        at = at[np.linspace(0, len(at) - 1, most).astype(int)]
    return (s[at] + s[at + 1]) / 2


def _worth(mask: np.ndarray, low: np.ndarray) -> float:
    p, n = (mask & low).sum(), (mask & ~low).sum()
    return (p - n) / (p + n) if p + n else -1.0


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Rules for ``quality = 0`` from at most ``max_labelled`` labelled documents.

    The sample is broadcast: its size is bounded by the parameter, not by the data.
    """
    labels = shaped(labels, ["doc_id", "quality"]).select("doc_id", "quality")
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    rows = shaped(docs, ["doc_id", "text"]).select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    features = ratios()
    got = (
        with_statistics(rows).where(~base_failed())
        .select("doc_id", "quality", *[c.alias(k) for k, c in features.items()])
        .groupBy("doc_id").agg(*[F.max(c).alias(c) for c in ["quality", *features]])
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).drop("doc_id").toPandas()
    )
    return learn({k: got[k].to_numpy(float) for k in features}, got["quality"].to_numpy() == 0)


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: true keeps."""
    features = ratios()
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        out = out.when(rule.column(features), F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` plus the statistics, ``base_failed`` and ``kept``."""
    rules = fit(docs, labels, max_labelled)
    docs = shaped(docs, ["text"], [*STATISTICS, "base_failed", "kept"])
    return with_statistics(docs).withColumns({"base_failed": base_failed(), "kept": verdict(rules)})
