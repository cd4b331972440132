"""Vector, text and numeric helpers; all stay in the JVM."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column

ColumnLike = Column | str


def _column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: ColumnLike, b: ColumnLike) -> Column:
    """Dot product in double precision; null if either vector or any element is null, or lengths differ."""
    a, b = _column(a), _column(b)
    total = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(b), total)


def norm(a: ColumnLike) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: ColumnLike, b: ColumnLike) -> Column:
    """Cosine similarity; null where a norm is 0."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def exact_share(part: ColumnLike, whole: ColumnLike) -> Column:
    """``part / whole`` as a double, null where ``whole`` is 0."""
    return F.try_divide(_column(part).cast("double"), _column(whole).cast("double"))


def jaro(a: str | None, b: str | None) -> float | None:
    """Jaro similarity of two strings, for use within a Python function; null if one is."""
    if a is None or b is None:
        return None
    if not a or not b:
        return float(a == b)
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free, met = [True] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                met.append(c)
                break
    if not met:
        return 0.0
    other = [c for c, f in zip(b, free, strict=True) if not f]
    moved = sum(x != y for x, y in zip(met, other, strict=True)) // 2
    m = len(met)
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3
