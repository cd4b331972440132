"""Aggregates of a user's own, with partial states: what no built-in function folds."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

#: Groups of which a task keeps states at once; beyond it they are passed on, and merged later.
MAX_GROUPS = 100_000


def folded(rows: DataFrame, by: Sequence[str], value: str, zero: Callable[[], object], add: Callable, merge: Callable, finish: Callable, result: str) -> DataFrame:
    """``by`` and the columns ``result`` (DDL) of an aggregate over ``value``.

    ``add(state, values)`` takes a list of values of a group in any order, ``merge(a, b)`` two states,
    ``finish(state)`` gives the values of ``result``. Tasks fold rows to states before anything moves,
    so a group costs a state a task, whatever its rows; states of a group meet in one task, one at a time.
    """
    keys = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)
    order = [*by, value]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, object] = {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            groups: dict[tuple, list] = {}
            for *key, v in zip(*columns, strict=True):
                groups.setdefault(tuple(key), []).append(v)
            for key, values in groups.items():
                states[key] = add(states[key] if key in states else zero(), values)
            if len(states) > MAX_GROUPS:
                yield out(states, batch.schema)
                states = {}
        if states:
            yield out(states, batch.schema)

    def out(states: dict, schema: pa.Schema) -> pa.RecordBatch:
        made = [pa.array([k[i] for k in states], schema.field(i).type) for i in range(len(by))]
        return pa.RecordBatch.from_arrays([*made, pa.array([pickle.dumps(s) for s in states.values()], pa.binary())], names=[*by, "_state"])

    def final(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for data in batch.column(batch.schema.get_field_index("_state")).to_pylist():
                part = pickle.loads(data)
                state = part if state is None else merge(state, part)
        yield pa.RecordBatch.from_pylist([dict(zip(names, [*[k.as_py() for k in key], *finish(state)], strict=True))], schema=kinds)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(f"{keys}, {result}")
    kinds, names = to_arrow_schema(schema), schema.names
    return rows.select(*order).mapInArrow(partial, f"{keys}, _state binary").groupBy(*by).applyInArrow(final, schema)


def longest_streak(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, start, length) of the longest run of consecutive integers among the values of each group; the first of ties.

    States are disjoint ranges, so a group costs as much as it has gaps.
    """

    def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for a, b in sorted(ranges):
            if out and a <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    add = lambda s, values: joined(s + [(v, v) for v in set(values) if v is not None])

    def finish(s: list) -> tuple:
        best = max(s, key=lambda r: (r[1] - r[0], -r[0]), default=None)
        return (None, 0) if best is None else (best[0], best[1] - best[0] + 1)

    return folded(rows, by, value, list, add, lambda a, b: joined(a + b), finish, "start bigint, length bigint")
