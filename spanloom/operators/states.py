"""Aggregates that a user brings, with partial states that are combined before rows are shuffled."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups whose states a task holds before it sends them on, and tasks that merge the states of one group first.
MOST_GROUPS, SALTS = 50_000, 64


class Aggregator(Protocol):
    """What an aggregate does: a state without rows, a state with the rows of a batch (one Arrow array for each column), two states as one, and the
    value of a state. A state is anything that can be pickled, and its size should not grow with the rows."""

    def start(self) -> Any: ...

    def update(self, state: Any, *columns: pa.Array) -> Any: ...

    def merge(self, a: Any, b: Any) -> Any: ...

    def finish(self, state: Any) -> Any: ...


def _partial(aggregator: Aggregator, n_keys: int):
    """Rows (keys, columns) to a pickled state for each group that the task has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, states, values = None, {}, {}
        for batch in batches:
            names = names or batch.schema
            if not batch.num_rows:
                continue
            keys = pa.StructArray.from_arrays([pc.cast(c, pa.string()) for c in batch.columns[:n_keys]], [str(i) for i in range(n_keys)]) if n_keys else None
            texts = [tuple(x.values()) for x in keys.to_pylist()] if n_keys else [()] * batch.num_rows
            rows: dict[tuple, list[int]] = {}
            for i, k in enumerate(texts):
                rows.setdefault(k, []).append(i)
            for k, own in rows.items():
                part = batch.take(pa.array(own)) if len(rows) > 1 else batch
                states[k] = aggregator.update(states[k] if k in states else aggregator.start(), *part.columns[n_keys:])
                if k not in values:
                    values[k] = [c[own[0]].as_py() for c in batch.columns[:n_keys]]
            if len(states) > MOST_GROUPS:
                yield _states(names, n_keys, values, states)
                states, values = {}, {}
        if states:
            yield _states(names, n_keys, values, states)

    return run


def _states(schema: pa.Schema, n_keys: int, values: dict, states: dict) -> pa.RecordBatch:
    keys = [pa.array([v[i] for v in values.values()], schema.field(i).type) for i in range(n_keys)]
    return pa.RecordBatch.from_arrays([*keys, pa.array([pickle.dumps(states[k], 5) for k in values], pa.binary())], [f"k{i}" for i in range(n_keys)] + ["state"])


def _merged(aggregator: Aggregator, n_keys: int, last: pa.DataType | None):
    """The states of a group to one state, or to its value."""

    def run(table: pa.Table) -> pa.Table:
        state = None
        for i, x in enumerate(table["state"]):
            own = pickle.loads(x.as_py())
            state = own if i == 0 else aggregator.merge(state, own)
        keys = {f"k{i}": table[f"k{i}"].slice(0, 1) for i in range(n_keys)}
        if last is None:
            return pa.table({**keys, "salt": table["salt"].slice(0, 1), "state": pa.array([pickle.dumps(state, 5)], pa.binary())})
        return pa.table({**keys, "value": pa.array([aggregator.finish(state)], last)})

    return run


def aggregate(df: DataFrame, by: list[str], columns: list[str], aggregator: Aggregator, returns: str, name: str = "value") -> DataFrame:
    """(by, name): an aggregator's value of the columns for each group; without keys a single row, and of an empty table none.

    Each task makes a state for each group it meets, so rows are not shuffled but states, one for each task and group. These meet in two steps, first
    in SALTS parts of each group, so that a group that all tasks have met is not merged by one. A null key is a group like others."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    n = len(by)
    rows = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    keys = [f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(n)]
    names = [f"k{i}" for i in range(n)]
    states = rows.mapInArrow(_partial(aggregator, n), ", ".join([*keys, "state binary"]))
    salted = states.withColumn("salt", F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(SALTS)).cast("int"))
    first = salted.groupBy(*names, "salt").applyInArrow(_merged(aggregator, n, None), ", ".join([*keys, "salt int", "state binary"]))
    kind = to_arrow_type(_parse_datatype_string(returns))
    found = first.groupBy(*names).applyInArrow(_merged(aggregator, n, kind), ", ".join([*keys, f"value {returns}"]))
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(by)], F.col("value").alias(name))


class CountedQuantile:
    """The smallest value with at least the share q of a column's values at or below it; nulls don't count. The state counts
    different values, so it is for columns of few of them."""

    def __init__(self, q: float = 0.5):
        self.q = q

    def start(self) -> dict:
        return {}

    def update(self, state: dict, values: pa.Array) -> dict:
        for x in pc.value_counts(values).to_pylist():
            if x["values"] is not None:
                state[x["values"]] = state.get(x["values"], 0) + x["counts"]
        return state

    def merge(self, a: dict, b: dict) -> dict:
        for v, n in b.items():
            a[v] = a.get(v, 0) + n
        return a

    def finish(self, state: dict):
        left = self.q * sum(state.values())
        for v in sorted(state):
            left -= state[v]
            if left <= 0:
                return v
        return None
