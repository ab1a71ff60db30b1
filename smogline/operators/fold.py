"""The running-difference state machine of pipeline B.

The state holds a running difference upward (``first``), the value it was last
measured at (``second``), a running difference downward (``third``), a sticky
flag and a counter. The result depends on every row in order, including how the
differences round, so it has to be run row by row; it cannot be put together
from independently computed parts.

One pass in order is therefore the floor for a group. Here it takes one shuffle
and one sort of the rows, whatever the size of a group: a task reads its sorted
rows batch by batch and keeps one state, so a group of any length takes constant
memory. The streaming form runs the same function.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentinels of an unset difference, and the difference that counts.
UNSET_UP = -1.0
UNSET_DOWN = -1000.0
STEP = 1.0

State = tuple[float, float, float, bool, int]
FRESH: State = (UNSET_UP, 0.0, UNSET_DOWN, False, 0)
STATE = "first double, second double, third double, tooHigh boolean, tooHighCount int"


def fold(values: Iterable[float | None], state: State = FRESH) -> State:
    """Run the state machine over values in order; null and NaN change nothing."""
    first, second, third, high, count = state
    for value in values:
        if value is None or value != value:
            continue
        if first <= value:
            moved = first != UNSET_UP
            first = (value - second) + first if moved else 0.0
            if moved and first >= STEP:
                high, count = True, count + 1
        elif third >= value:
            moved = third != UNSET_DOWN
            third = (value - second) + third if moved else 0.0
            high = high and not (moved and third >= STEP)
        else:
            continue
        second = value
    return first, second, third, high, count


def fold_groups(
    rows: DataFrame, keys: Sequence[str], value: str = "pm2", order: Sequence[str] = ("ts", "seq")
) -> DataFrame:
    """(keys, state as five columns) for every group; ``rows`` lie together by ``keys``."""
    schema = rows.select(*keys).schema.simpleString()[len("struct<"):-1] + ", " + STATE
    columns = [*keys, *order, value]
    dealt = rows.select(*columns).sortWithinPartitions(*keys, *order).drop(*order)
    return dealt.mapInArrow(lambda batches: _folded(batches, list(keys), value), schema)


def _folded(batches: Iterator[pa.RecordBatch], keys: list[str], value: str) -> Iterator[pa.RecordBatch]:
    """The states of the groups that end in each batch; the last one goes on into the next."""
    open_key, state, kinds = None, FRESH, None
    for batch in batches:
        if not batch.num_rows:
            continue
        kinds = [batch.schema.field(k).type for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            code = batch[key].dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            change[1:] |= code[1:] != code[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        values, done = batch[value].to_pylist(), []
        for lo, hi in zip(starts[:-1], starts[1:]):
            key = tuple(batch[k][lo].value if hasattr(batch[k][lo], "value") else batch[k][lo].as_py() for k in keys)
            if key != open_key:
                if open_key is not None:
                    done.append((*open_key, *state))
                open_key, state = key, FRESH
            state = fold(values[lo:hi], state)
        yield _states(done, keys, kinds)
    if open_key is not None:
        yield _states([(*open_key, *state)], keys, kinds)


def _states(done: list[tuple], keys: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    names = [*keys, "first", "second", "third", "tooHigh", "tooHighCount"]
    types = [*kinds, pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.int32()]
    columns = list(zip(*done)) or [[]] * len(names)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def state_columns() -> list:
    """Flag, counter and the three differences, as the trend record has them."""
    return ["tooHigh", "tooHighCount", F.struct("first", "second", "third").alias("pair")]
