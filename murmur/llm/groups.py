"""Streaming over sorted groups: many small groups a task, without one pandas call for each."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def stream_groups(keys: list[str], each: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for ``mapInArrow`` over partitions that hold the rows of each key together and one key after another: ``each`` gets a
    group's rows as one table. Only the group at hand is held; callers bound its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush():
            if held:
                t = pa.Table.from_batches(held)
                held.clear()
                yield from each(t)

        last = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(b.num_rows, dtype=bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            first = tuple(c[0] for c in cols)
            if last is not None and first != last:
                yield from flush()
            last = tuple(c[-1] for c in cols)
            cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
            for i, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if i:
                    yield from flush()
                held.append(b.slice(x, y - x))
        yield from flush()

    return run


def gathered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows hashed on the keys and sorted by them inside each partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def map_sorted_groups(df: DataFrame, keys: list[str], each: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Give the rows of each key to ``each`` as one table."""
    return gathered(df, keys).mapInArrow(stream_groups(keys, each), schema)


def merge_labels(labels: np.ndarray, members: np.ndarray) -> None:
    """Give all members' classes one label, the smallest."""
    found = np.unique(labels[members])
    if len(found) > 1:
        labels[np.isin(labels, found[1:])] = found[0]
