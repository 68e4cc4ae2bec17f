"""Sums of equally long arrays by key, combined in tasks before they travel far."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Groups that the partial sums of one key are added up in first.
SPREAD = 16
#: Up to this many tasks send their sums to the driver themselves.
DIRECT = 64
PARTIAL = "spread int, key int, s array<double>"


def matrices(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[np.ndarray]:
    """The list column of each batch as matrices of at most ``rows`` rows."""
    for batch in batches:
        column = batch.column(0)
        for at in range(0, len(column), rows):
            part = column.slice(at, rows)
            yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def partial_rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    """The sums of a task as rows of ``PARTIAL``."""
    spread = TaskContext.get().partitionId() % SPREAD
    keys = sorted(sums)
    return pa.RecordBatch.from_arrays([pa.array([spread] * len(keys), pa.int32()), pa.array(keys, pa.int32()),
                                       pa.array([sums[k] for k in keys], pa.list_(pa.float64()))], names=["spread", "key", "s"])


def add_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All keys of a partition, added up as they come."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for frame in frames:
        for spread, key, s in zip(frame["spread"], frame["key"], frame["s"]):
            at = (int(spread), int(key))
            sums[at] = sums[at] + s if at in sums else np.array(s)
    if sums:
        yield pd.DataFrame([(a, b, s) for (a, b), s in sums.items()], columns=["spread", "key", "s"])


def collected(partial: DataFrame) -> dict[int, np.ndarray]:
    """The sums by key, on the driver: the keys are as many as the caller has models, not
    rows.  Tasks that share a spread are added up first, so at most ``SPREAD`` rows a key come here."""
    return _added(partial.repartition(SPREAD, "spread").mapInPandas(add_all, PARTIAL))


def scanned(data: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> dict[int, np.ndarray]:
    """``collected`` of one scan, for fits that take hundreds of them.  A task for each core
    reads its share of the rows, so there is nothing to shuffle before the driver adds up."""
    cores = data.sparkSession.sparkContext.defaultParallelism
    if cores > DIRECT:
        return collected(data.mapInArrow(run, PARTIAL))
    return _added(data.coalesce(cores).mapInArrow(run, PARTIAL))


def _added(partial: DataFrame) -> dict[int, np.ndarray]:
    sums: dict[int, np.ndarray] = {}
    for batch in partial.toArrow().to_batches():
        keys, s = batch.column("key").to_pylist(), batch.column("s")
        for at, key in enumerate(keys):
            own = s[at].values.to_numpy(zero_copy_only=False)
            sums[key] = sums[key] + own if key in sums else own.copy()
    return sums
