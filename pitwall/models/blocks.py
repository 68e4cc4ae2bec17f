"""All-against-all work without all-against-all rows.

Both sides are dealt into hash blocks of bounded size; every pair of blocks is
one group that NumPy reduces at once.  What leaves a group is small (k rows or
one row per cluster for each point), never the pairs themselves, and no key of
the data decides where a row goes, so there is nothing to be skewed.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048


def block_count(df: DataFrame, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, math.ceil(df.count() / block_rows))


def block_pairs(left: DataFrame, left_id: str, right: DataFrame, right_id: str,
                fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Apply ``fn`` to every pair of blocks of the two sides."""
    n_left, n_right = block_count(left, block_rows), block_count(right, block_rows)

    def dealt(df, key, own, n_own, other, n_other):
        return (df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    a = dealt(left, left_id, "__l", n_left, "__r", n_right)
    b = dealt(right, right_id, "__r", n_right, "__l", n_left)
    return a.groupBy("__l", "__r").cogroup(b.groupBy("__l", "__r")).applyInPandas(fn, schema)
