"""Running counts and sums over a long order, in two levels.

``sum(x) OVER (PARTITION BY key ORDER BY t)`` puts one key into one task.  When
a key (or the whole table, for an order without a key) may hold a third of the
rows, that task never ends.  ``prefix_scan`` cuts the order into slices first:

1. totals per (key, slice)       - partial aggregation before the shuffle
2. running totals over slices    - one row per (key, slice), so small
3. running values inside a slice - one window partition per (key, slice)
4. 3 + the offsets of 2

The result is the same as the plain window; only the largest task shrinks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.scalars import hash_order
from pitwall.session import ROWS_PER_TASK

HASH_DIGITS = 4  # 65 536 slices of a hash order


def _direction(c: Column, descending: bool) -> Column:
    return c.desc() if descending else c.asc()


def prefix_scan(
    df: DataFrame,
    *,
    order: Sequence[Column | str],
    slices: Sequence[Column | str],
    keys: Sequence[str] = (),
    count: str | None = None,
    sums: Mapping[str, Column | str] | None = None,
    descending: bool = False,
    order_desc: bool | None = None,
) -> DataFrame:
    """Add exclusive running values: rows before this one, and sums over them.

    ``slices`` must not decrease along ``order`` (increase, when descending).
    NULL keys and slices are values like any other, before all others.
    ``count`` names the running row count, ``sums`` maps names to summed columns.
    """
    sums = dict(sums or {})
    order_desc = descending if order_desc is None else order_desc
    keys = list(keys)
    slice_names = [f"__scan_slice{i}" for i in range(len(slices))]
    tagged = df.withColumns({
        n: (F.col(s) if isinstance(s, str) else s) for n, s in zip(slice_names, slices)})
    order_cols = [_direction(F.col(o), order_desc) if isinstance(o, str) else o for o in order]

    aggregates = [F.count(F.lit(1)).alias("__scan_rows")] + [
        F.sum(F.col(c) if isinstance(c, str) else c).alias(f"__scan_total_{a}") for a, c in sums.items()]
    totals = tagged.groupBy(*keys, *slice_names).agg(*aggregates)
    # Bounded by keys x slices; without a key this is the list of slices alone.
    before = (Window.partitionBy(*keys).orderBy(*[_direction(F.col(s), descending) for s in slice_names])
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *keys, *slice_names,
        F.coalesce(F.sum("__scan_rows").over(before), F.lit(0)).alias("__scan_off_rows"),
        *[F.coalesce(F.sum(f"__scan_total_{a}").over(before), F.lit(0)).alias(f"__scan_off_{a}") for a in sums])

    inside = Window.partitionBy(*keys, *slice_names).orderBy(*order_cols)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumns({
        "__scan_pos": F.row_number().over(inside).cast("bigint") - 1,
        **{f"__scan_in_{a}": F.coalesce(F.sum(F.col(c) if isinstance(c, str) else c).over(earlier), F.lit(0))
           for a, c in sums.items()}})
    names = [*keys, *slice_names]
    offsets = offsets.withColumnsRenamed({n: f"__scan_of_{n}" for n in names})
    joined = local.join(offsets, [F.col(n).eqNullSafe(F.col(f"__scan_of_{n}")) for n in names], "left") if names else local.crossJoin(offsets)
    out = {a: F.col(f"__scan_off_{a}") + F.col(f"__scan_in_{a}") for a in sums}
    if count:
        out[count] = F.col("__scan_off_rows") + F.col("__scan_pos")
    temp = [*slice_names, *[f"__scan_of_{n}" for n in names], "__scan_pos", "__scan_off_rows",
            *[f"__scan_in_{a}" for a in sums], *[f"__scan_off_{a}" for a in sums]]
    return joined.withColumns(out).drop(*temp)


def hash_rank(df: DataFrame, ids: Sequence[str], *, name: str, seed: int = 42,
              keys: Sequence[str] = ()) -> DataFrame:
    """0-based position in the hash order of ``ids``, per key.

    The slices are the leading digits of the hash, so they are even by nature.
    """
    return prefix_scan(
        df.withColumn("__hash", hash_order(*ids, seed=seed)),
        keys=keys, order=["__hash", *ids], slices=[F.substring("__hash", 1, HASH_DIGITS)], count=name,
    ).drop("__hash")


def value_slices(df: DataFrame, column: str, *, name: str,
                 rows_per_slice: int = ROWS_PER_TASK) -> DataFrame:
    """Add a slice number that grows with ``column`` and holds about equal row counts.

    The edges are approximate quantiles; a table that fits one slice needs none.
    NaN goes with the largest values and NULL before the smallest, as Spark orders them.
    """
    n_rows = df.count()
    n_slices = math.ceil(n_rows / rows_per_slice)
    if n_slices <= 1:
        return df.withColumn(name, F.lit(0.0))
    probabilities = [i / n_slices for i in range(1, n_slices)]
    edges = sorted({x for x in df.approxQuantile(column, probabilities, 1 / (4 * n_slices)) if math.isfinite(x)})
    splits = [float("-inf"), *edges, float("inf")]
    if len(splits) < 3:
        return df.withColumn(name, F.lit(0.0))
    cut = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep").transform(df)
    return cut.withColumn(name, F.when(F.col(column).isNull(), F.lit(-1.0)).otherwise(F.col(name)))


def cut_slices(df: DataFrame, slots: Sequence[str], order: str, *, name: str,
               rows_per_slice: int = ROWS_PER_TASK, pieces: int = 256) -> DataFrame:
    """Add a number that cuts slots of more than ``rows_per_slice`` rows along ``order``.

    Slots are counted first; only the large ones are sketched for their splitters, of
    which there are ``pieces`` - 1 in each.  The number is 0 in all other slots and grows
    with ``order``, so (slots, number) are slices for ``prefix_scan``.
    """
    large = df.groupBy(*slots).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_slice)
    large = large.select(*[F.col(c).alias(f"__of_{c}") for c in slots])
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in slots]
    shares = [i / pieces for i in range(1, pieces)]
    edges = df.join(large, same, "left_semi").groupBy(*[F.col(c).alias(f"__of_{c}") for c in slots]).agg(
        F.percentile_approx(order, shares, 10 * pieces).alias("__edges"))
    cut = F.size(F.filter(F.coalesce("__edges", F.array()), lambda e: e < F.col(order)))
    return df.join(edges, same, "left").withColumn(name, F.coalesce(cut, F.lit(0))).drop("__edges", *[f"__of_{c}" for c in slots])


def group_sizes(df: DataFrame, keys: Sequence[str] = (), limit: int = ROWS_PER_TASK) -> dict[str, int]:
    """Total rows (under "") and rows of the largest group of each key.

    A table of at most ``limit`` rows cannot hold a larger group, so there its
    count is the bound for every key.  The sizes also bound any subset of the rows, so one
    measurement serves all later steps on filtered rows.
    """
    total = df.count()
    sizes = {"": total, **{k: total for k in keys}}
    if total <= limit or not keys:
        return sizes
    parts = None
    for k in keys:
        part = df.groupBy(k).count().agg(F.max("count").alias("n")).select(F.lit(k).alias("k"), "n")
        parts = part if parts is None else parts.unionByName(part)
    return {**sizes, **{r["k"]: r["n"] or 0 for r in parts.collect()}}
