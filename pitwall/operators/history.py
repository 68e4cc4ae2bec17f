"""Leakage-free values from the earlier rows of an entity.

All statistics of one (key, order) pair are taken in one window pass: one
shuffle and one sort per key, whatever the number of columns.  Frames are ROWS
frames that end one row before the current one.

Hot keys.  An ordered window holds a key in one task.  ``add_history`` measures
the largest key first; if it does not fit a task, the rows of hot keys (and only
those) are cut into time slices:

* a slice is a run of calendar slots with about as many rows as a task may hold, so a
  key has no more slices than it needs, however few rows a slot has;
* the window runs per (key, slice);
* counts, means and squared deviations of the earlier slices are merged in from
  a small table with one row per (key, slice);
* rolling frames and lags get the last rows of the earlier slices as a halo;
* exact medians get the earlier slices' value counts as weighted seed rows.

Cold keys have the slice NULL and take the same window unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators.scan import group_sizes
from pitwall.session import ROWS_PER_TASK, materialise


@dataclass(frozen=True)
class Stat:
    """One history column: ``kind`` of ``value`` under the name ``alias``."""

    kind: str
    alias: str
    value: str | None = None
    width: int = 0


def prev_mean(value: str, alias: str) -> Stat:
    return Stat("mean", alias, value)


def prev_std(value: str, alias: str) -> Stat:
    return Stat("std", alias, value)


def prev_sum(value: str, alias: str) -> Stat:
    return Stat("sum", alias, value)


def prev_median(value: str, alias: str) -> Stat:
    """Exact.  Keep ``value`` a quantity with few distinct values: the frame
    carries a value -> count table."""
    return Stat("median", alias, value)


def prev_count(alias: str) -> Stat:
    return Stat("count", alias)


def lag_of(value: str, alias: str) -> Stat:
    return Stat("lag", alias, value, 1)


def roll_mean(value: str, width: int, alias: str) -> Stat:
    return Stat("roll_mean", alias, value, width)


def roll_std(value: str, width: int, alias: str) -> Stat:
    return Stat("roll_std", alias, value, width)


def min_observations(width: int) -> int:
    """Values a rolling frame needs before it reports one."""
    return max(3, width // 3)


def _rolling(value: Column, kind: str, width: int, window) -> Column:
    frame = window.rowsBetween(-width, -1)
    fn = F.avg if kind == "roll_mean" else F.stddev_samp
    return F.when(F.count(value).over(frame) >= min_observations(width), fn(value).over(frame))


def _plain(stat: Stat, window) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    if stat.kind == "count":
        return F.row_number().over(window).cast("bigint") - 1
    value = F.col(stat.value)
    if stat.kind == "lag":
        return F.lag(value, 1).over(window)
    if stat.kind in ("roll_mean", "roll_std"):
        return _rolling(value, stat.kind, stat.width, window)
    if stat.kind == "median":
        return F.percentile(value, F.lit(0.5)).over(earlier)
    return {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum}[stat.kind](value).over(earlier)


def history_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    stats: Sequence[Stat]) -> DataFrame:
    """The plain form: one window pass over keys known to fit a task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({s.alias: _plain(s, window) for s in stats})


def add_history(
    df: DataFrame,
    plan: Sequence[tuple[Sequence[str] | str, Sequence[Stat]]],
    order: Sequence[str],
    slice_by: Sequence[str],
    hot_rows: int = ROWS_PER_TASK,
    sizes: Mapping[str, int] | None = None,
    steps: bool = False,
) -> DataFrame:
    """History columns for several entity keys of one table.

    ``plan``     (key or keys, statistics) pairs; keys must not be NULL
    ``order``    a total order of the rows
    ``slice_by`` leading part of ``order`` used to cut hot keys
    ``sizes``    group sizes (or an upper bound) when already measured
    ``steps``    ``df`` is a written table: the rows are written again before the first key
                 changes, so that one shuffle of whole rows is held at a time, not one a key
    """
    plan = [([k] if isinstance(k, str) else list(k), list(stats)) for k, stats in plan]
    # A composite key is never larger than its first column.
    firsts = list(dict.fromkeys(keys[0] for keys, _ in plan))
    sizes = sizes if sizes is not None else group_sizes(df, firsts, hot_rows)
    hot = [sizes.get(keys[0], sizes[""]) > hot_rows for keys, _ in plan]
    base = df if steps or not any(hot) else materialise(df)  # the sliced form reads it several times
    out, written, last = base, [], None
    for (keys, stats), is_hot in zip(plan, hot):
        if steps and last not in (None, keys[0]):
            out = materialise(out, done=written)
            written = [out]
        out = (sliced_history(out, base, keys, order, slice_by, stats, hot_rows) if is_hot
               else history_windows(out, keys, order, stats))
        last = keys[0]
    return materialise(out, done=written) if steps else out


def sliced_history(df: DataFrame, base: DataFrame, keys: Sequence[str], order: Sequence[str],
                   slice_by: Sequence[str], stats: Sequence[Stat], hot_rows: int) -> DataFrame:
    """History with hot keys cut into slices.  ``base`` has the same rows as
    ``df`` and all value columns; the small side tables come from it."""
    medians = [s for s in stats if s.kind == "median"]
    others = [s for s in stats if s.kind != "median"]
    # At most rows / hot_rows keys, so the broadcast is bounded.
    hot = (base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
           .where(F.col("__n") > hot_rows).select(*keys, F.lit(True).alias("__hot")))
    cuts = ["__cut"]
    needed = list(dict.fromkeys([*keys, *order, *slice_by, *[s.value for s in stats if s.value]]))
    hot_rows_only = base.select(*needed).join(F.broadcast(hot), list(keys), "inner").drop("__hot")
    numbers = materialise(slice_numbers(hot_rows_only, keys, slice_by, max(1, hot_rows)))
    slots = numbers.withColumnsRenamed({c: f"__of_{c}" for c in [*keys, *slice_by]})
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in [*keys, *slice_by]]
    hot_base = hot_rows_only.join(slots, same).drop(*[f"__of_{c}" for c in [*keys, *slice_by]])
    # rows of cold keys have no slot and keep the slice NULL
    tagged = df.join(slots, same, "left").drop(*[f"__of_{c}" for c in [*keys, *slice_by]])

    if others:
        tagged = _sliced_moments(tagged, hot_base, list(keys), list(order), cuts, others)
    for stat in medians:
        tagged = _sliced_median(tagged, hot_base, list(keys), list(order), cuts, stat)
    return tagged.drop(*cuts)


def slice_numbers(rows: DataFrame, keys: Sequence[str], slice_by: Sequence[str], slice_rows: int) -> DataFrame:
    """(keys, slice_by, __cut): the slice of each calendar slot of a key.  Slots follow one
    another until a slice has about ``slice_rows`` rows; a slot itself is never cut."""
    slots = rows.groupBy(*keys, *slice_by).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(*slice_by).rowsBetween(Window.unboundedPreceding, -1)
    return slots.select(*keys, *slice_by, F.floor(F.coalesce(F.sum("__n").over(before), F.lit(0)) / F.lit(slice_rows)).alias("__cut"))


def _offsets(hot_base: DataFrame, keys, cuts, values) -> DataFrame:
    """Rows, observations, mean and squared deviation of all earlier slices."""
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for i, v in enumerate(values):
        x = F.col(v).cast("double")
        aggregates += [F.count(x).alias(f"__n{i}"), F.sum(x).alias(f"__s{i}"),
                       F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)).alias(f"__q{i}")]
    per_slice = hot_base.groupBy(*keys, *cuts).agg(*aggregates)
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(*cuts).rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__off_rows"),
               F.col("__rows")]
    for i, _ in enumerate(values):
        n, s, q = F.col(f"__n{i}"), F.coalesce(F.col(f"__s{i}"), F.lit(0.0)), F.col(f"__q{i}")
        # Deviations from the key's own mean keep the merge stable.
        centre = F.sum(s).over(whole) / F.nullif(F.sum(n).over(whole), F.lit(0))
        gap = F.coalesce(s / F.nullif(n, F.lit(0)) - centre, F.lit(0.0))
        off_n = F.coalesce(F.sum(n).over(earlier), F.lit(0))
        columns += [off_n.alias(f"__off_n{i}"),
                    F.coalesce(F.sum(s).over(earlier), F.lit(0.0)).alias(f"__off_s{i}"),
                    gap.alias(f"__gap{i}"), n.alias(f"__k{i}"), q.alias(f"__v{i}")]
    first = per_slice.select(*keys, *cuts, *columns)
    second = []
    for i, _ in enumerate(values):
        k, gap = F.col(f"__k{i}"), F.col(f"__gap{i}")
        spread = F.sum(F.col(f"__v{i}") + k * gap * gap).over(earlier)
        shift = F.sum(k * gap).over(earlier)
        second += [F.col(f"__off_n{i}"), F.col(f"__off_s{i}"),
                   F.coalesce(spread - shift * shift / F.nullif(F.col(f"__off_n{i}"), F.lit(0)),
                              F.lit(0.0)).alias(f"__off_q{i}")]
    return first.select(*keys, *cuts, "__off_rows", "__rows", *second)


def _halo(hot_base: DataFrame, offsets: DataFrame, keys, order, cuts, width: int) -> DataFrame:
    """For every slice, the ``width`` rows just before it (fewer at the start)."""
    newest_first = Window.partitionBy(*keys, *cuts).orderBy(*[F.col(o).desc() for o in order])
    tails = (hot_base.withColumn("__back", F.row_number().over(newest_first))
             .where(F.col("__back") <= width).drop("__back")
             .withColumn("__q", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))))
    earlier = (Window.partitionBy(*keys).orderBy(*cuts)
               .rowsBetween(Window.unboundedPreceding, -1))
    wanted = (offsets
              .withColumn("__upto", F.sum(F.least(F.col("__rows"), F.lit(width))).over(earlier))
              .where(F.col("__upto") > 0)
              .select(*keys, *cuts, F.explode(F.sequence(
                  F.greatest(F.lit(1).cast("bigint"), F.col("__upto") - width + 1),
                  F.col("__upto"))).alias("__q")))
    return wanted.join(tails.drop(*cuts), [*keys, "__q"]).drop("__q")


def _sliced_moments(tagged, hot_base, keys, order, cuts, stats) -> DataFrame:
    values = list(dict.fromkeys(s.value for s in stats if s.kind in ("mean", "std", "sum")))
    offsets = _offsets(hot_base, keys, cuts, values)
    width = max([s.width for s in stats], default=0)
    rows = tagged.withColumn("__real", F.lit(True))
    if width:
        halo = _halo(hot_base, offsets, keys, order, cuts, width).withColumn("__real", F.lit(False))
        rows = rows.unionByName(halo, allowMissingColumns=True)
    window = Window.partitionBy(*keys, *cuts).orderBy(*order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    real = F.col("__real")
    local = {"__pos": F.count(F.when(real, 1)).over(earlier)}
    for i, v in enumerate(values):
        x = F.when(real, F.col(v).cast("double"))
        local |= {f"__ln{i}": F.count(x).over(earlier), f"__ls{i}": F.sum(x).over(earlier),
                  f"__lv{i}": F.var_pop(x).over(earlier), f"__ld{i}": F.stddev_samp(x).over(earlier),
                  f"__lm{i}": F.avg(x).over(earlier)}
    final = {}
    for s in stats:
        if s.kind in ("lag", "roll_mean", "roll_std"):
            local[s.alias] = _plain(s, window)
            continue
        if s.kind == "count":
            final[s.alias] = F.coalesce(F.col("__off_rows"), F.lit(0)) + F.col("__pos")
            continue
        i = values.index(s.value)
        on, os, oq = (F.coalesce(F.col(f"__off_{c}{i}"), F.lit(0)) for c in "nsq")
        ln, ls = F.col(f"__ln{i}"), F.coalesce(F.col(f"__ls{i}"), F.lit(0.0))
        n, cold = on + ln, on == 0
        if s.kind == "sum":
            final[s.alias] = F.when(n > 0, os + ls)
        elif s.kind == "mean":
            final[s.alias] = F.when(cold, F.col(f"__lm{i}")).otherwise((os + ls) / n)
        else:
            gap = os / F.nullif(on, F.lit(0)) - ls / F.nullif(ln, F.lit(0))
            spread = (oq + F.coalesce(F.col(f"__lv{i}") * ln, F.lit(0.0))
                      + F.coalesce(gap * gap * on * ln / n, F.lit(0.0)))
            merged = F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))
            final[s.alias] = F.when(cold, F.col(f"__ld{i}")).otherwise(merged)
    done = rows.withColumns(local).where(real).join(offsets.drop("__rows"), [*keys, *cuts], "left")
    keep = [c for c in tagged.columns] + [s.alias for s in stats]
    return done.withColumns(final).select(*keep)


def _sliced_median(tagged, hot_base, keys, order, cuts, stat: Stat) -> DataFrame:
    counts = (hot_base.where(F.col(stat.value).isNotNull())
              .groupBy(*keys, *cuts, stat.value).agg(F.count(F.lit(1)).alias("__freq")))
    # values x slices of a hot key: the value must have few distinct values.
    grid = hot_base.select(*keys, *cuts).distinct().join(
        counts.select(*keys, stat.value).distinct(), keys)
    earlier = (Window.partitionBy(*keys, stat.value).orderBy(*cuts)
               .rowsBetween(Window.unboundedPreceding, -1))
    seeds = (grid.join(counts, [*keys, *cuts, stat.value], "left")
             .withColumn("__weight", F.sum("__freq").over(earlier))
             .where(F.col("__weight") > 0)
             .select(*keys, *cuts, stat.value, F.col("__weight").alias("__freq"),
                     F.lit(0).alias("__real")))
    rows = (tagged.withColumns({"__real": F.lit(1), "__freq": F.lit(1).cast("bigint")})
            .unionByName(seeds, allowMissingColumns=True))
    frame = (Window.partitionBy(*keys, *cuts).orderBy("__real", *order)
             .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn(stat.alias, F.percentile(F.col(stat.value), F.lit(0.5), F.col("__freq")).over(frame))
            .where(F.col("__real") == 1).drop("__real", "__freq"))
