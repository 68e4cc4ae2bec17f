"""Exact quantiles that keep working when one group holds most rows.

Spark's exact ``percentile`` keeps a value -> count table per group.  For groups
too large for that, the values are first clamped to a bracket around the wanted
quantile that ``percentile_approx`` guarantees to contain it.  Clamping is
monotone, so the quantile of the clamped values is the exact one, while the
table only holds the values inside the bracket.  A bracket that still holds too
many rows is narrowed by counted passes over its rows; the sketch has the same
size in each of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.scan import group_sizes

# Groups up to this size keep a plain value table.
PLAIN_ROWS = 1_000_000
# Accuracy of every sketch, and the rows of the largest group that a bracket may hold.
MIN_ACCURACY = 10_000
BRACKET_ROWS = 1_000_000
# Steps that a narrowing pass divides a bracket into.
GRID = 200


def grouped_agg(
    df: DataFrame,
    by: Sequence[str],
    aggregates: Sequence[Column],
    quantiles: Mapping[str, tuple[str, float]],
    max_rows: int = PLAIN_ROWS,
    sizes: Mapping[str, int] | None = None,
    accuracy: int | None = None,
    bracket_rows: int | None = None,
) -> DataFrame:
    """``df.groupBy(by).agg(*aggregates)`` plus exact quantiles.

    ``quantiles`` maps an output name to (column, p); ``sizes`` are the group
    sizes (or an upper bound) when already measured.
    """
    by = list(by)
    if quantiles:
        sizes = sizes if sizes is not None else group_sizes(df, by[:1], max_rows)
        largest = sizes.get(by[0], sizes[""]) if by else sizes[""]
        if largest > max_rows:
            accuracy = accuracy or MIN_ACCURACY
            passes = narrowing_passes(largest, accuracy, bracket_rows or BRACKET_ROWS)
            return _bracketed(df, by, aggregates, quantiles, accuracy, passes)
    shared, picks = _shared_quantiles({a: (F.col(c), c, p) for a, (c, p) in quantiles.items()})
    # The rows go to their group before any aggregate: small groups lie across all tasks, and a
    # value table for each of their pieces would be many times the rows.  No group is large here.
    out = (df.repartition(*by) if by and quantiles else df).groupBy(*by).agg(*aggregates, *shared)
    temp = [f"__q_{c}" for c in dict.fromkeys(c for c, _ in quantiles.values())]
    return out.withColumns(picks).drop(*temp) if picks else out


def _shared_quantiles(quantiles: Mapping[str, tuple[Column, str, float]]):
    """One value table per column, however many of its quantiles are asked for."""
    by_column: dict[str, tuple[Column, list[float]]] = {}
    for value, c, p in quantiles.values():
        ps = by_column.setdefault(c, (value, []))[1]
        if p not in ps:
            ps.append(p)
    shared = [F.percentile(value, F.array(*[F.lit(p) for p in ps])).alias(f"__q_{c}")
              for c, (value, ps) in by_column.items()]
    picks = {a: F.col(f"__q_{c}")[by_column[c][1].index(p)] for a, (_, c, p) in quantiles.items()}
    return shared, picks


def narrowing_passes(rows: int, accuracy: int, bracket_rows: int) -> int:
    """Passes after which a bracket of a group of ``rows`` distinct values holds at
    most ``bracket_rows``; values that repeat only make its table smaller."""
    passes, inside = 0, rows * 6 / accuracy
    shrink = min(0.5, 2 / GRID + 6 / accuracy)
    while inside > bracket_rows:
        passes, inside = passes + 1, inside * shrink
    return passes


def _with_edges(df: DataFrame, by: list[str], edges: DataFrame) -> DataFrame:
    if by:
        edges = edges.withColumnsRenamed({b: f"__by_{b}" for b in by})
        same = [F.col(b).eqNullSafe(F.col(f"__by_{b}")) for b in by]
        return df.join(edges, same, "left").drop(*[f"__by_{b}" for b in by])
    return df.withColumn("__edge", scalar_of(edges)).select("*", "__edge.*").drop("__edge")


def _bracketed(df, by, aggregates, quantiles, accuracy: int, passes: int) -> DataFrame:
    slack = 3 / accuracy
    wanted: dict[str, list[float]] = {}
    for c, p in quantiles.values():
        wanted.setdefault(c, []).extend((max(0.0, p - slack), min(1.0, p + slack)))
    # One sketch per column.  Up to ``accuracy`` rows the slack is less than three
    # ranks: no clamping there.
    brackets = [F.when(F.count(c) > accuracy, F.percentile_approx(c, ps, accuracy)).alias(f"__b_{c}")
                for c, ps in wanted.items()]
    sketched, used, pick = df.groupBy(*by).agg(*brackets), {c: 0 for c in wanted}, []
    for a, (c, _) in quantiles.items():
        i = used[c]
        used[c] += 2
        pick += [F.col(f"__b_{c}")[i].alias(f"__lo_{a}"), F.col(f"__b_{c}")[i + 1].alias(f"__hi_{a}")]
    edges = sketched.select(*by, *pick)
    for _ in range(passes):
        edges = _narrowed(_with_edges(df, by, edges), by, quantiles, accuracy)
    exact = []
    for a, (c, p) in quantiles.items():
        x, lo, hi = F.col(c), F.col(f"__lo_{a}"), F.col(f"__hi_{a}")
        clamped = F.when(lo.isNull() | x.isNull(), x).otherwise(F.greatest(F.least(x, hi), lo))
        exact.append(F.percentile(clamped, F.lit(p)).alias(a))
    return _with_edges(df, by, edges).groupBy(*by).agg(*aggregates, *exact)


def _narrowed(held: DataFrame, by: list[str], quantiles, accuracy: int) -> DataFrame:
    """Brackets inside the present ones: the rows below a bracket are counted, so
    the ranks that the quantile needs are known inside it, and a sketch of the
    inside gives the steps around them."""
    facts, pick = [], []
    steps = [i / GRID for i in range(GRID + 1)]
    for a, (c, p) in quantiles.items():
        x, lo, hi = F.col(c), F.col(f"__lo_{a}"), F.col(f"__hi_{a}")
        inside = F.when((x >= lo) & (x <= hi), x)
        facts += [F.max(lo).alias(f"__lo_{a}"), F.max(hi).alias(f"__hi_{a}"), F.count(x).alias(f"__n_{a}"),
                  F.count_if(x < lo).alias(f"__k_{a}"), F.count(inside).alias(f"__m_{a}"),
                  F.percentile_approx(inside, steps, accuracy).alias(f"__g_{a}")]
        at = F.lit(p) * (F.col(f"__n_{a}") - 1)
        below, size, grid = F.col(f"__k_{a}"), F.col(f"__m_{a}"), F.col(f"__g_{a}")
        first = F.floor(((F.floor(at) - below) / size - 3 / accuracy) * GRID).cast("int")
        last = F.ceil(((F.ceil(at) + 1 - below) / size + 3 / accuracy) * GRID).cast("int")
        enough = size > accuracy  # else the slack is less than three ranks
        # ``get`` is NULL outside the grid: there the old edge stays
        pick += [F.coalesce(F.when(enough & (first > 0), F.get(grid, first)), F.col(f"__lo_{a}")).alias(f"__lo_{a}"),
                 F.coalesce(F.when(enough & (last < GRID), F.get(grid, last)), F.col(f"__hi_{a}")).alias(f"__hi_{a}")]
    return held.groupBy(*by).agg(*facts).select(*by, *pick)


def global_stats(df: DataFrame, means: Mapping[str, str] | None = None,
                 medians: Mapping[str, str] | None = None,
                 others: Sequence[Column] = (), sizes: Mapping[str, int] | None = None) -> DataFrame:
    """One row: means and exact medians over the non-NULL values."""
    aggregates = [F.avg(c).alias(a) for a, c in (means or {}).items()] + list(others)
    return grouped_agg(df, [], aggregates, {a: (c, 0.5) for a, c in (medians or {}).items()}, sizes=sizes)


def scalar_of(one_row: DataFrame) -> Column:
    """A one-row table as a struct column (an uncorrelated scalar subquery)."""
    return one_row.select(F.struct(*one_row.columns)).scalar()
