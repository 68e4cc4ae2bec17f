"""Grouped, profile and distribution aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.columns import numeric_columns, string_columns
from pitwall.operators.quantiles import grouped_agg, scalar_of

_MOMENTS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
            "count": F.count, "sum": F.sum}


def multi_stat(df: DataFrame, by: Sequence[str], columns: Sequence[str],
               stats: Sequence[str] = ("mean", "std", "median", "min", "max"),
               row_count: str | None = None) -> DataFrame:
    """``column__stat`` for every column and statistic, in one aggregation."""
    aggregates, quantiles = [], {}
    for c in columns:
        for s in stats:
            if s == "median":
                quantiles[f"{c}__median"] = (c, 0.5)
            else:
                aggregates.append(_MOMENTS[s](c).alias(f"{c}__{s}"))
    if row_count:
        aggregates.append(F.count(F.lit(1)).alias(row_count))
    out = grouped_agg(df, by, aggregates, quantiles)
    names = [f"{c}__{s}" for c in columns for s in stats] + ([row_count] if row_count else [])
    return out.select(*by, *names)


def variation(mean: str, std: str, eps: float = 1e-6) -> Column:
    """Coefficient of variation std / (abs(mean) + eps)."""
    return F.col(std) / (F.abs(F.col(mean)) + F.lit(eps))


def group_count(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value."""
    counts = group_count(df, [column])
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def group_back(df: DataFrame, by: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Detail rows with aggregates of their group.

    Aggregate and join instead of a window: the aggregate combines before the
    shuffle, and the join is one that adaptive execution can split on a hot group.
    """
    return df.join(df.groupBy(*by).agg(*aggregates), list(by), "left")


def group_distinct_back(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    return group_back(df, by, [F.count_distinct(F.col(column)).alias(name)])


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs and their percentage per column, only columns that have any."""
    columns = list(columns or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("__n"),
                     *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counted.unpivot("__n", columns, "column", "n_missing")
    return (long.where(F.col("n_missing") > 0)
            .select("column", "n_missing", (F.col("n_missing") * 100.0 / F.col("__n")).alias("pct")))


def describe(df: DataFrame) -> DataFrame:
    """One row per column: count, unique, top, freq for text; moments and quartiles for numbers."""
    numbers, texts = numeric_columns(df), string_columns(df)
    parts = []
    if numbers:
        wide = grouped_agg(
            df.select(*[F.col(c).cast("double").alias(c) for c in numbers]), [],
            [_MOMENTS[s](c).alias(f"{c}|{s}") for c in numbers
             for s in ("count", "mean", "std", "min", "max")],
            {f"{c}|{q}": (c, p) for c in numbers
             for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))})
        entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}|count`").alias("count"),
                            *[F.col(f"`{c}|{s}`").alias(s)
                              for s in ("mean", "std", "min", "q25", "q50", "q75", "max")])
                   for c in numbers]
        parts.append(wide.select(F.inline(F.array(*entries))))
    if texts:
        # (column, value) counts first: a frequent value is combined before the shuffle.
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in texts])).alias("e")
        ).select("e.*").where(F.col("value").isNotNull())
        counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        top = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
        parts.append(counted.groupBy("column").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
            top.alias("top"), F.max("n").alias("freq")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs, long form, from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{x}|{y}`").alias("r"))
               for x, y in pairs for a, b in dict.fromkeys([(x, y), (y, x)])]
    return wide.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, column: str, bins: int = 25) -> DataFrame:
    """Equal-width bins over min..max, the last one closed; empty bins are listed."""
    x = F.col(column).cast("double")
    some = df.where(x.isNotNull() & ~F.isnan(x))
    edges = some.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    edge = scalar_of(edges)
    width = F.col("e.hi") - F.col("e.lo")
    place = F.when(width == 0, F.lit(bins // 2)).otherwise(
        F.least(F.floor((x - F.col("e.lo")) / F.nullif(width, F.lit(0.0)) * bins), F.lit(bins - 1)))
    counts = some.withColumn("e", edge).groupBy(place.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(F.broadcast(counts), "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def box_stats(df: DataFrame, by: str, column: str, min_rows: int = 1) -> DataFrame:
    """Quartiles and whiskers (last value within 1.5 IQR) per group."""
    quarts = grouped_agg(df, [by], [F.count(column).alias("n")], {
        "q1": (column, 0.25), "med": (column, 0.5), "q3": (column, 0.75)}
    ).where(F.col("n") >= min_rows)
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5)
    x = F.col(column)
    ends = df.join(quarts, by).where(x.between(F.col("q1") - reach, F.col("q3") + reach))
    return quarts.join(ends.groupBy(by).agg(F.min(x).alias("low"), F.max(x).alias("high")), by)


def entity_modes(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """Most frequent value, the smallest on ties.  Counted per (group, value)
    first, so a hot group reaches the last step as one row per value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*by).agg(
        F.min_by(column, F.struct(-F.col("__n"), F.col(column))).alias(name))


def top_groups(df: DataFrame, by: str, aggregate: Column, name: str, k: int = 10) -> DataFrame:
    return df.groupBy(by).agg(aggregate.alias(name)).orderBy(F.col(name).desc(), F.col(by)).limit(k)


def best_and_worst(df: DataFrame, metric: str, tie: str, k: int = 15) -> DataFrame:
    """The k highest and k lowest rows, tagged."""
    worst = df.orderBy(F.col(metric).desc(), F.col(tie)).limit(k).withColumn("side", F.lit("worst"))
    best = df.orderBy(F.col(metric).asc(), F.col(tie)).limit(k).withColumn("side", F.lit("best"))
    return worst.unionByName(best)


def argmax_row(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """The row with the largest metric, as one aggregation."""
    pick = F.min_by(F.struct(*df.columns), F.struct(-F.col(metric), F.col(tie)))
    return df.agg(pick.alias("r")).select("r.*")


def fill_all(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Numbers to their median, text to its most frequent value."""
    filled = df
    if numbers:
        medians = scalar_of(grouped_agg(df, [], [], {c: (c, 0.5) for c in numbers}))
        filled = filled.withColumn("__m", medians).withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.col(f"__m.{c}")) for c in numbers}).drop("__m")
    for c in texts:
        mode = entity_modes(df, [], c, "m").scalar()
        filled = filled.withColumn(c, F.coalesce(F.col(c), mode))
    return filled


def stack_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack metric rows of different models; absent columns become NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def summary_document(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns gathered into nested structs: one JSON document per row."""
    return df.select(*[F.struct(*cols).alias(name) for name, cols in groups.items()])
