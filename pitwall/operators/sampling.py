"""Hold-outs, samples and folds in a reproducible hash order.

Positions come from ``hash_rank`` / ``prefix_scan``, so no class, no fold and
not the whole table is ever ordered inside one task, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.scalars import hash_order
from pitwall.operators.quantiles import scalar_of
from pitwall.operators.scan import HASH_DIGITS, cut_slices, hash_rank, prefix_scan
from pitwall.session import ROWS_PER_TASK

RACE_ORDER = ["year", "round", "raceId"]


def split_random(df: DataFrame, ids: Sequence[str], test_size: float = 0.2, seed: int = 42,
                 name: str = "split") -> DataFrame:
    """Exactly ceil(test_size * n) test rows, drawn by hash order."""
    n_test = df.agg(F.ceil(F.count(F.lit(1)) * F.lit(test_size)).alias("n")).scalar()
    ranked = hash_rank(df, ids, name="__rank", seed=seed)
    return ranked.withColumn(name, F.when(F.col("__rank") < n_test, F.lit("test"))
                             .otherwise(F.lit("train"))).drop("__rank")


def split_stratified(df: DataFrame, ids: Sequence[str], label: str, test_size: float = 0.2,
                     seed: int = 42, name: str = "split") -> DataFrame:
    """Hold-out with the class shares of the whole: round(test_size * n) rows per class.
    Rows without a label are a class of their own."""
    # Whole slices of the hash order lie on one side; only the rows of the slice that the cut of a
    # class goes through are ordered, so no shuffle holds all rows.
    hashed = df.withColumn("__hash", hash_order(*ids, seed=seed)).withColumn("__slice", F.substring("__hash", 1, HASH_DIGITS))
    whole = Window.partitionBy(label)
    earlier = whole.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    n, n_test, before = F.col("__n"), F.col("__n_test"), F.col("__before")
    placed = hashed.groupBy(label, "__slice").agg(F.count(F.lit(1)).alias("__n")).withColumns({
        "__n_test": F.round(F.sum("__n").over(whole) * F.lit(test_size)), "__before": F.coalesce(F.sum("__n").over(earlier), F.lit(0))})
    cut = (before < n_test) & (before + n > n_test)
    cuts = placed.groupBy(F.col(label).alias("__label")).agg(
        F.max(F.when(before + n <= n_test, F.col("__slice"))).alias("__full"), F.max(F.when(cut, F.col("__slice"))).alias("__edge"),
        F.max(F.when(cut, n_test - before)).alias("__left"))  # a row a class
    held = hashed.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("__label")))
    on_edge = F.coalesce(F.col("__slice") == F.col("__edge"), F.lit(False))
    ranked = held.where(on_edge).withColumn("__rank", F.row_number().over(whole.orderBy("__hash", *ids)))
    parts = ((held.where(~on_edge), F.col("__slice") <= F.col("__full")), (ranked, F.col("__rank") <= F.col("__left")))
    sides = [part.select(*df.columns, F.when(test, F.lit("test")).otherwise(F.lit("train")).alias(name)) for part, test in parts]
    return sides[0].unionByName(sides[1])


def split_time(df: DataFrame, ids: Sequence[str], cutoff: int, *, column: str = "year",
               min_rows: int = 200, test_size: float = 0.2, seed: int = 42,
               name: str = "split") -> DataFrame:
    """Up to the cutoff against after it; a random hold-out when a side is too small."""
    early = F.col(column) <= cutoff
    sides = df.agg(F.count_if(early).alias("a"), F.count_if(F.col(column) > cutoff).alias("b")).first()
    if sides["a"] >= min_rows and sides["b"] >= min_rows:
        return df.where(F.col(column).isNotNull()).withColumn(
            name, F.when(early, F.lit("train")).otherwise(F.lit("test")))
    return split_random(df, ids, test_size, seed, name)


def sample_rows(df: DataFrame, ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """min(n, rows) rows by hash order; no task holds more than a slice of them."""
    return hash_rank(df, ids, name="__rank", seed=seed).where(F.col("__rank") < n).drop("__rank")


def races_of(df: DataFrame) -> DataFrame:
    return df.select(*RACE_ORDER).distinct()


def race_positions(df: DataFrame, *, recent_first: bool = False, name: str = "pos", sums: dict | None = None,
                   races: DataFrame | None = None, rows_per_slice: int = ROWS_PER_TASK) -> DataFrame:
    """Races with their 0-based place in time.  The calendar slots are the slices; a slot
    of more than ``rows_per_slice`` races is cut by measured splitters."""
    cut = cut_slices(races_of(df) if races is None else races, ["year", "round"], "raceId", name="__cut", rows_per_slice=rows_per_slice)
    return prefix_scan(cut, order=["raceId"], slices=["year", "round", "__cut"], count=name, sums=sums,
                       descending=recent_first).drop("__cut")


def keep_races(df: DataFrame, races: DataFrame) -> DataFrame:
    return df.join(races.select("raceId"), "raceId", "left_semi")


def last_n_races(df: DataFrame, n: int, *, recent: bool = True, min_races: int = 25) -> DataFrame:
    """Rows of the n newest (or oldest) races; unchanged when too few are left."""
    if n is None or n <= 0:
        return df
    races = race_positions(df, recent_first=recent, name="__pos")
    total = races_of(df).agg(F.count(F.lit(1)).alias("t")).scalar()
    return keep_races(df, races.where(
        (F.col("__pos") < n) | (F.least(total, F.lit(n)) < min_races)))


def row_budget(df: DataFrame, max_rows: int, *, recent: bool = True, min_races: int = 30) -> DataFrame:
    """Whole races from the newest (oldest) on until ``max_rows`` rows, at least ``min_races``.

    With c the rows up to and including a race and i its 1-based place, the race
    is kept iff i <= min_races or c <= max_rows.
    """
    if max_rows is None or max_rows <= 0:
        return df
    races = df.groupBy(*RACE_ORDER).agg(F.count(F.lit(1)).alias("__rows"))
    placed = race_positions(df, recent_first=recent, name="__pos", sums={"__before": "__rows"}, races=races)
    facts = scalar_of(races.agg(F.sum("__rows").alias("rows"), F.count(F.lit(1)).alias("races")))
    kept = placed.withColumn("__f", facts).where(
        (F.col("__pos") < min_races)
        | (F.col("__before") + F.col("__rows") <= max_rows)
        | (F.col("__f.rows") <= max_rows) | (F.col("__f.races") < min_races))
    return keep_races(df, kept)


def _half_even(c: Column) -> Column:
    return F.bround(c, 0).cast("bigint")


def sample_races(df: DataFrame, *, frac: float | None = None, n_races: int | None = None,
                 seed: int = 42, pick_recent: bool = True, min_races: int = 25,
                 recent_pool_frac: float = 1.0) -> DataFrame:
    """Rows of a random set of races, optionally drawn from the newest share only."""
    if frac is None and n_races is None:
        return df
    races = race_positions(df, recent_first=True, name="__age")
    total = races_of(df).agg(F.count(F.lit(1)).alias("t")).scalar()
    share = min(1.0, max(0.10, float(recent_pool_frac)))
    with_pool = races.withColumn("__total", total).withColumn(
        "__pool", F.least(F.col("__total"), F.greatest(
            F.lit(min_races), _half_even(F.col("__total") * F.lit(share))))
        if pick_recent else F.col("__total"))
    pool = with_pool.where(F.col("__age") < F.col("__pool"))
    ranked = hash_rank(pool, ["raceId"], name="__rank", seed=seed)
    wanted = F.lit(int(n_races)).cast("bigint") if n_races is not None else _half_even(
        F.col("__pool") * F.lit(float(frac)))
    k = F.greatest(F.lit(min_races), F.least(wanted, F.col("__pool")))
    picked = ranked.where(F.col("__rank") < k).select("raceId")
    # Too few races: everything stays.
    everything = with_pool.where(F.col("__total") < min_races).select("raceId")
    return keep_races(df, picked.unionByName(everything))


def fold_stratified(df: DataFrame, ids: Sequence[str], label: str, k: int = 5, seed: int = 42,
                    name: str = "fold") -> DataFrame:
    if k < 5:
        raise ValueError("at least 5 folds are required")
    ranked = hash_rank(df, ids, keys=[label], name="__rank", seed=seed)
    return ranked.withColumn(name, F.col("__rank") % k).drop("__rank")


def fold_random(df: DataFrame, ids: Sequence[str], k: int = 5, seed: int = 42,
                name: str = "fold") -> DataFrame:
    """Shuffled folds of equal size (within one row)."""
    return hash_rank(df, ids, name="__rank", seed=seed).withColumn(
        name, F.col("__rank") % k).drop("__rank")


def _level(loads: list[int], size: int, count: int) -> list[tuple[int, list[int]]]:
    """Where ``count`` groups of one size go if each goes to the lightest fold (the first on
    ties), as (rank of the first, folds in turn); ``loads`` are brought up to date.

    A fold with ``lead`` whole sizes more than the lightest joins in after that many rounds.
    """
    k, low = len(loads), min(loads)
    lead = [(x - low) // size for x in loads]
    rest = [(x - low) % size for x in loads]
    out, rank = [], 0
    edges = [*sorted(set(lead)), None]
    for round_, until in zip(edges, edges[1:]):
        turn = sorted((f for f in range(k) if lead[f] <= round_), key=lambda f: (rest[f], f))
        out.append((rank, turn))
        here = count - rank if until is None else min(count - rank, (until - round_) * len(turn))
        for i, f in enumerate(turn):
            loads[f] += size * (here // len(turn) + (i < here % len(turn)))
        rank += here
        if rank >= count:
            break
    return out


def _balance(k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loads = [0] * k
        for frame in frames:
            rows = []
            for size, count in zip(frame["__rows"].tolist(), frame["groups"].tolist()):
                parts = _level(loads, size, count)
                rows.append((size, [{"start": r, "turn": t} for r, t in parts]))
            yield pd.DataFrame(rows, columns=["size", "parts"])

    return run


def fold_group(df: DataFrame, group: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Whole groups per fold: from the largest down (hash order on ties), each goes to the lightest fold.
    Rows without a group are one group.

    Groups of one size are placed together, so the one pass in order sees a row per
    distinct size: fewer than the square root of twice the rows.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__rows"))
    ranked = hash_rank(sizes, [group], keys=["__rows"], name="__rank", seed=seed)
    classes = sizes.groupBy("__rows").agg(F.count(F.lit(1)).alias("groups")).repartition(1).sortWithinPartitions(F.desc("__rows"))
    placed = classes.mapInPandas(_balance(k), "size long, parts array<struct<start:long,turn:array<int>>>")
    mine = F.element_at(F.filter("parts", lambda p: p["start"] <= F.col("__rank")), -1)
    dealt = ranked.join(placed, F.col("__rows") == F.col("size")).withColumn("__part", mine).select(
        F.col(group).alias("__group"),
        F.get("__part.turn", ((F.col("__rank") - F.col("__part.start")) % F.size("__part.turn")).cast("int")).cast("bigint").alias(name))
    return df.join(dealt, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")


def fold_time_series(df: DataFrame, k: int = 5) -> DataFrame:
    """(raceId, fold, role): expanding folds over races in time order.

    Each validation part has n // (k + 1) races; training is everything earlier.
    """
    placed = race_positions(df, name="__pos")
    total = races_of(df).agg(F.count(F.lit(1)).alias("t")).scalar()
    size = F.floor(F.col("__n") / (k + 1))
    start = F.col("__n") - (k - F.col("fold")) * size
    folds = (placed.withColumn("__n", total)
             .withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(k)]))))
    role = (F.when(F.col("__pos") < start, F.lit("train"))
            .when(F.col("__pos") < start + size, F.lit("valid")))
    return folds.withColumn("role", role).where(F.col("role").isNotNull()).select("raceId", "fold", "role")


def segment_train(df: DataFrame, *, sample_frac: float | None = None, sample_n: int | None = None,
                  last_n: int | None = None, max_rows: int | None = None, recent: bool = True,
                  min_races: int = 25, seed: int = 42, recent_pool_frac: float = 1.0) -> DataFrame:
    """The one segmentation asked for; random races win over last n over row budget."""
    if sample_frac is not None or sample_n is not None:
        return sample_races(df, frac=sample_frac, n_races=sample_n, seed=seed, pick_recent=recent,
                            min_races=min_races, recent_pool_frac=recent_pool_frac)
    if last_n is not None:
        return last_n_races(df, last_n, recent=recent, min_races=min_races)
    if max_rows is not None:
        return row_budget(df, max_rows, recent=recent, min_races=min_races)
    return df
