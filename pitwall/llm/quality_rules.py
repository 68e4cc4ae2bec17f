"""Quality rules: text statistics, base rules and robust multivariate outliers.

Each language and source gets a minimum-covariance-determinant estimate of its
transformed statistics; a text too far from it by Mahalanobis distance goes.  The
estimates come from concentration steps over all rows: distances are binned,
moments summed by bin, and the nearest three quarters of a group taken from the
running counts, so that a step shuffles a few rows for each group and bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.session import materialise

#: Statistics and, for each, the smallest spread that an estimate may have.
FEATURES = {"word_length": 0.06, "symbols": 0.08, "capitals": 0.15, "other_characters": 0.12, "repeated_lines": 0.12,
            "repeated_words": 0.12}
#: Share of a group's rows that an estimate is taken from.
CORE = 0.75
STEPS = 6
#: Groups with fewer rows are pooled: sources by language, then languages.
LEAST_ROWS = 200
#: Largest distance, in standard deviations, that is kept.
CUTOFF = 7.5
#: Bins of the squared distance for each factor of two.
BINS = 16

_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\r\x0b\x0c"
_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField(n, T.DoubleType()) for n in FEATURES])


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more, the first one included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    code = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        code = code * np.uint64(0x9E3779B97F4A7C15) + ids[i:n + i]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    seen: dict[tuple, int] = {}  # the words themselves decide
    windows = {i: tuple(words[i:i + width]) for i in np.flatnonzero(twice).tolist()}
    for window in windows.values():
        seen[window] = seen.get(window, 0) + 1
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for i, window in windows.items():
        if seen[window] > 1:
            change[i] += 1
            change[i + width] -= 1
    return int((np.cumsum(change) > 0).sum())


def text_statistics(text: str | None) -> tuple:
    """Base counts and transformed statistics of one text.  The ratios count some
    ordinary words more, so that short texts stay near the middle."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # ASCII white space only
    n, chars = len(words), len(text) - sum(text.count(c) for c in _BLANKS)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    repeats = len(lines) - len(set(lines))
    again = repeated_words(words)
    if not n:
        return (0, 0, symbols, 0, 0, math.log(5), 0.0, math.log(0.05), math.log(0.05), 0.0, 0.0)
    capitals, letters = sum(map(str.isupper, text)), sum(map(str.isalpha, text))
    return (n, chars, symbols, repeats, again,
            math.log((chars + 300) / (n + 60)), math.sqrt(symbols / (n + 20)),
            math.log(0.05 + capitals / (letters + 100)), math.log(0.05 + (chars - letters) / (chars + 150)),
            math.sqrt(repeats / (len(lines) + 10)), math.sqrt(again / (n + 20)))


@F.pandas_udf(_SCHEMA)
def _statistics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_statistics(t) for t in texts], columns=_SCHEMA.names)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``q`` (in place of any such column).  NULL counts as empty."""
    return docs.drop("q").withColumn("q", _statistics(F.col(text)))


def base_failed() -> "Column":  # noqa: F821
    return (F.col("q.n_words") < 10) | (100 * F.col("q.n_repeat_words") > 20 * F.col("q.n_words"))


def chi_square(x: float, even: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(even // 2):
        total += term
        term *= x / 2 / (k + 1)
    return 1 - math.exp(-x / 2) * total


def consistency(core: float = CORE, p: int = len(FEATURES)) -> float:
    """Factor that makes the covariance of the nearest ``core`` right for a normal distribution."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, p) < core else (low, middle)
    return core / chi_square(low, p + 2)


def groups(stats: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(lang, source, g): the group of each pair.  Sources with too few rows share
    a group of their language, languages with too few such rows share one; if
    that is still too small, g is NULL and the distance decides nothing."""
    pairs = stats.filter(~base_failed()).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    name = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    own = F.col("n") >= least_rows
    by_lang = F.sum(F.when(~own, F.col("n"))).over(Window.partitionBy("lang"))
    pairs = pairs.withColumn("g", F.when(own, name("lang", "source")).when(by_lang >= least_rows, name("lang")))
    rest = pairs.filter("g is null").agg(F.sum("n").alias("rest"))
    return pairs.crossJoin(F.broadcast(rest)).select(  # one row: the rest's size
        "lang", "source", F.coalesce("g", F.when(F.col("rest") >= least_rows, F.lit("rest"))).alias("g"))


_P = len(FEATURES)
_X = [f"x{i}" for i in range(_P)]
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def _distance() -> "Column":  # noqa: F821
    """Squared Mahalanobis distance of x0.. from the columns mean and inverse."""
    d = [F.col(x) - F.col("mean")[i] for i, x in enumerate(_X)]
    return F.greatest(F.lit(0.0), sum((1.0 if i == j else 2.0) * F.col("inverse")[k] * d[i] * d[j]
                                      for k, (i, j) in enumerate(_PAIRS)))


_ESTIMATE = "g string, n long, mean array<double>, inverse array<double>"


def _solve(scale: float):
    """Moments of a group's core to its mean and inverse covariance."""
    floor = np.diag(np.square(list(FEATURES.values())))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for g, n, held, sums, squares in zip(batch["g"], batch["n"], batch["held"], batch["sums"], batch["squares"]):
                mean = np.asarray(sums) / held
                cov = np.zeros((_P, _P))
                for (i, j), s in zip(_PAIRS, squares):
                    cov[i, j] = cov[j, i] = s / held - mean[i] * mean[j]
                inverse = np.linalg.inv(scale * cov + floor)
                rows.append((g, n, mean.tolist(), [float(inverse[i, j]) for i, j in _PAIRS]))
            yield pd.DataFrame(rows, columns=["g", "n", "mean", "inverse"])

    return solve


def _start(rows: DataFrame) -> DataFrame:
    """First estimate: medians and quartile ranges, without correlations."""
    found = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(x) for x in _X])
    spread = [F.pow((F.col(x)[2] - F.col(x)[0]) / 1.349, 2) + f * f for x, f in zip(_X, FEATURES.values())]
    return found.select("g", "n", F.array(*[F.col(x)[1] for x in _X]).alias("mean"), F.array(*[
        1.0 / spread[i] if i == j else F.lit(0.0) for i, j in _PAIRS]).alias("inverse"))


def fit(stats: DataFrame, core: float = CORE, steps: int = STEPS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(lang, source, mean, inverse) of all pairs that have an estimate, from all
    rows of ``stats`` (columns lang, source, q) that pass the base rules."""
    of = materialise(groups(stats, least_rows))
    rows = materialise(stats.filter(~base_failed()).alias("s").join(
        of.alias("o"), F.col("s.lang").eqNullSafe(F.col("o.lang")) & F.col("s.source").eqNullSafe(F.col("o.source")))
        .filter("g is not null").select("g", *[F.col(f"q.{name}").alias(x) for name, x in zip(FEATURES, _X)]))
    estimate = materialise(_start(rows))
    factor = consistency(core)
    for _ in range(steps):
        distance = rows.join(estimate.select("g", "mean", "inverse"), "g").withColumn("d", _distance())
        by_bin = distance.groupBy("g", F.floor(BINS * F.log2(F.col("d") + 1e-12)).alias("bin")).agg(
            F.count(F.lit(1)).alias("k"), *[F.sum(x).alias(x) for x in _X],
            *[F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"s{i}{j}") for i, j in _PAIRS])
        total = F.sum("k").over(Window.partitionBy("g"))
        before = F.sum("k").over(Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
        near = by_bin.select("*", total.alias("n"), F.coalesce(before, F.lit(0)).alias("before")).filter(F.col("before") < core * F.col("n"))
        moments = near.groupBy("g").agg(F.max("n").alias("n"), F.sum("k").alias("held"),
                                        F.array(*[F.sum(x) for x in _X]).alias("sums"),
                                        F.array(*[F.sum(f"s{i}{j}") for i, j in _PAIRS]).alias("squares"))
        estimate = materialise(moments.mapInPandas(_solve(factor), _ESTIMATE))
    return materialise(of.join(estimate, "g").select("lang", "source", "mean", "inverse"))


def judge(stats: DataFrame, estimates: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` with base_failed, distance (NULL without an estimate) and kept,
    which replace any such columns."""
    kept = [c for c in stats.columns if c not in ("base_failed", "distance", "kept")]
    e = estimates.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.col("mean").alias("_mean"), F.col("inverse").alias("_inverse"))
    joined = stats.select(*kept).join(e, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    names = list(FEATURES)
    d = [F.col(f"q.{name}") - F.col("_mean")[i] for i, name in enumerate(names)]
    square = F.greatest(F.lit(0.0), sum((1.0 if i == j else 2.0) * F.col("_inverse")[k] * d[i] * d[j] for k, (i, j) in enumerate(_PAIRS)))
    distance = F.when(F.col("_mean").isNotNull(), F.sqrt(square))
    return joined.select(*kept, base_failed().alias("base_failed"), distance.alias("distance"),
                         (~base_failed() & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"))


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """doc_id, q (counts and statistics), base_failed, distance, kept of every row.

    NULL and empty texts have no words and fail the base rules.  NULL languages
    and sources are values like any other.  Repeated rows are judged alike.
    """
    stats = materialise(with_statistics(docs.select("doc_id", "lang", "source", "text")).drop("text"))
    return judge(stats, fit(stats, least_rows=least_rows), cutoff)


def keep_good(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept.  The statistics are computed a second
    time beside the text, so that no text is shuffled."""
    stats = materialise(with_statistics(docs.select("lang", "source", "text")).drop("text"))
    judged = judge(with_statistics(docs), fit(stats, least_rows=least_rows), cutoff)
    return judged.filter("kept").select(docs.columns)
