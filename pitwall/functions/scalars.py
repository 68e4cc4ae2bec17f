"""Column -> Column helpers.  All of them are built-in expressions, so they
stay inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings read as missing in text files, beside an empty cell.
MISSING_TOKENS = ["\\N", "NA", "N/A", "NULL", "null", "NaN", "nan", "None", "n/a"]

# Right edges of the regulation eras.
ERA_EDGES = [1999, 2005, 2010, 2014, 2017, 2021, 2025]

def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: str | Column) -> Column:
    """Blank or one of MISSING_TOKENS becomes NULL."""
    text = F.trim(col(c))
    return F.when((text == "") | text.isin(MISSING_TOKENS), None).otherwise(col(c))


# What a reader takes for a number; the cast alone would take '1.5d' and '2f', too.
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def to_num(c: str | Column) -> Column:
    """Text to double; what is not a number becomes NULL, never NaN."""
    text = col(c).cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def number(df: DataFrame, name: str) -> Column:
    """Column of ``df`` as double; text goes through ``to_num``, numbers do not."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return to_num(name)
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value) if isinstance(kind, T.FractionalType) else value


def whole(df: DataFrame, name: str) -> Column:
    """Column of ``df`` as bigint; integers are left as they are."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    return number(df, name).cast("bigint")


def lap_time_ms(c: str | Column) -> Column:
    """'1:23.456' or '83.456' to milliseconds; anything else to NULL.

    The text is cut at its first colon.  Both parts are read as decimals, which
    take no 'nan' and no second colon.
    """
    text = col(c)
    colon = F.instr(text, ":")
    minutes = F.when(colon > 0, _decimal(F.substring_index(text, ":", 1))).otherwise(F.lit(0.0))
    seconds = _decimal(F.substr(text, colon + 1))
    return (minutes * F.lit(60.0) + seconds) * F.lit(1000.0)


def _decimal(text: Column) -> Column:
    return text.try_cast("decimal(38,12)").cast("double")


def to_day(c: str | Column) -> Column:
    return F.try_to_date(col(c).cast("string"), "yyyy-MM-dd")


def age_years(day: str | Column, born: str | Column) -> Column:
    """Difference of the calendar years, as the feature is defined."""
    return F.year(col(day)) - F.year(col(born))


def ratio(num: str | Column, den: str | Column, default: float | None = None) -> Column:
    """num / den; a zero or missing denominator gives ``default``."""
    den = col(den).cast("double")
    value = col(num).cast("double") / F.when(den != 0, den)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def clip(c: str | Column, low: float, high: float) -> Column:
    """Clamp and keep NULL (greatest/least alone would replace it)."""
    value = col(c)
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def interval_bin(c: str | Column, edges: Sequence[float] = ERA_EDGES, outside: int = 0) -> Column:
    """Index of the right-closed interval; the first one also holds its left edge."""
    value = col(c)
    out = F.when((value >= edges[0]) & (value <= edges[1]), F.lit(0))
    for i, (left, right) in enumerate(zip(edges[1:-1], edges[2:]), start=1):
        out = out.when((value > left) & (value <= right), F.lit(i))
    return out.otherwise(F.lit(outside))


def row_min(*cols: str | Column) -> Column:
    """Smallest of several columns, missing ones skipped."""
    return F.least(*[col(c) for c in cols])


def present_flag(c: str | Column) -> Column:
    return col(c).isNotNull().cast("int")


def flag(condition: Column) -> Column:
    """Condition as 0/1, unknown as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def concat_key(*cols: str | Column) -> Column:
    return F.concat_ws("_", *[col(c).cast("bigint").cast("string") for c in cols])


def null_if(c: str | Column, value: float = 0) -> Column:
    return F.when(col(c) != F.lit(value), col(c))


def finite(c: str | Column) -> Column:
    """True for a number that is neither NaN nor infinite; false for NULL."""
    value = col(c)
    return (value.isNotNull() & ~F.isnan(value)
            & (F.abs(value) != F.lit(float("inf"))))


def finite_or_null(c: str | Column) -> Column:
    return F.when(finite(c), col(c))


def ms_to_min(c: str | Column) -> Column:
    return col(c) / F.lit(60000.0)


def hash_order(*cols: str | Column, seed: int = 42) -> Column:
    """A reproducible random order: independent of partitioning and of the engine."""
    parts = [col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def error_columns(pred: str, true: str, suffix: str) -> dict[str, Column]:
    err = F.col(pred) - F.col(true)
    return {f"err_{suffix}": err, f"abs_err_{suffix}": F.abs(err)}
