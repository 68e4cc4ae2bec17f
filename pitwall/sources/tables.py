"""Readers and writers of the named tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.functions.scalars import missing_to_null
from pitwall.operators.contracts import require_rows

# Columns and types of the raw files that are read.
RAW_SCHEMAS = {
    "results": "raceId bigint, driverId bigint, constructorId bigint, grid bigint, points double, "
               "milliseconds double, statusId bigint, laps bigint, positionOrder bigint, fastestLapSpeed double",
    "races": "raceId bigint, year bigint, round bigint, circuitId bigint, date string",
    "drivers": "driverId bigint, driverRef string, nationality string, dob string",
    "constructors": "constructorId bigint, name string",
    "circuits": "circuitId bigint, country string, lat double, lng double, alt double",
    "qualifying": "raceId bigint, driverId bigint, position bigint, q1 string, q2 string, q3 string",
    "driver_standings": "raceId bigint, driverId bigint, points double, position bigint, wins bigint",
    "constructor_standings": "raceId bigint, constructorId bigint, points double, position bigint, wins bigint",
}


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to their types; missing spellings and bad cells become NULL."""
    return text.select(*[_cell(schema[f]).alias(f) for f in text.columns])


def _cell(field: T.StructField):
    cell = missing_to_null(field.name)
    if isinstance(field.dataType, T.IntegralType):  # '3.0' is a whole number, too
        whole = cell.try_cast(field.dataType)
        return F.coalesce(whole, cell.try_cast("double").try_cast(field.dataType))
    return cell if isinstance(field.dataType, T.StringType) else cell.try_cast(field.dataType)


def read_raw(spark: SparkSession, path: str, schema: str | T.StructType,
             encoding: str = "ISO-8859-1", *, quoted: bool = False, typed: bool = True) -> DataFrame:
    """CSV with a header, columns found by name.

    Cells are read as text first, so one bad cell costs a NULL, not a row.
    ``quoted`` reads cells with line breaks and keeps the blanks around text; files
    that need it cannot be split, so it is for files written in parts.
    """
    schema = _schema(schema)
    how = {"header": True, "encoding": encoding, "escape": '"', "multiLine": quoted,
           "ignoreLeadingWhiteSpace": not quoted, "ignoreTrailingWhiteSpace": not quoted}
    header = spark.read.csv(path, enforceSchema=False, **how)
    text = spark.read.csv(
        path, nullValue="\\N", **how,
        schema=T.StructType([T.StructField(c, T.StringType()) for c in header.columns]))
    text = text.select(*[f.name for f in schema])
    return _typed(text, schema) if typed else text


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_raw(spark, f"{folder}/{name}.csv", RAW_SCHEMAS[name])


def read_own_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One of our own CSV outputs: UTF-8, a byte order mark is tolerated.  Text comes
    back as it was written, line breaks, blanks and empty text included."""
    schema = _schema(schema)
    raw = read_raw(spark, path, T.StructType([T.StructField(f.name, T.StringType()) for f in schema]), "UTF-8", quoted=True, typed=False)
    return raw.select(*[(F.col(f.name) if isinstance(f.dataType, T.StringType) else _cell(f)).alias(f.name) for f in schema])


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", bom: bool = False) -> None:
    """CSV with a header.  ``bom`` marks the file as UTF-8 for spreadsheet
    programs by a mark before the first header name, where no quote may stand; then
    only cells that need it are quoted."""
    out = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0]) if bom else df
    out.write.mode("overwrite").csv(path, header=True, encoding=encoding, nullValue="\\N", emptyValue='""' if bom else "", quoteAll=not bom,
                                    escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """The preferred sink; facts are partitioned by year for pruning."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json_summary(spark: SparkSession, path: str, schema: str | T.StructType,
                      flatten: bool = True) -> DataFrame:
    """Nested summary document; flattened, names become ``outer.inner`` joined by '_'."""
    schema = _schema(schema)
    doc = spark.read.schema(schema).json(path)
    if not flatten:
        return doc
    out = []
    for f in schema:
        if isinstance(f.dataType, T.StructType):
            out += [F.col(f"{f.name}.{g.name}").alias(f"{f.name}_{g.name}") for g in f.dataType]
        else:
            out.append(F.col(f.name))
    return doc.select(*out)


def register(tables: Mapping[str, DataFrame]) -> None:
    """Offer named tables to SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def load_checked(df: DataFrame, what: str = "table") -> DataFrame:
    """The table itself, after a check that it has rows."""
    return require_rows(df, what)
