"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str, *columns: str | Column) -> DataFrame:
    """Table ``name`` of ``folder``, with only ``columns`` if any are named."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def utc(df: DataFrame, column: str) -> Column:
    """``column`` as UTC wall-clock time whatever the session time zone is."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.col(column).cast("timestamp_ntz")
    return F.to_utc_timestamp(F.col(column), F.current_timezone())


def unix_second(df: DataFrame, column: str) -> Column:
    """Whole Unix seconds of ``column``, read as UTC where it has no zone."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', date_trunc('SECOND', `{column}`))").cast("bigint")
    return F.unix_seconds(F.col(column))


def unix_micro(df: DataFrame, column: str) -> Column:
    """Unix microseconds of ``column``, read as UTC where it has no zone."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{column}`)").cast("bigint")
    return F.unix_micros(F.col(column))
