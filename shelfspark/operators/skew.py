"""Finding the keys that would overload one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 65_536
HOT_ROWS = 2_000_000


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    """Hash bucket of a key."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def hot_buckets(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, buckets: int = BUCKETS) -> dict[int, int]:
    """Buckets of ``keys`` that hold too many rows, with their row counts.

    A bucket is hot with more than ``hot_rows`` rows and more than three times
    the mean, so at most ``buckets / 3`` are, whatever the data's size. Only the
    key columns are read, counts are combined before the shuffle, and no more
    than ``buckets`` numbers come to the driver.
    """
    counts = df.groupBy(bucket_of(keys, buckets).alias("bucket")).count()
    large = {r["bucket"]: r["count"] for r in counts.filter(F.col("count") > hot_rows).collect()}
    if not large:
        return {}
    mean = counts.agg(F.sum("count")).first()[0] / buckets
    return {b: n for b, n in large.items() if n > 3 * mean}
