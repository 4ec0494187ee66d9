"""History of changing attributes: type-two dimension tables.

``history`` builds versions from all snapshots, ``merge_history`` carries an
existing history on with later snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import BUCKETS, HOT_ROWS, bucket_of, hot_buckets

OPEN = -1


def attribute_hash(attributes: Sequence[str]) -> Column:
    """64-bit hash in which null is a value of its own at each place."""
    parts = [x for a in attributes for x in (F.col(a).isNull(), F.col(a))]
    return F.xxhash64(*parts)


def _versions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From (keys, at, hash, ...) the rows that begin a version, closed by the next one."""
    w = Window.partitionBy(*keys).orderBy("at", "hash")
    begun = df.withColumn("before", F.lag("hash").over(w)).filter(F.col("before").isNull() | (F.col("before") != F.col("hash")))
    return begun.withColumn("valid_to", F.lead("at", 1, OPEN).over(w)).drop("before")


def _slices(hot: DataFrame, counts: dict[int, int], hot_rows: int) -> DataFrame:
    """``hot`` with a slice of time per row, of about ``hot_rows`` rows in its bucket.

    A bucket's time span is cut into equal cells, at least 16 per slice; rows
    per cell are counted and their prefix sums join cells to slices. At most
    2,000 slices are made over all buckets, so no more than 32,000 cells and 16
    for each bucket are broadcast.
    """
    spark = hot.sparkSession
    rows = max(hot_rows, sum(counts.values()) // 2000)
    cells = spark.createDataFrame([(b, 16 * (1 + n // rows)) for b, n in counts.items()], "bucket int, cells long")
    spans = hot.groupBy("bucket").agg(F.min("at").alias("low"), F.max("at").alias("high")).join(F.broadcast(cells), "bucket")
    span = F.col("high") - F.col("low") + 1
    celled = hot.join(F.broadcast(spans), "bucket").withColumn("cell", F.floor((F.col("at") - F.col("low")).cast("double") / span * F.col("cells"))).drop("low", "high", "cells")
    w = Window.partitionBy("bucket").orderBy("cell")
    sliced = celled.groupBy("bucket", "cell").count().select("bucket", "cell", F.floor((F.sum("count").over(w) - F.col("count")) / rows).alias("slice"))
    return celled.join(F.broadcast(sliced), ["bucket", "cell"]).drop("bucket", "cell")


def _sliced_versions(cut: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_versions`` for keys of very many rows, by slices of time.

    Each slice is compared within itself; then only one row per key and slice
    is compared with the slice before, and closed by the slices after.
    """
    w = Window.partitionBy(*keys, "slice").orderBy("at", "hash")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inner = (
        cut.withColumn("before", F.lag("hash").over(w))
        .withColumn("last_hash", F.last("hash").over(whole))
        .filter(F.col("before").isNull() | (F.col("before") != F.col("hash")))
    )
    over = Window.partitionBy(*keys).orderBy("slice")
    heads = inner.filter(F.col("before").isNull()).withColumn("earlier", F.lag("last_hash").over(over))
    heads = heads.filter(F.col("earlier").isNull() | (F.col("earlier") != F.col("hash"))).drop("earlier")
    begun = inner.filter(F.col("before").isNotNull()).unionByName(heads).drop("before", "last_hash")
    nexts = begun.groupBy(*keys, "slice").agg(F.min("at").alias("first_at")).withColumn("later", F.lead("first_at", 1, OPEN).over(over)).drop("first_at")
    same = reduce(lambda a, b: a & b, [F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}")) for k in [*keys, "slice"]])
    return (
        begun.withColumn("inside", F.lead("at").over(w)).alias("b")
        .join(nexts.alias("n"), same)
        .select("b.*", F.coalesce("b.inside", "n.later").alias("valid_to"))
        .drop("inside", "slice")
    )


def history(snapshots: DataFrame, keys: Sequence[str], at: Column, attributes: Sequence[str], hot_rows: int = HOT_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """Versions of ``attributes`` per key: ``valid_from`` and ``valid_to``.

    A version is a longest run of snapshots, ordered by ``at``, with equal
    attributes (null equals null); it ends where the next begins, or at -1.
    Rows with a null ``at`` say nothing about time and are left out; a null in
    a key is a key of its own. Exact repeats change nothing. Where snapshots of
    one key and time differ, each distinct one counts, in the order of its
    attribute hash. No rows give no versions; other columns are dropped.

    Keys whose bucket is hot (see ``skew.hot_buckets``) are handled by slices
    of time of about ``hot_rows`` rows, so no task gets a whole hot key.
    """
    names = [f"k{i}" for i in range(len(keys))]
    values = [f"a{i}" for i in range(len(attributes))]
    rows = snapshots.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        at.cast("bigint").alias("at"),
        *[F.col(a).alias(v) for a, v in zip(attributes, values)],
    ).filter(F.col("at").isNotNull())
    hot = hot_buckets(rows, names, hot_rows, buckets)
    if hot:
        hashed = rows.withColumn("hash", attribute_hash(values)).withColumn("bucket", bucket_of(names, buckets))
        listed = F.broadcast(snapshots.sparkSession.createDataFrame([(b,) for b in hot], "bucket int"))
        busy = hashed.join(listed, "bucket", "left_semi").dropDuplicates([*names, "at", "hash"])
        tables = [_versions(hashed.join(listed, "bucket", "left_anti").drop("bucket"), names), _sliced_versions(_slices(busy, hot, hot_rows), names)]
        done = reduce(DataFrame.unionByName, tables)
    else:
        done = _versions(rows.withColumn("hash", attribute_hash(values)), names)
    return done.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names)],
        *[F.col(v).alias(a) for a, v in zip(attributes, values)],
        F.col("at").alias("valid_from"),
        F.col("valid_to").cast("bigint").alias("valid_to"),
    )


def merge_history(current: DataFrame, updates: DataFrame, keys: Sequence[str], at: Column, attributes: Sequence[str], hot_rows: int = HOT_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """Carry a history on with further snapshots.

    The hash of each snapshot is compared with the version that holds at its
    time: where it differs, that version is closed and a new one inserted. Only
    the open version (``valid_to`` -1) of a key takes part, as one more snapshot
    at its ``valid_from``, while its closed versions pass unchanged; but where
    a key has late snapshots, from before its last closed version ended, all of
    its versions are opened again, so no snapshot is dropped. A version keeps
    no snapshots that confirmed it, so a late one that differs holds until the
    next version. Nulls, repeats and hot keys are handled as in ``history``.
    """
    columns = [*keys, *attributes, "valid_from", "valid_to"]
    same = lambda a, b: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])
    held = current.select(*columns)
    new = updates.select(*keys, at.cast("bigint").alias("at_"), *attributes).filter(F.col("at_").isNotNull())
    first = new.groupBy(*keys).agg(F.min("at_").alias("first_"))
    settled = held.filter(F.col("valid_to") != OPEN).groupBy(*keys).agg(F.max("valid_to").alias("settled_"))
    late = first.join(settled, same(first, settled)).filter("first_ < settled_").select(*[first[k] for k in keys])
    reopened = (F.col("valid_to") == OPEN) | F.col("late_")
    late = late.select(*[F.col(k).alias(f"{k}_late") for k in keys], F.lit(True).alias("late_"))
    is_late = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_late")) for k in keys])
    marked = held.join(late, is_late, "left").withColumn("late_", F.coalesce("late_", F.lit(False)))
    snapshots = marked.filter(reopened).select(*keys, F.col("valid_from").alias("at_"), *attributes).unionByName(new)
    return marked.filter(~reopened).select(*columns).unionByName(history(snapshots, keys, F.col("at_"), attributes, hot_rows, buckets))
