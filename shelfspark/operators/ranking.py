"""Positions within groups of any size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checkpoints import materialise


def _beginnings(keys: Sequence[pa.Array], n: int) -> np.ndarray:
    """Which rows after the first differ in a key from the row before."""
    begins = np.zeros(n, dtype=bool)
    for k in keys if n > 1 else []:
        same = pc.fill_null(pc.equal(k.slice(1), k.slice(0, n - 1)), False)
        both_null = pc.and_(k.slice(1).is_null(), k.slice(0, n - 1).is_null())
        begins[1:] |= ~pc.or_(same, both_null).to_numpy(zero_copy_only=False)
    return begins


def numbered(group: Sequence[str], most: int | None = None):
    """For ``mapInArrow``: numbers the rows of each group in a sorted partition, and keeps the first ``most``."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(g) for g in group]
            begins = _beginnings(keys, n)
            begins[0] = [k[0].as_py() for k in keys] != last
            starts = np.where(begins, np.arange(n), 0)
            np.maximum.accumulate(starts, out=starts)
            place = np.arange(1, n + 1) - starts
            if not begins[0]:
                place[: int(np.argmax(begins)) or n] += count
            last, count = [k[n - 1].as_py() for k in keys], int(place[-1])
            out = batch.append_column("local_position_", pa.array(place, pa.int64()))
            yield out if most is None else out.filter(pa.array(place <= most))

    return number


def rank_all(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "position", partitions: int | None = None) -> DataFrame:
    """Every row with its place in its group, from 1, in ``order`` (which should be total).

    All rows are range-partitioned and sorted by group and order, so a group
    with a third of all rows takes a third of the partitions. Each partition
    numbers its rows; the counts of a group's earlier partitions are summed up
    and added. Only groups that span partitions have such counts, so no more
    rows than partitions are broadcast. The sorted rows are written to the
    shared folder in between, so both steps see the same partitions. Null is a
    group of its own; no rows give no rows.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(g) for g in group], *order]
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("part_", F.spark_partition_id())
    placed = materialise(ordered.mapInArrow(numbered(group), T.StructType([*ordered.schema, T.StructField("local_position_", T.LongType())])), "ranked")
    counts = placed.groupBy(*group, "part_").agg(F.max("local_position_").alias("count_"))
    earlier = Window.partitionBy(*group).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before_", F.sum("count_").over(earlier)).filter("before_ > 0").select(*[F.col(g).alias(f"{g}_") for g in group], F.col("part_").alias("part__"), "before_")
    same = F.col("part_") == F.col("part__")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_"))
    joined = placed.join(F.broadcast(offsets), same, "left")
    return joined.select(*df.columns, (F.col("local_position_") + F.coalesce("before_", F.lit(0))).alias(name))


def _scan_locally(group: Sequence[str], kinds: dict[str, str]):
    """For ``mapInArrow``: running values within the groups of a sorted partition, and each row's number there."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried, count = None, {}, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            begins = _beginnings([batch.column(g) for g in group], n)
            keys = [batch.column(g)[0].as_py() for g in group]
            begins[0] = keys != last
            starts = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
            head = 0 if begins[0] else int(np.argmax(begins)) or n  # rows that go on with the group of the batch before
            place = np.arange(1, n + 1) - starts
            place[:head] += count
            arrays, names = list(batch.columns), list(batch.schema.names)
            for name, kind in kinds.items():
                column = arrays[names.index(name)]
                if kind == "last":
                    valid = np.asarray(column.is_valid())
                    at = np.maximum.accumulate(np.where(valid, np.arange(n), -1))
                    found = column.take(pa.array(at, mask=at < starts))
                    if head and carried.get(name) is not None:
                        found = pa.concat_arrays([pc.fill_null(found.slice(0, head), pa.scalar(carried[name], column.type)), found.slice(head)])
                    carried[name] = found[n - 1].as_py()
                else:
                    values = pd.Series(column.to_numpy(zero_copy_only=False)).groupby(np.cumsum(begins))
                    done = (values.cumsum() if kind == "sum" else values.cummin()).to_numpy()
                    if head and name in carried:
                        done[:head] = done[:head] + carried[name] if kind == "sum" else np.minimum(done[:head], carried[name])
                    carried[name], found = int(done[-1]), pa.array(done, column.type)
                arrays[names.index(name)] = found
            last, count = [batch.column(g)[n - 1].as_py() for g in group], int(place[-1])
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(place, pa.int64())], names=[*names, "local_position_"])

    return scan


def running(df: DataFrame, group: Sequence[str], order: Sequence[Column], kinds: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Columns replaced by their running values in ``order`` within a group of any size.

    ``kinds``: "last" (the last value so far that is not null), or "sum" or
    "min" of whole numbers without nulls. As in ``rank_all``, a group with a
    third of all rows takes a third of the partitions: each partition is scanned
    once, and what groups that span partitions bring along from earlier ones, at
    most one row per partition, is broadcast. Null is a group of its own.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(g) for g in group], *order]
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("part_", F.spark_partition_id())
    schema = T.StructType([*ordered.schema, T.StructField("local_position_", T.LongType())])
    scanned = materialise(ordered.mapInArrow(_scan_locally(group, kinds), schema), "scanned")
    ends = scanned.groupBy(*group, "part_").agg(*[F.min(c).alias(c) if k == "min" else F.max_by(c, "local_position_").alias(c) for c, k in kinds.items()])
    earlier = Window.partitionBy(*group).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    over = {"last": lambda c: F.last(c, ignorenulls=True), "sum": F.sum, "min": F.min}
    brought = ends.withColumns({f"{c}_before_": over[k](c).over(earlier) for c, k in kinds.items()} | {"parts_": F.count(F.lit(1)).over(earlier)})
    brought = brought.filter("parts_ > 0").select(*[F.col(g).alias(f"{g}__") for g in group], F.col("part_").alias("part__"), *[f"{c}_before_" for c in kinds])
    same = F.col("part_") == F.col("part__")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}__"))
    add = {"last": lambda c: F.coalesce(c, f"{c}_before_"), "sum": lambda c: F.col(c) + F.coalesce(f"{c}_before_", F.lit(0)), "min": lambda c: F.least(c, f"{c}_before_")}
    joined = scanned.join(F.broadcast(brought), same, "left")
    return joined.select(*[add[kinds[c]](c).alias(c) if c in kinds else F.col(c) for c in df.columns])
