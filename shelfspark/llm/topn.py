"""The best items of every group, by a global sort and exact positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import numbered


def best_rows(rows: DataFrame, group: Sequence[str], item: str, score: str, tie: str) -> DataFrame:
    """One row per group and item: its highest ``score``, and the smallest ``tie`` of those.

    Two aggregations with partial results in the map tasks, so repeated items
    cost no more than one row per task. A null score or item never counts; a
    null ``tie`` comes after all others.
    """
    known = rows.filter(F.col(score).isNotNull() & F.col(item).isNotNull())
    order = F.struct((-F.col(score)).alias("s"), F.col(tie).isNull().alias("n"), F.col(tie).alias("t"))
    best = known.groupBy(*group, item).agg(F.min(order).alias("best_"))
    return best.select(*group, item, (-F.col("best_.s")).alias(score), F.col("best_.t").alias(tie))


def top_positions(rows: DataFrame, group: Sequence[str], order: Sequence[Column], most: int, partitions: int | None = None) -> DataFrame:
    """``rows`` with ``position`` in their group, those up to ``most``.

    All rows are range-partitioned and sorted by group and ``order``, which
    spreads a group of any size over as many partitions as it needs. Each
    partition numbers the rows of its groups and drops those past ``most`` (a
    row's place within a partition is never behind its place in the group).
    The counts of each group's earlier partitions, summed up, are then added;
    counts over ``most`` need not be exact, as all rows after them are past
    ``most`` anyway. For this at most ``most`` rows of a group and partition
    are shuffled. ``order`` must be total within a group, else equal rows come
    in any order. ``group`` must not be null.
    """
    n = partitions or max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = [*[F.col(g) for g in group], *order]
    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("part_", F.spark_partition_id())
    local = ordered.mapInArrow(numbered(group, most), T.StructType([*ordered.schema, T.StructField("local_position_", T.LongType())]))
    earlier = Window.partitionBy(*group).orderBy("part_").rangeBetween(Window.unboundedPreceding, -1)
    position = F.col("local_position_") + F.count(F.lit(1)).over(earlier)
    return local.withColumn("position", position.cast("bigint")).filter(F.col("position") <= most).drop("part_", "local_position_")


def top_items(rows: DataFrame, label: str, group: Sequence[str], item: str, score: str, tie: str, most: int) -> DataFrame:
    """cache_table, group_key, rank_no, item, tie: the ``most`` best items per group.

    Items rank by falling score, ties by the smaller item in byte order. The
    group's key is its columns joined with '|', null as ''; groups that differ
    only in this stay apart. Columns other than those named don't matter.
    """
    best = best_rows(rows, group, item, score, tie)
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in group])
    exact = F.xxhash64(*[x for c in group for x in (F.col(c).isNull(), F.col(c))])
    keyed = best.select(key.alias("group_key"), exact.alias("group_hash"), F.col(score).alias("rank_score"), F.col(item).alias("item_code"), F.col(tie).alias("promotion_id"))
    ranked = top_positions(keyed, ["group_key", "group_hash"], [F.col("rank_score").desc(), F.col("item_code")], most)
    return ranked.select(F.lit(label).alias("cache_table"), "group_key", F.col("position").alias("rank_no"), "item_code", "promotion_id")
