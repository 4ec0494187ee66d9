"""References to records that do not exist."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reference:
    """A referring column of a table, with the time of each of its records."""

    table: str
    column: str
    target: str
    rows: DataFrame
    at: Column


def parent_intervals(parents: dict[str, tuple[DataFrame, str, str]], removed: DataFrame) -> DataFrame:
    """One row per target and key: ``created_at`` if it exists, ``removed_at`` if the log lists it.

    ``parents`` maps a target to its rows, key column and creation time. A key
    that occurs twice counts from its first creation; one without a time exists
    from the beginning.
    """
    parts = [
        df.select(F.lit(target).alias("target"), F.col(key).cast("bigint").alias("key"), F.lit(True).alias("there"), F.coalesce(F.col(created).cast("timestamp"), F.lit(0).cast("timestamp")).alias("created_at"), F.lit(None).cast("timestamp").alias("removed_at"))
        for target, (df, key, created) in parents.items()
    ]
    log = removed.select(F.col("target_table").alias("target"), F.col("key_id").cast("bigint").alias("key"), F.lit(False).alias("there"), F.lit(None).cast("timestamp").alias("created_at"), F.coalesce(F.col("removed_at").cast("timestamp"), F.lit(0).cast("timestamp")).alias("removed_at"))
    every = reduce(DataFrame.unionByName, [*parts, log]).filter(F.col("key").isNotNull())
    return every.groupBy("target", "key").agg(F.bool_or("there").alias("there"), F.min("created_at").alias("created_at"), F.max("removed_at").alias("removed_at"))


def orphan_references(references: Sequence[Reference], parents: DataFrame) -> DataFrame:
    """One row per referring table, column, month and key without a valid parent.

    References are first combined to their earliest time per column, key and
    month, in the map tasks already, so that a key with a third of all rows
    costs one row per task. References and parent intervals are then
    partitioned and sorted alike and merged in one pass (a sort-merge join is
    asked for, whatever the sizes). 'late': the key exists, but was created
    after a reference of that month; 'removed': it does not exist and the log
    of deletions lists it; 'missing': neither. A null key refers to nothing; a
    null time has a null month and is never late. Empty tables give no rows.
    """
    parts = []
    for r in references:
        time = r.at
        parts.append(r.rows.select(F.lit(r.table).alias("from_table"), F.lit(r.column).alias("from_column"), F.lit(r.target).alias("target"), F.col(r.column).cast("bigint").alias("key"), time.alias("at")))
    refs = reduce(DataFrame.unionByName, parts).filter(F.col("key").isNotNull())
    month = F.date_format(F.to_utc_timestamp("at", F.current_timezone()), "yyyy-MM")
    first = refs.groupBy("from_table", "from_column", "target", "key", month.alias("month_key")).agg(F.min("at").alias("first_at"))
    joined = first.join(parents.hint("merge"), ["target", "key"], "left")
    there = F.coalesce("there", F.lit(False))
    reason = F.when(there, F.when(F.col("created_at") > F.col("first_at"), "late")).when(F.col("removed_at").isNotNull(), "removed").otherwise("missing")
    return joined.select("from_table", "from_column", "month_key", F.col("key").alias("key_id"), reason.alias("reason")).filter(F.col("reason").isNotNull())
