"""Relational operators that queries share: filters, deduplication, paging, filling, matching."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import running


def optional_filters(df: DataFrame, equal: Mapping[str, object | None] | None = None, prefix: Mapping[str, str | None] | None = None) -> DataFrame:
    """Rows that meet the conditions whose value is given; null and '' set no condition.

    ``equal`` compares values, ``prefix`` the beginning of a text in any case.
    Conditions left out never reach the plan, so the rest is pushed to the scan.
    """
    for column, value in (equal or {}).items():
        if value not in (None, ""):
            df = df.filter(F.col(column) == value)
    for column, value in (prefix or {}).items():
        if value:
            df = df.filter(F.startswith(F.lower(column), F.lit(value.lower())))
    return df


def valid_at(start: str, end: str, as_of: str) -> Column:
    """Whether a day lies within the bounds, both included; a null bound is open."""
    day = F.lit(as_of).cast("date")
    return F.coalesce(F.col(start) <= day, F.lit(True)) & F.coalesce(F.col(end) >= day, F.lit(True))


def matches_none(column: str, words: Sequence[str]) -> Column:
    """Whether none of ``words`` occurs in the text, in any case; true for null."""
    text = F.lower(F.coalesce(column, F.lit("")))
    return ~reduce(lambda a, b: a | b, [F.contains(text, F.lit(w.lower())) for w in words])


def has_word(column: str, word: str, letters: str = r"\p{L}") -> Column:
    """Whether ``word`` stands alone, not within a longer word; false for null."""
    return F.coalesce(F.col(column).rlike(rf"(?i)(^|[^{letters}])\Q{word}\E([^{letters}]|$)"), F.lit(False))


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order`` (SQL's DISTINCT ON); the order should be total.

    Spark limits each group before the shuffle, so hot keys send few rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_number_", F.row_number().over(w)).filter(F.col("row_number_") == 1).drop("row_number_")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int, name: str = "rank_no") -> DataFrame:
    """The first ``most`` rows of each key, numbered from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).filter(F.col(name) <= most)


def page(df: DataFrame, order: Sequence[Column], offset: int | None, limit: int | None, most: int = 200) -> DataFrame:
    """One page of a total order: offset at least 0, limit from 1 to ``most``."""
    return df.orderBy(*order).offset(max(offset or 0, 0)).limit(min(max(limit or most, 1), most))


def page_info(df: DataFrame, order: Sequence[Column], offset: int | None, limit: int | None, most: int = 200) -> DataFrame:
    """``page`` with total, has_more, next_offset (null on the last page) and previous_offset (null on the first)."""
    at, size = max(offset or 0, 0), min(max(limit or most, 1), most)
    total = df.select(F.count(F.lit(1))).scalar()
    rows = page(df, order, at, size, most).withColumn("total", total)
    more = F.col("total") > at + size
    before = F.lit(max(at - size, 0) if at else None).cast("int")
    return rows.withColumns({"has_more": more, "next_offset": F.when(more, F.lit(at + size)), "previous_offset": before})


def chosen_order(choice: str | None, orders: Mapping[str, Sequence[Column]], otherwise: Sequence[Column]) -> Sequence[Column]:
    """The order that a parameter names, ``otherwise`` for null and unknown names."""
    return orders.get(choice or "", otherwise)


def forward_fill(df: DataFrame, columns: Sequence[str], order: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Nulls replaced by the last value before them, in ``order``, within the same ``within`` values.

    A group of any size is filled by as many tasks as it has range partitions
    (see ``ranking.running``). Null is a group of its own.
    """
    return running(df, within, [F.col(c) for c in order], dict.fromkeys(columns, "last"))


def next_after(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, found: str, as_name: str) -> DataFrame:
    """Each left row with the least ``found`` of the right that is not before ``at``; null if there is none, or for a null ``at``.

    Both sides are sorted together from the latest time on, so the last right
    time passed is the next one: one scan, in as many tasks as a key has range
    partitions.
    """
    lefts = left.withColumns({"side_": F.lit(0), "time_": F.col(at), as_name: F.lit(None).cast(right.schema[found].dataType)})
    rights = right.select(*keys, F.col(found).alias("time_")).filter(F.col("time_").isNotNull()).distinct().withColumns({"side_": F.lit(1), as_name: F.col("time_")})
    both = lefts.unionByName(rights, allowMissingColumns=True)
    scanned = running(both, keys, [F.desc_nulls_first("time_"), F.desc("side_")], {as_name: "last"})
    return scanned.filter(F.col("side_") == 0).drop("side_", "time_")


def match_exclusive(left: DataFrame, right: DataFrame, key: str, at: str, found: str) -> DataFrame:
    """Each left time with the nearest later right time that no earlier left time has taken.

    Matching in the order of time is first in, first out: a right time is used
    unless no left time waits, and the n-th used one goes to the n-th left time.
    A right time is not used where the count of lefts less rights falls to a new
    least below zero. Running counts, in as many tasks as a key has range
    partitions, tell both, so the match is a join on their numbers. Unmatched
    left times have a null ``found``; null times are left out.
    """
    lefts = left.select(F.col(key).alias("key_"), F.col(at).alias("time_"), F.lit(1).alias("step_"))
    rights = right.select(F.col(key).alias("key_"), F.col(found).alias("time_"), F.lit(-1).alias("step_"))
    both = lefts.unionByName(rights).filter(F.col("time_").isNotNull())
    counted = both.withColumns({"waiting_": F.col("step_").cast("bigint"), "lefts_": (F.col("step_") == 1).cast("bigint"), "rights_": (F.col("step_") == -1).cast("bigint")})
    order = [F.asc("time_"), F.desc("step_")]
    walked = running(counted, ["key_"], order, dict.fromkeys(("waiting_", "lefts_", "rights_"), "sum"))
    # Equal rows are told apart by their counts, so that both scans see one order.
    walked = running(walked.withColumn("least_", F.col("waiting_")), ["key_"], [*order, F.asc("lefts_"), F.asc("rights_")], {"least_": "min"})
    wasted = -F.least("least_", F.lit(0))
    used = walked.filter(F.col("step_") == -1).select("key_", (F.col("rights_") - wasted).alias("number_"), F.col("time_").alias(found)).filter("number_ > 0")
    used = used.groupBy("key_", "number_").agg(F.min(found).alias(found))  # a wasted one repeats the number before it
    asked = walked.filter(F.col("step_") == 1).select("key_", F.col("lefts_").alias("number_"), F.col("time_").alias(at))
    return asked.join(used, asked["key_"].eqNullSafe(used["key_"]) & (asked["number_"] == used["number_"]), "left").select(asked["key_"].alias(key), at, found)


def nearest_ranks(df: DataFrame, group: Sequence[str], value: str, percents: Mapping[str, float]) -> DataFrame:
    """Per group its size, its greatest value, and the value at round(percent / 100 * (n - 1)) of its sorted values, for each name.

    Equal values are counted first; the counts are summed up in order by as many
    tasks as a group has range partitions. Null values are left out.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("upto_"))
    upto = running(counts, group, [F.col(value)], {"upto_": "sum"})
    totals = counts.groupBy(*[F.col(g).alias(f"{g}_of") for g in group]).agg(F.sum("upto_").alias("size_"), F.max(value).alias("greatest"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"{g}_of")) for g in group])
    wanted = lambda p: F.floor((F.col("size_") - 1) * float(p) / 100 + 0.5) + 1
    at = [F.min(F.when(F.col("upto_") >= wanted(p), F.col(value))).alias(name) for name, p in percents.items()]
    return upto.join(totals, same).groupBy(*group).agg(*at, F.first("size_").alias("group_size"), F.first("greatest").alias("greatest"))


def first_filled_in_order(column: str, order: str) -> Column:
    """Aggregate: the first value in ``order`` that is neither null nor blank."""
    return F.min_by(F.when(F.trim(column) != "", F.col(column)), F.when(F.trim(column) != "", F.col(order)))
