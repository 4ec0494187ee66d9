from datetime import datetime

from pyspark.sql import functions as F

from shelfspark.operators.orphans import Reference, orphan_references, parent_intervals


def day(m, d=1):
    return datetime(2025, m, d)


def run(spark, refs, parents, removed):
    r = spark.createDataFrame(refs, "k long, at timestamp, target string, reason string")
    p = spark.createDataFrame(parents, "id long, created_at timestamp")
    g = spark.createDataFrame(removed, "target_table string, key_id long, removed_at timestamp")
    found = orphan_references([Reference("t", "k", "things", r, F.col("at"))], parent_intervals({"things": (p, "id", "created_at")}, g))
    return sorted(tuple(x) for x in found.select("month_key", "key_id", "reason").collect())


def test_reasons(spark):
    refs = [(1, day(3), "", ""), (2, day(3), "", ""), (3, day(3), "", ""), (3, day(3), "", ""), (3, day(4), "", ""), (4, day(1, 31), "", ""), (4, day(2, 20), "", ""), (5, day(2), "", ""), (None, day(2), "", "")]
    parents = [(1, day(1)), (4, day(2, 10)), (5, day(1)), (5, day(3)), (None, day(1)), (6, None)]
    removed = [("things", 2, day(2)), ("things", 1, day(2)), ("others", 3, day(1)), ("things", None, day(1))]
    assert run(spark, refs, parents, removed) == [("2025-01", 4, "late"), ("2025-03", 2, "removed"), ("2025-03", 3, "missing"), ("2025-04", 3, "missing")]


def test_one_late_record_in_a_month_is_enough(spark):
    assert run(spark, [(1, day(3, 20), "", ""), (1, day(3, 2), "", "")], [(1, day(3, 10))], []) == [("2025-03", 1, "late")]


def test_empty_tables_and_null_times(spark):
    assert run(spark, [], [], []) == []
    assert run(spark, [(1, day(3), "", "")], [], []) == [("2025-03", 1, "missing")]
    found = orphan_references(
        [Reference("t", "k", "things", spark.createDataFrame([(1, None), (2, None)], "k long, at timestamp"), F.col("at"))],
        parent_intervals({"things": (spark.createDataFrame([(1, None)], "id long, created_at timestamp"), "id", "created_at")}, spark.createDataFrame([], "target_table string, key_id long, removed_at timestamp")),
    )
    assert [tuple(r) for r in found.select("month_key", "key_id", "reason").collect()] == [(None, 2, "missing")]


def test_plan_merges_sorted_streams(spark):
    r = spark.createDataFrame([(1, day(3))], "k long, at timestamp")
    found = orphan_references([Reference("t", "k", "things", r, F.col("at"))], parent_intervals({"things": (spark.createDataFrame([(1, day(1))], "id long, created_at timestamp"), "id", "created_at")}, spark.createDataFrame([], "target_table string, key_id long, removed_at timestamp")))
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
