import pytest

import __spark_entry__ as entry
from shelfspark.plans import registry
from tests.sql_check import assert_same, engine


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_its_sql(spark, data, name):
    df = registry.queries()[name](spark, data)
    if name in registry.sql():
        assert_same(engine(data), df, registry.sql()[name])
    else:
        assert df.columns and df.count() >= 0


def test_entry_points(spark, data):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())
    assert {"p2_found", "p5_found", "p6_found", "p7_found"} <= set(entry.queries())


@pytest.mark.parametrize(("name", "columns"), [
    ("p2_found", [("from_table", "string"), ("from_column", "string"), ("month_key", "string"), ("key_id", "bigint"), ("reason", "string")]),
    ("p5_found", [("product_id", "bigint"), ("store_id", "bigint"), ("valid_from", "bigint"), ("valid_to", "bigint")]),
    ("p6_found", [("product_id", "bigint"), ("store_id", "bigint"), ("at_second", "bigint"), ("base_unit", "string"), ("amount_milli", "bigint")]),
    ("p7_found", [("chain_id", "string"), ("promotion_id", "string"), ("child_kind", "string"), ("group_no", "string"), ("parent_code", "string"), ("child_key", "string")]),
])
def test_columns_of_found(spark, data, name, columns):
    assert registry.queries()[name](spark, data).dtypes == columns


def test_scans_read_only_what_they_need(spark, data):
    plan = registry.queries()["p5_found"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "unit_qty" not in plan and "price" in plan
    plan = registry.queries()["filter_is_distinct"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "item_name" not in plan


def test_top_per_key_is_limited_before_the_shuffle(spark, data):
    plan = registry.queries()["win_rank_store"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
