import pytest

from shelfspark.llm import queries
from tests.sql_check import assert_same, engine

COLUMNS = {
    "p1_found": [("id_a", "bigint"), ("id_b", "bigint")], "p3_found": [("id", "bigint"), ("field_name", "string"), ("ref_id", "bigint")],
    "p4_found": [("cache_table", "string"), ("group_key", "string"), ("rank_no", "bigint"), ("item_code", "string"), ("promotion_id", "string")],
    "p8_found": [("doc_id", "bigint"), ("item_id", "bigint")], "p10_found": [("doc_id", "bigint"), ("restored_md5", "string")],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
    if name in queries.SQL:
        assert_same(engine(data), df, queries.SQL[name])
    else:
        rows = df.collect()
        assert len(rows) == len(set(rows)) and rows
