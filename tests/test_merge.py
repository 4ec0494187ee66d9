from pyspark.sql import functions as F

from shelfspark.operators import folding, merge


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_keeps_creation_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 1)], "k int, v string, created_at int")
    new = spark.createDataFrame([(2, "B", 99), (3, "c", 30), (3, "c", 30)], "k int, v string, created_at int")
    once = merge.upsert(old, new, ["k"])
    assert rows(once) == sorted([(1, "a", 10), (2, "B", 20), (3, "c", 30), (None, "n", 1)], key=str)
    assert rows(merge.upsert(once, new, ["k"])) == rows(once)
    assert rows(merge.upsert(old, new.limit(0), ["k"])) == rows(old)
    assert rows(merge.upsert(old.limit(0), new, ["k"])) == [(2, "B", 99), (3, "c", 30)]


def test_insert_update_delete(spark):
    old = spark.createDataFrame([(1, True, 0), (2, None, 0)], "k int, flag boolean, updated_at int")
    new = spark.createDataFrame([(2, False, 5), (4, True, 5)], "k int, flag boolean, updated_at int")
    assert rows(merge.insert_ignore(old, new, ["k"])) == [(1, True, 0), (2, None, 0), (4, True, 5)]
    changed = merge.update_where_distinct(old, spark.createDataFrame([(1, True), (2, None)], "k int, flag boolean"), ["k"], "flag", F.lit(9))
    assert rows(changed) == [(1, True, 0), (2, None, 0)]
    changed = merge.update_where_distinct(old, spark.createDataFrame([(1, None), (2, False)], "k int, flag boolean"), ["k"], "flag", F.lit(9))
    assert rows(changed) == [(1, None, 9), (2, False, 9)]
    stays, goes = merge.delete_where(old, F.col("flag"))
    assert rows(stays) == [(2, None, 0)] and goes.count() == 1


def test_parents_lookup_and_routes(spark):
    parents = spark.createDataFrame([(1, "a")], "k int, name string")
    refs = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    assert rows(merge.with_missing_parents(parents, refs, ["k"])) == [(1, "a"), (2, None)]
    hit, miss = merge.split_by_lookup(refs, parents.withColumnRenamed("name", "found"), ["k"], "found")
    assert hit.count() == 1 and miss.count() == 3
    routed = merge.route(spark.createDataFrame([("PriceFull_1",), ("store_2",), ("other",)], "f string"), "f", {"price": "prices", "store": "stores"})
    assert {d: [r[0] for r in df.collect()] for d, df in routed.items()} == {"prices": ["PriceFull_1"], "stores": ["store_2"], "": ["other"]}


def test_partitions_and_snapshots(spark, tmp_path):
    table = f"{tmp_path}/t"
    merge.replace_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "c string, v int"), table, ["c"])
    merge.replace_partitions(spark.createDataFrame([("b", 3)], "c string, v int"), table, ["c"])
    assert rows(spark.read.parquet(table).select("c", "v")) == [("a", 1), ("b", 3)]
    root = f"{tmp_path}/s"
    assert merge.publish_snapshot(spark.range(2), root, "t1") == 1
    assert merge.publish_snapshot(spark.range(5), root, "t2") == 2
    assert merge.snapshot_index(spark, root) == {"1": "t1", "2": "t2"}
    assert merge.read_snapshot(spark, root).count() == 5 and merge.read_snapshot(spark, root, 1).count() == 2


def test_folding(spark):
    df = spark.createDataFrame([("k", 1, "", None, {"a": "1"}, ["x", None]), ("k", 2, "v", True, {"a": "2", "b": "3"}, ["y", "x"]), ("k", 3, "w", False, None, None), ("e", 1, None, None, None, None)], "k string, i int, s string, f boolean, m map<string,string>, a array<string>")
    found = {r["k"]: r for r in folding.fold_rows(df, ["k"], "i", ["s"], ["f"], ["m"], ["a"]).collect()}
    assert (found["k"]["s"], found["k"]["f"], found["k"]["m"], found["k"]["a"], found["k"]["folded_rows"]) == ("v", True, {"a": "2", "b": "3"}, ["x", "y"], 3)
    assert (found["e"]["s"], found["e"]["f"], found["e"]["m"]) == (None, False, None)
    maps = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3"}), (None, {"c": "4"}), ({"d": "5"}, None)], "l map<string,string>, r map<string,string>")
    assert [r[0] for r in maps.select(folding.map_concat_right(F.col("l"), F.col("r"))).collect()] == [{"a": "1", "b": "3"}, {"c": "4"}, {"d": "5"}]


def test_merge_items_keeps_order_and_incoming_wins(spark):
    old = spark.createDataFrame([("k", '[{"itemcode":"1","v":1},{"itemcode":"2","v":1}]'), ("n", "[]"), ("o", '[{"itemcode":"9"}]')], "k string, items string")
    new = spark.createDataFrame([("k", '[{"ItemCode":"3"},{"itemCode":"2","v":2}]'), ("n", '[{"itemcode":"5"}]'), ("x", None)], "k string, items string")
    found = {r["k"]: r["items"] for r in folding.merge_items(old, new, ["k"]).collect()}
    assert found["k"] == '[{"itemcode":"1","v":1},{"ItemCode":"3"},{"itemCode":"2","v":2}]'
    assert found["n"] == '[{"itemcode":"5"}]' and found["o"] == '[{"itemcode":"9"}]' and found["x"] == "[]"


def test_lenient_json(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{'a': None, 'b': (1, 2)}",), ("{'a': true}",), ("nothing {",), (None,), (" ",)], "v string")
    assert [r[0] for r in df.select(folding.lenient_json("v")).collect()] == ['{"a": 1}', '{"a": null, "b": [1, 2]}', '{"a": true}', None, None, None]
