import json

from pyspark.sql import functions as F

from shelfspark.sources import feeds


def test_feed_is_filled_resumed_and_counted(spark, tmp_path):
    lines = ["﻿found_folder,file_name,chainid,more_data"] + ["fold,f1.csv,7,a", ",,,b", ",f2.csv,,c", ",,9,"]
    (tmp_path / "feed.csv").write_text("\n".join(lines), encoding="utf-8")
    rows = feeds.read_feed(spark, str(tmp_path / "feed.csv"))
    found = [(r["row_index"], r["found_folder"], r["file_name"], r["content"]) for r in rows.orderBy("row_index").collect()]
    assert found == [(0, "fold", "f1.csv", {"chainid": "7", "more_data": "a"}), (1, "fold", "f1.csv", {"chainid": "7", "more_data": "b"}), (2, "fold", "f2.csv", {"chainid": "7", "more_data": "c"}), (3, "fold", "f2.csv", {"chainid": "9", "more_data": "c"})]
    assert [r["row_index"] for r in feeds.read_feed(spark, str(tmp_path / "feed.csv"), after_row=2).collect()] == [3]
    ends = {r["file_name"]: (r["total_expected_records"], r["chainid"], r["storeid"]) for r in feeds.end_of_file_markers(rows).collect()}
    assert ends == {"f1.csv": (2, "7", None), "f2.csv": (2, "7", None)}


def test_ten_rows_of_ten_files(spark, tmp_path):
    text = "found_folder,file_name,more_data,some_more_data\n" + "".join(f"test_folder_{i},test_file_{i}.csv,test_data_{i},test_data_{i}\n" for i in range(10))
    (tmp_path / "ten.csv").write_text(text)
    ends = feeds.end_of_file_markers(feeds.read_feed(spark, str(tmp_path / "ten.csv")))
    assert sorted((r["file_name"], r["total_expected_records"]) for r in ends.collect()) == [(f"test_file_{i}.csv", 1) for i in range(10)]


def test_status_logs(spark, tmp_path):
    (tmp_path / "log.json").write_text(json.dumps({"20250102030405": [{"status": "started"}, {"status": "done", "n": 2}], "20250103000000": [{"status": "old"}], "verified_downloads": {"a": 1}}))
    rows = feeds.read_status_log(spark, str(tmp_path / "log.json"), seen=["20250103000000"])
    assert sorted((r["at_text"], r["entry_no"], r["status"]) for r in rows.collect()) == [("20250102030405", 0, "started"), ("20250102030405", 1, "done")]
    (tmp_path / "list.json").write_text(json.dumps([{"file_type": "A", "response": {"files_to_process": ["x", "y"]}}, {"file_type": "B", "response": {"files_to_process": ["z"]}}]))
    listed = feeds.read_status_list(spark, str(tmp_path / "list.json"))
    assert listed.select(F.explode("response.files_to_process")).count() == 3


def test_files_and_documents(spark, tmp_path):
    for n in ("b.csv", "a.csv", "xstore.csv", "note.txt"):
        (tmp_path / n).write_text("h\n1\n")
    assert [r["file_name"] for r in feeds.list_files(spark, str(tmp_path), "*.csv").collect()] == ["xstore.csv", "a.csv", "b.csv"]
    assert feeds.read_by_ending(spark, str(tmp_path / "a.csv")).collect()[0]["h"] == "1"
    assert feeds.read_by_ending(spark, str(tmp_path / "note.txt")).count() == 2
    docs = spark.createDataFrame([("PRICE@a@1", "csv"), ("STORE@a@2", "csv"), ("xPRICE@b", "json")], "name string, kind string")
    assert feeds.find_documents(docs, {"name": {"$regex": "PRICE.*"}, "kind": "csv"}).count() == 1
    assert feeds.find_documents(docs).count() == 3
    assert feeds.array_argument(spark, '[{"a": 1, "b": "x"}, {"a": 2}]', "a int, b string").collect() == [(1, "x"), (2, None)]
    assert feeds.unseen_files(docs.select(F.col("name").alias("file_name")), spark.createDataFrame([("PRICE@a@1",)], "file_name string")).count() == 2
