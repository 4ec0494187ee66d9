from datetime import datetime, timedelta

from __spark_entry__ import queries
from shelfspark.streaming import feeds as S

START = datetime(2025, 1, 1)


def stream(spark, tmp_path, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}.parquet")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")


def test_late_events_are_dropped_once_their_window_is_closed(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    events = stream(spark, tmp_path, [[("a", at(0)), ("a", at(1))], [("a", at(50))], [("a", at(51))], [("a", at(0.5)), ("a", at(52))], [("a", at(100))]], "k string, ts timestamp")
    out = S.run_to_end(S.window_counts(events, "ts", ["k"], "1 hour", late="2 hours"), "late", "append")
    counts = {r["window_start"]: r["events"] for r in out.collect()}
    assert counts[at(0)] == 1 and counts[at(1)] == 1 and counts[at(50)] == 1


def test_repeats_and_control_records(spark, tmp_path):
    rows = stream(spark, tmp_path, [[('{"type": "warmup"}',), ('{"v": 1}',)], [('{"v": 1}',), ('{"v": 2}',), ('{"type": "flush"}',)]], "value string")
    out = S.run_to_end(S.without_repeats(S.data_records(rows), ["value"]), "repeats")
    assert sorted(r[0] for r in out.collect()) == ['{"v": 1}', '{"v": 2}']


def test_file_counts_and_late_rows(spark, tmp_path):
    rows = stream(spark, tmp_path, [[("f", False), ("f", False), ("g", False)], [("f", False), ("f", True)], [("f", False)]], "file_name string, is_end boolean")
    out = S.run_to_end(S.file_counts(rows), "counts")
    assert sorted(tuple(r) for r in out.collect()) == [("f", 1, True), ("f", 3, False)]


def test_marker_amid_many_rows_of_its_trigger(spark, tmp_path):
    many = [("f", True)] + [("f", False)] * 25_000
    rows = stream(spark, tmp_path, [[("f", False)], many, [("f", False), ("f", True)]], "file_name string, is_end boolean")
    out = S.run_to_end(S.file_counts(rows), "counts")
    assert sorted(tuple(r) for r in out.collect()) == [("f", 1, True), ("f", 25_001, False)]


def test_file_counts_of_a_table_of_many_files(spark, tmp_path):
    rows = [(i, START + timedelta(minutes=i), i % 7, "ab"[i % 2]) for i in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").repartition(40).write.parquet(f"{tmp_path}/events.parquet")
    out = queries()["stream_file_counts"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in out.collect()) == [("a", 200, False), ("b", 200, False)]


def test_touched_keys(spark, tmp_path):
    rows = stream(spark, tmp_path, [[(1, "x"), (1, "y")], [(2, "x")]], "k int, v string")
    seen = []
    S.refresh_touched(rows, ["k"], lambda df, n: seen.append(sorted(r[0] for r in df.collect())), f"{tmp_path}/cp")
    assert sorted(seen) == [[1], [2]]
