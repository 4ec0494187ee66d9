"""Feeds and files: parsed CSV feeds, status logs, document folders and data set listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = ("found_folder", "file_name")


def read_feed(spark: SparkSession, path: str, after_row: int = -1, fill_within_file: bool = False) -> DataFrame:
    """Rows of a CSV feed as documents: row_index, found_folder, file_name, content.

    All columns are text. Sparse cells take the value of the row before, over
    the whole feed or within each file name. Rows up to ``after_row`` were read
    before and are left out, after filling. A byte-order mark is dropped; a
    repeated heading line is not. Empty files give no rows.

    Filling needs a feed's rows in their order, so each input file is numbered
    and filled by one task; feeds come as many files.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8").option("multiLine", True).csv(path)
    names = [c.lstrip("﻿") for c in raw.columns]
    raw = raw.toDF(*names).withColumns({"input_": F.input_file_name(), "place_": F.monotonically_increasing_id()})
    by_file = Window.partitionBy("input_").orderBy("place_")
    rows = raw.withColumn("row_index", (F.row_number().over(by_file) - 1).cast("bigint"))
    keys = ["input_", *(["file_name"] if fill_within_file and "file_name" in names else [])]
    filled = Window.partitionBy(*keys).orderBy("row_index").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({c: F.last(c, ignorenulls=True).over(filled) for c in names if c not in keys})
    payload = [c for c in names if c not in ENVELOPE]
    content = F.map_filter(F.create_map(*[x for c in payload for x in (F.lit(c), F.col(c))]), lambda k, v: v.isNotNull()) if payload else F.create_map().cast("map<string,string>")
    envelope = [F.col(c) if c in names else F.lit(None).cast("string").alias(c) for c in ENVELOPE]
    return rows.filter(F.col("row_index") > after_row).select("row_index", *envelope, content.alias("content"))


def end_of_file_markers(documents: DataFrame, identifiers: Sequence[str] = ("chainid", "storeid", "storename", "chainname")) -> DataFrame:
    """One marker per file: its number of rows and the first value of each identifier, whatever the key's case."""
    from ..functions.clean import ci_element

    ids = [F.min_by(ci_element("content", i), F.when(ci_element("content", i).isNotNull(), F.col("row_index"))).alias(i) for i in identifiers]
    return documents.groupBy("file_name").agg(F.count(F.lit(1)).alias("total_expected_records"), *ids).withColumn("file_complete", F.lit(True))


def read_status_list(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON array of status objects, one row each."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_status_log(spark: SparkSession, path: str, skip: Sequence[str] = ("verified_downloads",), seen: Sequence[str] = ()) -> DataFrame:
    """A JSON object of times to lists of statuses, as rows: at_text, at, entry_no, status, payload (JSON).

    Keys of ``skip`` are no times; those of ``seen`` were read before.
    """
    text = spark.read.text(path, wholetext=True)
    lists = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("at_text", "listed")).filter(~F.col("at_text").isin(*skip, *seen))
    rows = lists.select("at_text", F.posexplode(F.from_json("listed", "array<string>")).alias("entry_no", "payload"))
    return rows.select("at_text", F.try_to_timestamp("at_text", F.lit("yyyyMMddHHmmss")).alias("at"), F.col("entry_no").cast("bigint"), F.get_json_object("payload", "$.status").alias("status"), "payload")


def list_files(spark: SparkSession, path: str, pattern: str = "*", first: str = "store") -> DataFrame:
    """Files of a folder by name, those whose name holds ``first`` before the rest; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")
    named = files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    return named.orderBy(~F.contains(F.lower("file_name"), F.lit(first)), "file_name")


def read_by_ending(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder by its ending: csv with heading, json, parquet, or lines of text."""
    ending = path.rsplit(".", 1)[-1].lower()
    if ending == "csv":
        return spark.read.option("header", True).csv(path)
    if ending == "json":
        return spark.read.option("multiLine", True).json(path)
    return spark.read.parquet(path) if ending == "parquet" else spark.read.text(path)


def find_documents(documents: DataFrame, where: Mapping[str, object] | None = None) -> DataFrame:
    """Documents that meet every condition: a value to equal, or {"$regex": pattern} to match at the beginning."""
    for column, wanted in (where or {}).items():
        if isinstance(wanted, Mapping):
            documents = documents.filter(F.col(column).rlike(f"^(?:{wanted['$regex']})"))
        else:
            documents = documents.filter(F.col(column) == wanted)
    return documents


def array_argument(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """A JSON array given as an argument, as rows of ``schema``."""
    one = spark.createDataFrame([(text,)], "value string")
    return one.select(F.explode(F.from_json("value", f"array<struct<{schema}>>")).alias("r")).select("r.*")


def unseen_files(names: DataFrame, ledger: DataFrame, column: str = "file_name") -> DataFrame:
    """Rows of files that the ledger of processed files does not list."""
    return names.join(ledger.select(column).distinct(), column, "left_anti")


def latest_files(names: DataFrame, part: str = "", column: str = "file_name") -> DataFrame:
    """feed and latest: of the files whose name holds ``part``, the greatest name of each feed, a name's text before its last hyphen."""
    return names.filter(F.contains(column, F.lit(part))).groupBy(F.regexp_replace(column, "-[^-]*$", "").alias("feed")).agg(F.max(column).alias("latest"))


def ledger_or(spark: SparkSession, cache: str, otherwise: DataFrame) -> DataFrame:
    """The cached ledger of processed files, or another table where there is no cache yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(otherwise.schema).parquet(cache) if there else otherwise


def table_profile(tables: Mapping[str, DataFrame], at: Mapping[str, str]) -> DataFrame:
    """table_name, row_count, first_at and last_at of the time column named for each table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"), F.min(at[n]).alias("first_at"), F.max(at[n]).alias("last_at")).select(F.lit(n).alias("table_name"), "row_count", "first_at", "last_at") for n, df in tables.items()]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def table_name(file_name: str | Column) -> Column:
    """Kind and owner of a feed file named ``kind_owner.csv``, joined by an underscore, in lower case."""
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.lower(F.regexp_replace(c, r"\.[A-Za-z0-9]+$", ""))
