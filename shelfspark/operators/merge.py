"""Writing: merges into tables that Spark overwrites as a whole or by partition."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], keep: Sequence[str] = ("created_at",)) -> DataFrame:
    """Incoming rows replace current ones of the same key, but for the columns of ``keep``.

    Of repeated incoming keys the last by all columns wins (give a sequence
    column to decide otherwise before). Columns that only the current side has
    become null in replaced rows. One shuffle by key, without a join.
    """
    columns = current.columns
    tagged = current.withColumn("new_", F.lit(0)).unionByName(incoming.withColumn("new_", F.lit(1)), allowMissingColumns=True)
    kept = [c for c in keep if c in columns]
    w = Window.partitionBy(*keys)
    order = w.orderBy(F.desc("new_"), *[F.desc(c) for c in columns if c not in keys])
    first = tagged.withColumns({f"old_{c}_": F.max(F.when(F.col("new_") == 0, F.col(c))).over(w) for c in kept} | {"row_": F.row_number().over(order)})
    chosen = first.filter("row_ = 1")
    return chosen.select(*[F.coalesce(f"old_{c}_", c).alias(c) if c in kept else F.col(c) for c in columns])


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows, and incoming rows of keys that are new; of repeated new keys one row."""
    new = incoming.dropDuplicates(list(keys)).join(current.select(*keys).distinct(), list(keys), "left_anti")
    return current.unionByName(new, allowMissingColumns=True)


def update_where_distinct(current: DataFrame, values: DataFrame, keys: Sequence[str], column: str, stamp: Column, stamp_column: str = "updated_at") -> DataFrame:
    """Sets ``column`` from ``values`` where it differs (null is a value), with a new stamp there only."""
    given = values.select(*keys, F.col(column).alias("given_"), F.lit(True).alias("hit_"))
    changed = F.coalesce("hit_", F.lit(False)) & ~F.col(column).eqNullSafe(F.col("given_"))
    joined = current.join(given, list(keys), "left")
    return joined.withColumns({"changed_": changed, stamp_column: F.when(changed, stamp).otherwise(F.col(stamp_column)), column: F.when(changed, F.col("given_")).otherwise(F.col(column))}).select(*current.columns)


def delete_where(current: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows that go); a null condition keeps the row. Count the second for a dry run."""
    goes = F.coalesce(condition, F.lit(False))
    return current.filter(~goes), current.filter(goes)


def delete_listed(current: DataFrame, listed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows that go): those whose keys are listed go; a null key is listed nowhere."""
    wanted = listed.select(*keys).distinct()
    return current.join(wanted, list(keys), "left_anti"), current.join(wanted, list(keys), "left_semi")


def delete_but(current: DataFrame, keepers: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows that go): only those with a keeper's keys stay."""
    goes, stays = delete_listed(current, keepers, keys)
    return stays, goes


def wipe_order(parents: Mapping[str, Sequence[str]]) -> list[str]:
    """Tables in an order in which they can be emptied: children before the tables they refer to."""
    done: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"circular reference: {name}")
        if name not in done:
            for child in sorted(c for c, refs in parents.items() if name in refs):
                visit(child, (*path, name))
            done.append(name)

    for name in sorted({*parents, *(r for refs in parents.values() for r in refs)}):
        visit(name, ())
    return done


def with_missing_parents(parents: DataFrame, references: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parents, and a bare row for each referenced key that has none."""
    wanted = references.select(*keys).dropna().distinct().join(parents.select(*keys), list(keys), "left_anti")
    return parents.unionByName(wanted, allowMissingColumns=True)


def split_by_lookup(rows: DataFrame, dimension: DataFrame, keys: Sequence[str], surrogate: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the dimension's surrogate key, rows without a match)."""
    joined = rows.join(dimension.select(*keys, surrogate), list(keys), "left")
    return joined.filter(F.col(surrogate).isNotNull()), joined.filter(F.col(surrogate).isNull()).drop(surrogate)


def route(rows: DataFrame, column: str, prefixes: Mapping[str, str]) -> dict[str, DataFrame]:
    """Rows by the destination whose prefix their ``column`` begins with, '' for those with none."""
    target = F.coalesce(*[F.when(F.startswith(F.lower(column), F.lit(p)), F.lit(d)) for p, d in prefixes.items()], F.lit(""))
    tagged = rows.withColumn("target_", target)
    return {d: tagged.filter(F.col("target_") == d).drop("target_") for d in [*dict.fromkeys(prefixes.values()), ""]}


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrites the partitions that ``df`` holds and leaves all others."""
    df.write.option("partitionOverwriteMode", "dynamic").partitionBy(*by).mode("overwrite").parquet(path)


def publish_snapshot(df: DataFrame, root: str, at: str) -> int:
    """Writes the next version of a data set and adds it to the index; returns its number.

    The index is written last and under another name first, so a reader never
    sees a version that is not whole. One writer at a time.
    """
    spark = df.sparkSession
    index = snapshot_index(spark, root)
    version = max(map(int, index), default=0) + 1
    df.write.mode("errorifexists").parquet(f"{root}/version={version}")
    _write_text(spark, f"{root}/index.json", json.dumps(index | {str(version): at}, sort_keys=True))
    return version


def snapshot_index(spark: SparkSession, root: str) -> dict[str, str]:
    """Version numbers and their times."""
    path, fs = _path(spark, f"{root}/index.json")
    if not fs.exists(path):
        return {}
    return json.loads("".join(r[0] for r in spark.read.text(f"{root}/index.json", wholetext=True).collect()))


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of a data set, the latest by default."""
    latest = version or max(map(int, snapshot_index(spark, root)))
    return spark.read.parquet(f"{root}/version={latest}")


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, target: str, text: str) -> None:
    path, fs = _path(spark, target)
    draft, _ = _path(spark, f"{target}.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(path):
        fs.delete(path, False)
    fs.rename(draft, path)
