"""Cutting lineage through the folder that the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Only where the session names none and runs in one local JVM (tests, small
    runs) is a folder of this machine used, which goes at its end; on a cluster
    that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    held = tempfile.mkdtemp(prefix="shelfspark-")
    atexit.register(shutil.rmtree, held, ignore_errors=True)
    root = "file://" + held
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a compressed table under the shared folder and read it.

    Survives the loss of executors; unlike a serialised checkpoint the table is
    columnar, so later reads prune columns.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table


_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Deletes what ``materialise`` wrote for these tables, once nothing that is still to run reads them."""
    for table in tables:
        if path := _written.pop(table, None):
            spark = table.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before slow work on each, where the input has few splits for the cluster's cores.

    With fewer than four splits a core, rows are dealt out to four tasks a core,
    so that uneven splits leave no core idle. Larger inputs pass unchanged,
    without a shuffle.
    """
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
