import os

import pytest

from shelfspark.checkpoints import checkpoint_root, discard, materialise, spread


def test_tables_are_written_and_discarded(spark):
    table = materialise(spark.range(10), "numbers")
    path = table.inputFiles()[0]
    assert checkpoint_root(spark).removeprefix("file://") in path and "/numbers-" in path and table.count() == 10
    folder = os.path.dirname(path.removeprefix("file://"))
    assert os.path.isdir(folder)
    discard(table, spark.range(1))
    assert not os.path.exists(folder)
    with pytest.raises(Exception):
        table.count()


def test_spreading_keeps_rows(spark):
    small = spread(spark.range(100).coalesce(1))
    assert small.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism and small.count() == 100
    many = spark.range(0, 1000, 1, 64)
    assert spread(many) is many
