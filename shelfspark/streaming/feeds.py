"""Streams: windows with watermarks, deduplication, end-of-file counts and incremental upkeep."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..checkpoints import checkpoint_root

# Control records that are no data.
CONTROL = ("warmup", "flush")


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_batch: int = 16) -> DataFrame:
    """A table's parquet files as a stream; files that come later are read in later batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}.parquet*")


def window_counts(events: DataFrame, at: str, keys: Sequence[str], length: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Events per window and key; events later than ``late`` are dropped once their window is closed."""
    window = F.window(at, length, slide) if slide else F.window(at, length)
    counted = events.withWatermark(at, late).groupBy(window, *keys).agg(F.count(F.lit(1)).alias("events"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "events")


def session_counts(events: DataFrame, at: str, keys: Sequence[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Events per session: a key's events with no gap of ``gap`` or more between them."""
    counted = events.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys).agg(F.count(F.lit(1)).alias("events"))
    return counted.select(F.col("session_window.start").alias("window_start"), F.col("session_window.end").alias("window_end"), *keys, "events")


def without_repeats(rows: DataFrame, keys: Sequence[str], at: str | None = None, late: str = "1 day") -> DataFrame:
    """Rows once per ``keys``; with ``at``, repeats are remembered for ``late`` only. Without it every key is kept in the state for ever."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys)) if at else rows.dropDuplicates(list(keys))


def data_records(records: DataFrame, value: str = "value") -> DataFrame:
    """Records whose JSON is no control record."""
    kind = F.get_json_object(value, "$.type")
    return records.filter(kind.isNull() | ~kind.isin(*CONTROL))


def bounded_records(records: DataFrame, order: str, most: int = 1_000, value: str = "value") -> DataFrame:
    """The first ``most`` data records in ``order`` (batch): without control records, equal contents once, by their first."""
    once = data_records(records, value).groupBy(value).agg(F.min(order).alias(order))
    return once.orderBy(order).limit(most)


def refresh_due(last: float | None, now: float, minutes: float) -> bool:
    """Whether upkeep is due: never done yet, or ``minutes`` ago or longer (times in seconds)."""
    return last is None or now - last >= 60 * minutes


def file_counts(rows: DataFrame, file: str = "file_name", marker: str = "is_end") -> DataFrame:
    """One row per file when its end marker comes: the number of its data rows so far.

    All data rows of the marker's trigger count, wherever the marker stands
    among them, so a source must not give a marker in an earlier trigger than
    data that belong before it. Rows of later triggers are counted as late and
    reported by further rows. Each file's state is two numbers, kept for as long
    as the stream runs, since a late row may come at any time.
    """
    schema = f"{file} string, total_records long, late boolean"

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, ended = state.get if state.exists else (0, False)
        data, marked = 0, False
        for batch in batches:
            ends = batch[marker].fillna(False).astype(bool)
            data += int((~ends).sum())
            marked = marked or bool(ends.any())
        out = []
        if not ended:
            seen += data
            if marked:
                out.append((key[0], seen, False))
        elif data:
            out.append((key[0], data, True))
        ended = ended or marked
        state.update((seen, ended))
        yield pd.DataFrame(out, columns=[file, "total_records", "late"])

    return rows.groupBy(file).applyInPandasWithState(count, schema, "seen long, ended boolean", "append", GroupStateTimeout.NoTimeout)


def run_to_end(stream: DataFrame, name: str, mode: str = "append", then: Callable[[], None] | None = None) -> DataFrame:
    """Runs a stream over all that is there now and returns its result as a table.

    Results are written by the executors into the shared folder, one folder per
    batch, which a repeated batch overwrites; in complete mode the last batch
    holds the whole result. Nothing is kept in the driver's memory. ``then`` is
    called at the present end; what it adds to the sources is read afterwards,
    the stream going on with its state.
    """
    spark = stream.sparkSession
    base = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    kept: list[int] = []

    def save(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{base}/batch={number}")
        kept.append(number)

    def run() -> None:
        stream.writeStream.foreachBatch(save).outputMode(mode).option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start().awaitTermination()

    run()
    if then:
        then()
        run()
    used = kept[-1:] if mode == "complete" else sorted(set(kept))
    return spark.read.schema(stream.schema).parquet(*[f"{base}/batch={n}" for n in used]) if used else spark.createDataFrame([], stream.schema)


def refresh_touched(stream: DataFrame, keys: Sequence[str], refresh: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Calls ``refresh`` with the distinct keys that each batch touches, until the stream's present end.

    The keys stay distributed; ``refresh`` joins them to what must be recomputed.
    """
    def batch(df: DataFrame, number: int) -> None:
        refresh(df.select(*keys).distinct(), number)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def with_flush_records(rows: DataFrame, file: str = "file_name") -> DataFrame:
    """Rows as messages (key, value as JSON) with one flush record per file after them (batch only)."""
    data = rows.select(F.col(file).alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))
    ends = rows.select(F.col(file).alias("key")).distinct().withColumn("value", F.to_json(F.struct(F.lit("flush").alias("type"), F.col("key").alias(file))))
    return data.unionByName(ends)
