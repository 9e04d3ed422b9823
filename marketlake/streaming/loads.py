"""Streaming loads. Each runs until the files at hand are used up (``availableNow``), keeps its
progress in a checkpoint and continues there on the next run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from marketlake.operators import joins, writes
from marketlake.plans import bars, runner
from marketlake.schema import DatasetSpec
from marketlake.sources.tables import LakeTable, publish_together


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Landed Parquet files as a stream of micro-batches.

    The path is handed over as a glob, since a plain path would have to be a folder; a glob may
    name a folder of files or a single file.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def _each_batch(stream: DataFrame, checkpoint: str, publish: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Run ``publish`` on every micro-batch at hand, with an id that a repeated micro-batch has again.

    The stream's id, which its checkpoint keeps, is part of it: streams into one table do not meet.
    """
    started: Future = Future()

    def numbered(rows: DataFrame, batch_id: int) -> None:
        publish(rows, f"stream-{started.result(timeout=600)}-{batch_id:010d}")

    query = (
        stream.writeStream.foreachBatch(numbered)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set_result(query.id)
    query.awaitTermination()
    return query


def load_available(
    stream: DataFrame,
    table: LakeTable,
    checkpoint: str,
    key: Sequence[str],
    order: Sequence[str],
    within: str | None = None,
) -> None:
    """Insert-if-absent of everything that has landed since the last run. ``within`` names the
    key column, such as the date, by which stored files can be skipped.

    A micro-batch that is repeated after a failure writes the same batch folder again, and
    ignores its own earlier rows, so it neither doubles nor loses any.
    """

    def publish(rows: DataFrame, batch: str) -> None:
        stored = table.read_batches(exclude=batch)
        table.write_batch(writes.absent_rows(stored, rows, key, order, within), batch)

    _each_batch(stream, checkpoint, publish)


def load_revised(
    stream: DataFrame, context: runner.Context, spec: DatasetSpec, checkpoint: str, history: DataFrame
) -> None:
    """Bars of a revised dataset as they land: each micro-batch is compared with the last close that
    the batches before it left per symbol; unchanged symbols grow, revised ones are replaced by ``history``.

    ``stream`` and ``history`` have the table's columns. Bars from before a symbol's last one are old news
    and are left out, so a delivery may come again. A micro-batch that was committed is not loaded twice.
    """

    def publish(rows: DataFrame, batch: str) -> None:
        once = runner.Context(context.lake, context.calendar, context.now, attempt=batch)
        if once.table(spec).is_committed(batch):
            return
        last = runner.state(once, spec).select(spec.scope, "last_date")
        newer = F.col("last_date").isNull() | (F.col(spec.date) >= F.col("last_date"))
        rows = rows.join(last, spec.scope, "left").filter(newer).drop("last_date")
        runner.publish(once, spec, rows, history)

    _each_batch(stream, checkpoint, publish)


def complete_units(first: DataFrame, second: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """(key, time) of the units that two streams both have rows of, each once.

    Both sides are reduced to one row a unit, and joined on key and time; a side's unit leaves the
    state when the watermark, that of the slower stream, has passed its time by ``delay``.
    """

    def units(side: DataFrame, name: str) -> DataFrame:
        timed = side.select(F.col(key).alias(f"{name}_key"), F.col(time).cast("timestamp").alias(f"{name}_time"))
        return timed.withWatermark(f"{name}_time", delay).dropDuplicatesWithinWatermark([f"{name}_key", f"{name}_time"])

    one, two = units(first, "a"), units(second, "b")
    both = one.join(two, (F.col("a_key") == F.col("b_key")) & (F.col("a_time") == F.col("b_time")))
    return both.select(F.col("a_key").alias(key), F.col("a_time").alias(time))


def load_pair(
    spark: SparkSession,
    first: tuple[LakeTable, str],
    second: tuple[LakeTable, str],
    key: str,
    time: str,
    checkpoint: str,
    delay: str = "30 days",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Two tables that belong together, from one landing folder each: a unit (key, day) is loaded, into
    both, when both sides have landed.

    The stream finds the complete units, in bounded state; each micro-batch then reads their rows from
    the landings and commits them together. Units that are stored are not loaded again, so a delivery may
    come twice; a side that lands later than ``delay`` behind the other is left to a batch load.
    """
    streams = [file_stream(spark, path, table.schema, files_per_batch) for table, path in (first, second)]
    done = LakeTable(first[0].lake, f"{first[0].name}__complete", StructType([first[0].schema[key], first[0].schema[time]]))
    unit = [key, time]

    def publish(units: DataFrame, batch: str) -> None:
        kind = first[0].schema[time].dataType
        found = units.select(key, F.col(time).cast(kind).alias(time))
        found = done.stage(joins.without(found, done.read_batches(exclude=batch), unit), batch)
        rows = [(table, spark.read.schema(table.schema).parquet(path).join(found, unit, "left_semi")) for table, path in (first, second)]
        publish_together(batch, *rows, (done, found))

    return _each_batch(complete_units(*streams, key, time, delay), checkpoint, publish)


def distinct_within(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """First delivery of each key; the state of a key is dropped once the watermark passes it."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def bars_30min(ticks: DataFrame, delay: str = "1 hour", minutes: int = 30) -> DataFrame:
    """Bars of a tick stream (symbol, ts, event_id, price, volume, amount). A bar is emitted once
    the watermark has passed its end; later ticks for it are dropped."""
    timed = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    keys = ["symbol", F.window("ts", f"{minutes} minutes").alias("slot")]
    out = bars.from_trades(timed, keys, ["ts", "event_id"], digits=bars.TICK_DIGITS)
    return out.select("symbol", F.col("slot.start").alias("bar_time"), "open", "close", "high", "low", "volume", "amount")


def write_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream's result to Parquet files, each row exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
