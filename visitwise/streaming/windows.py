"""Event-time windows: one definition for tables and streams.

:func:`event_windows` aggregates tumbling or sliding windows and
:func:`session_windows` sessions; given a stream with a watermark, Spark keeps
their state keyed by (window, keys) and drops rows that come later than the
watermark allows; :func:`late_rows` says how many.

:func:`run_windows` runs a stream in update mode into a folder of batches. A
batch replaces its own folder, so a batch that is run again after a failure
leaves no duplicates, and :func:`latest` reads each window as last updated:
after every row has arrived in time these are the rows of the table's query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_windows(events: DataFrame, time: str, keys: list[str], size: str, slide: str | None = None,
                  **aggregates: Column) -> DataFrame:
    """Tumbling windows of ``size``, or with ``slide`` sliding ones: one row
    per window and keys, with ``window_start`` and ``window_end``. Rows without
    a time are in no window."""
    w = F.window(time, size, slide or size)
    return (events.groupBy(w.alias("_w"), *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, *aggregates))


def session_windows(events: DataFrame, time: str, keys: list[str], gap: str, **aggregates: Column) -> DataFrame:
    """Sessions of ``keys`` for streams: they end ``gap`` after their last row.
    For tables see ``operators.scans.sessions``, which splits a hot key."""
    return (events.groupBy(F.session_window(time, gap).alias("_w"), *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
            .select(F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), *keys, *aggregates))


_EPOCH = "1970-01-01 00:00:00"


def instant(time) -> Column:
    """A zone-less time as the instant that UTC's clocks show it: watermarks
    need instants, and so no session time zone has a say."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), F.col(time)))


def wall_clock(time) -> Column:
    """The reverse of :func:`instant`."""
    seconds = (F.unix_micros(F.col(time)).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def event_stream(spark: SparkSession, landing: str, schema, time: str, delay: str, row_id: str | None = None,
                 files_per_batch: int | None = None) -> DataFrame:
    """Event files (parquet) as a stream whose watermark follows ``time`` by
    ``delay``; with ``row_id``, rows that arrive again within it are dropped.
    A zone-less ``time`` becomes an instant."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(landing)
    if dict(stream.dtypes)[time] == "timestamp_ntz":
        stream = stream.withColumn(time, instant(time))
    stream = stream.withWatermark(time, delay)
    return stream.dropDuplicatesWithinWatermark([row_id]) if row_id else stream


def run_windows(windows: DataFrame, out: str, checkpoint: str, mode: str = "update",
                on_start: Callable[[StreamingQuery], None] | None = None) -> StreamingQuery:
    """Process all that has landed and stop. ``out`` gets a folder for each
    batch; ``checkpoint``, on shared storage and the same in every run, holds
    the state and which files are done."""
    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (windows.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    if on_start:
        on_start(query)
    query.awaitTermination()
    return query


def latest(spark: SparkSession, out: str, schema, keys: list[str]) -> DataFrame:
    """Each window (``keys``: its start, end and group) as its last batch left it."""
    rows = spark.read.schema(schema).option("basePath", out).parquet(f"{out}/batch=*")
    columns = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("_l"))
    return last.select(*keys, *[F.col(f"_l.`{c}`") for c in columns])


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark has ruled out, over the batches the query still reports."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
