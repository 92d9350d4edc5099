"""Event-time windows and de-duplication on streams.

Watermarks need a zoned timestamp, so event times are cast to ``timestamp``
under a UTC session and back to ``timestamp_ntz`` on output.
"""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.sinks import has_order
from . import landing

EVENT, ARRIVED = "_event_time", "_arrived"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_event_time(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """Rows with a watermark; rows later than ``delay`` are dropped by the stateful steps."""
    return rows.withColumn(EVENT, F.col(time).cast("timestamp")).withWatermark(EVENT, delay)


def trailing_means(rows: DataFrame, time: str, key: str, measures: list[str], length: str = "24 hours",
                   slide: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Count and means per key over a window of ``length`` that ends every ``slide``.

    Readings are first summed into panes of one slide; only the panes, not the
    readings, are repeated for every window that covers them.
    """
    timed = with_event_time(rows, time, delay)
    panes = timed.groupBy(F.window(EVENT, slide).alias("pane"), F.col(key)).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(name).alias(f"_sum_{name}") for name in measures],
        *[F.count(name).alias(f"_n_{name}") for name in measures])
    covering = F.window(F.window_time("pane"), length, slide).alias("covering")
    windows = panes.groupBy(covering, F.col(key)).agg(
        F.sum("_rows").alias("readings"),
        *[F.sum(f"_sum_{name}").alias(f"_sum_{name}") for name in measures],
        *[F.sum(f"_n_{name}").alias(f"_n_{name}") for name in measures])
    return windows.select(
        F.col("covering.start").cast("timestamp_ntz").alias("window_start"),
        F.col("covering.end").cast("timestamp_ntz").alias("window_end"), key, "readings",
        *[F.try_divide(f"_sum_{name}", f"_n_{name}").alias(f"avg_{name}") for name in measures])


class LateRows(StreamingQueryListener):
    """Rows that came too late for the state, added up over all batches of each run.

    A query keeps only its last progress reports; a listener sees every one.
    Register with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self._ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:
        run, report = str(event.progress.runId), event.progress
        self.rows[run] = self.rows.get(run, 0) + sum(step.numRowsDroppedByWatermark for step in report.stateOperators)
        self.batches[run] = self.batches.get(run, 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event()).set()

    def total(self, query: StreamingQuery, seconds: float = 30.0) -> int:
        """The late rows of a run that has ended; its last reports come before the one of its end."""
        run = str(query.runId)
        self._ended.setdefault(run, Event()).wait(seconds)
        return self.rows.get(run, 0)


def first_of_each(rows: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """One row per key; the state of a key is dropped once the watermark has passed it, so a later repeat gets in again."""
    return with_event_time(rows, time, delay).dropDuplicatesWithinWatermark(keys).drop(EVENT)


def keep_first(rows: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str,
               every: str | None = None) -> StreamingQuery:
    """Store the first row of every key, whole, and never another one, however much later it comes.

    The first is that of the first micro-batch with the key and there, as in ``first_by_key``, by ``order`` and then all other
    columns.  NULL is a key.  The keys stay in the query's state, kept by RocksDB on the executors' disks: a batch
    looks up and adds its own keys only, whatever has been stored before.  Update mode gives each key of a batch with its first
    row and the times of the first and the last batch that had it; only keys for which both are this batch's are
    new.  The time of a batch is part of the query's log, so a repeated batch stores the same rows again.
    """
    spark = rows.sparkSession
    kept = [name for name in rows.columns if name not in keys]
    ranked = [*order, *[f.name for f in rows.schema.fields if f.name in kept and f.name not in order and has_order(f.dataType)]]
    first = rows.withColumn(ARRIVED, F.current_timestamp()).groupBy(*keys).agg(
        F.min_by(F.struct(*kept) if kept else F.lit(True), F.struct(F.col(ARRIVED), *ranked)).alias("_kept"),
        F.min(ARRIVED).alias("_first"), F.max(ARRIVED).alias("_last"))

    def store(batch: DataFrame, number: int) -> None:
        new = batch.where("_first = _last").select(
            *[F.col(name) if name in keys else F.col(f"_kept.`{name}`").alias(name) for name in rows.columns])
        landing.keep_batch(new, number, path)

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        writer = first.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    finally:
        spark.conf.set(name, before)
