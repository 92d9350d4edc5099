"""Trailing windows up to the present from a log of pane sums, and the rows that came too late for them.

A pane is one slide of time.  Each micro-batch adds the sums of its rows as a segment; segments are added up as they
grow in number, so there are never more than a few of each size, and a read takes the open ones, not one per batch.
"""

from __future__ import annotations

import datetime as dt
from ast import literal_eval

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import files
from .landing import BATCH

FANOUT = 4  # segments of a level that become one of the next
STATE, SEGMENTS, LATE = "state", "segments", "late"


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number of the last finished batch, -1 without one, and what it left: open segments and the latest time so far."""
    entries = [name for name in files.names(spark, f"{path}/{STATE}") if name.isdigit()]
    if not entries:
        return -1, {"segments": [], "latest": None}
    return int(entries[-1]), literal_eval(files.read_text(spark, f"{path}/{STATE}/{entries[-1]}"))


def _seconds(spark: SparkSession, interval: str) -> int:
    return int(spark.range(1).select(F.expr(f"CAST(INTERVAL {interval} AS INTERVAL DAY TO SECOND)").alias("i")).first()[0].total_seconds())


def _sums(measures: list[str]) -> list[str]:
    return ["_rows", *[f"_sum_{name}" for name in measures], *[f"_n_{name}" for name in measures]]


def _segment(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{SEGMENTS}/{name}" for name in names])


def open_segments(spark: SparkSession, path: str) -> list[str]:
    """Names of the segments that hold the sums, ``level-first batch-last batch``."""
    return _state(spark, path)[1]["segments"]


def _merged(spark: SparkSession, path: str, segments: list[str], key: str, sums: list[str]) -> tuple[list[str], list[str]]:
    """Segments after adding up each level that is full, and the names of those that went into others."""
    gone: list[str] = []
    level = 0
    while True:
        full = [s for s in segments if int(s.split("-")[0]) == level]
        if len(full) < FANOUT:
            if not any(int(s.split("-")[0]) > level for s in segments):
                return segments, gone
        else:
            name = f"{level + 1}-{full[0].split('-')[1]}-{full[-1].split('-')[2]}"
            added = _segment(spark, path, full).groupBy("pane_end", key).agg(*[F.sum(c).alias(c) for c in sums])
            added.write.mode("overwrite").parquet(f"{path}/{SEGMENTS}/{name}")
            segments = [s for s in segments if s not in full] + [name]
            gone += full
        level += 1


def add_batch(batch: DataFrame, number: int, path: str, time: str, key: str, measures: list[str], slide: int,
              delay: int) -> None:
    """Add a micro-batch, with ``slide`` and ``delay`` in seconds: rows in time to the pane sums, the others whole to the table of late rows.

    The watermark is the latest time of all batches before, less ``delay``; a row is late if its pane had ended by
    then.  The new state names the segments that count, so a batch that is repeated changes nothing once it is
    in, and replaces its own files before.
    """
    spark = batch.sparkSession
    last, state = _state(spark, path)
    if number <= last:
        return
    latest = state["latest"] and dt.datetime.fromisoformat(state["latest"])
    moment = F.col(time).cast("timestamp_ntz")
    end = F.window(F.col(time).cast("timestamp"), f"{slide} seconds").end.cast("timestamp_ntz")
    rows = batch.where(F.col(time).isNotNull()).withColumn("pane_end", end)
    segments, gone = state["segments"], []
    watermark = latest and latest - dt.timedelta(seconds=delay)
    if watermark:
        late = F.col("pane_end") <= F.lit(watermark).cast("timestamp_ntz")
        rows, behind = rows.where(~late), rows.where(late)
        kept = f"{path}/{LATE}/{BATCH}={number}"
        behind = behind.drop("pane_end").withColumns({
            "reason": F.lit("behind the watermark"), "watermark": F.lit(watermark).cast("timestamp_ntz")})
        behind.write.mode("overwrite").parquet(kept)
        if spark.read.schema(behind.schema).parquet(kept).isEmpty():
            files.drop(spark, kept)
    panes = rows.groupBy("pane_end", key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.col(name).cast("double")).alias(f"_sum_{name}") for name in measures],
        *[F.count(name).alias(f"_n_{name}") for name in measures], F.max(moment).alias("_latest"))
    name = f"0-{number}-{number}"
    panes.write.mode("overwrite").parquet(f"{path}/{SEGMENTS}/{name}")
    newest = _segment(spark, path, [name]).agg(F.max("_latest")).first()[0]
    if newest is not None:
        segments, gone = _merged(spark, path, [*segments, name], key, _sums(measures))
        latest = max(newest, latest or newest)
    files.create(spark, f"{path}/{STATE}/{number:010d}", repr({
        "segments": segments, "latest": latest and latest.isoformat(), "gone": gone, "slide": slide}))
    # What the state before named may still be read; what went out two states ago may not.
    for entry in files.names(spark, f"{path}/{STATE}"):
        if entry.isdigit() and int(entry) < last:
            for old in literal_eval(files.read_text(spark, f"{path}/{STATE}/{entry}")).get("gone", ()):
                files.drop(spark, f"{path}/{SEGMENTS}/{old}")
            files.drop(spark, f"{path}/{STATE}/{entry}")


def refresh_panes(rows: DataFrame, time: str, key: str, measures: list[str], path: str, checkpoint: str,
                  slide: str = "30 minutes", delay: str = "1 hour", every: str | None = None) -> StreamingQuery:
    """Keep sums per key and pane of one slide up to the present, and the late rows, below ``path``.

    Rows without a time are in neither.  A batch costs its own rows and, every few batches, the adding up of segments:
    each pane sum is written again once per level, and the levels grow with the logarithm of the batches.
    """
    width, behind = (_seconds(rows.sparkSession, interval) for interval in (slide, delay))

    def add(batch: DataFrame, number: int) -> None:
        add_batch(batch, number, path, time, key, measures, width, behind)

    writer = rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def late_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that came after their pane had closed: all their columns, the reason, the watermark and the batch."""
    kept = f"{path}/{LATE}"
    full = f"{schema}, reason string, watermark timestamp_ntz, {BATCH} long"
    return spark.read.schema(full).parquet(kept) if files.names(spark, kept) else spark.createDataFrame([], full)


def trailing_now(spark: SparkSession, path: str, key: str, measures: list[str], length: str = "24 hours") -> DataFrame:
    """Count and means per key over every window of ``length`` that ends on a slide, also those still open.

    Each pane enters a window's sums when it ends and leaves them ``length`` later; the running sums of both are the
    windows, which stay as they are up to the next such moment.  Equals the windows of a batch over all rows that
    were not late; counts are exact, and so are sums of whole numbers, others up to rounding.
    """
    _, state = _state(spark, path)
    sums = _sums(measures)
    if not state["segments"]:
        raise ValueError(f"no panes below {path}")
    step = F.make_dt_interval(secs=F.lit(state["slide"]))
    whole = F.expr(f"INTERVAL {length}")
    panes = _segment(spark, path, state["segments"]).select("pane_end", key, *sums)
    moves = panes.select(key, F.explode(F.array(
        F.struct(F.col("pane_end").alias("at"), *sums),
        F.struct((F.col("pane_end") + whole).alias("at"), *[(-F.col(c)).alias(c) for c in sums]))).alias("m")).select(key, "m.*")
    changes = moves.groupBy(key, "at").agg(*[F.sum(c).alias(c) for c in sums])
    order = Window.partitionBy(key).orderBy("at")
    running = changes.select(key, "at", F.lead("at").over(order).alias("next"),
                             *[F.sum(c).over(order).alias(c) for c in sums]).where("_rows > 0")
    ends = F.explode(F.sequence(F.col("at"), F.col("next") - step, step)).alias("window_end")
    return running.select(key, *sums, ends).select(
        (F.col("window_end") - whole).alias("window_start"), "window_end", key, F.col("_rows").alias("readings"),
        *[F.when(F.col(f"_n_{name}") > 0, F.col(f"_sum_{name}") / F.col(f"_n_{name}")).alias(f"avg_{name}") for name in measures])
