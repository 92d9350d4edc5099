"""Landed answers as a stream: ingest, snapshot refresh, quarantine."""

from __future__ import annotations

import datetime as dt
from ast import literal_eval
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import schemas
from ..operators import files, sinks
from ..sources.payloads import CORRUPT, parsed

Stage = Callable[[DataFrame], DataFrame]
GOOD, BROKEN = "good", "broken"
BATCH, POLL = "_batch", "_poll"
ROWS, POLLS, BUILT = "rows", "polls", "built"


def landed_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """JSON lines of ``schemas.LANDED``, as files arrive."""
    reader = spark.readStream.schema(schemas.LANDED).format("json")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet table, a folder or one file, as a stream with the schema of the stored files."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # As a pattern, since a plain stream path must be a folder.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def keep_batch(batch: DataFrame, number: int, path: str) -> None:
    """Store a micro-batch in a folder of its own; a repeated batch takes the place of its first try."""
    batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")


def kept_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All stored micro-batches, with the number of each in ``_batch``."""
    return spark.read.schema(StructType([*schema.fields, StructField(BATCH, LongType())])).parquet(path)


def _state(spark: SparkSession, path: str) -> dict:
    """What is known of the stored polls: their values, oldest first, and the last batch with rows of the newest."""
    entries = [name for name in files.names(spark, f"{path}/{POLLS}") if name.isdigit()]
    return literal_eval(files.read_text(spark, f"{path}/{POLLS}/{entries[-1]}")) if entries else {"polls": [], "grown": None}


def known_polls(spark: SparkSession, path: str) -> list:
    """The polls that are stored below ``path``, oldest first."""
    return _state(spark, path)["polls"]


def poll_rows(spark: SparkSession, path: str, schema: StructType, poll) -> DataFrame:
    """The stored rows of one poll; the filter is on the column that the table is stored by, so no other poll is read."""
    return spark.read.schema(StructType([*schema.fields, StructField(POLL, StringType()), StructField(BATCH, LongType())])).parquet(
        f"{path}/{ROWS}").where(F.col(POLL) == F.lit(str(poll))).drop(POLL, BATCH)


def keep_polls(batch: DataFrame, number: int, path: str, poll: str, keep: int = 2) -> tuple[object, bool]:
    """Store a micro-batch by poll.  Returns the newest poll so far, None without one, and whether the batch has rows of it.

    Only the ``keep`` newest polls stay; rows of older ones, and those without a poll, are not stored.  A list of the polls is
    created for each batch, so neither the newest poll nor what is left over has to be looked for in the rows.  A
    repeated batch replaces its own rows and finds its list made.
    """
    spark = batch.sparkSession
    state = _state(spark, path)
    before = state["polls"]
    # The driver gets no more than ``keep`` values.
    newest = [r[0] for r in batch.where(F.col(poll).isNotNull()).select(poll).distinct().orderBy(F.desc(poll)).limit(keep).collect()]
    polls = sorted({*before, *map(_plain, newest)})[-keep:]
    stored = [p for p in map(_plain, newest) if p in polls]
    if stored:
        rows = batch.where(F.col(poll) >= F.lit(newest[stored.index(min(stored))])).withColumns(
            {POLL: F.col(poll).cast("string"), BATCH: F.lit(number).cast("long")})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(POLL, BATCH).parquet(f"{path}/{ROWS}")
    grown = bool(stored) and stored[0] == polls[-1]
    files.create(spark, f"{path}/{POLLS}/{number:010d}", repr({"polls": polls, "grown": number if grown else state["grown"]}))
    for old in set(before) - set(polls):
        files.drop(spark, f"{path}/{ROWS}/{POLL}={_escaped(spark, str(old))}")
    for name in files.names(spark, f"{path}/{POLLS}"):
        if name.isdigit() and int(name) < number - 1:
            files.drop(spark, f"{path}/{POLLS}/{name}")
    return (polls[-1] if polls else None), grown


def _plain(value):
    """A poll as a number or a text that is ordered like it and reads as Spark writes it."""
    if isinstance(value, (int, str)):
        return value
    if isinstance(value, dt.datetime):
        whole = value.replace(tzinfo=None).isoformat(" ")
        return whole.rstrip("0") if value.microsecond else whole
    if isinstance(value, dt.date):
        return value.isoformat()
    raise TypeError(f"a poll is a number, a text or a time, not {type(value).__name__}")


def _escaped(spark: SparkSession, value: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def build_snapshot(spark: SparkSession, landed: str, schema: StructType, steps: list[tuple[Stage, str]]) -> bool:
    """Build a chain of tables from the newest stored poll; false if they were built from the same rows before.

    Every step is a plan and a path; the first plan reads the poll, each later one the table before it.
    """
    state = _state(spark, landed)
    done = f"{landed}/{BUILT}/{state['grown']}"
    if state["grown"] is None or files.read_text(spark, done) is not None:
        return False
    rows = poll_rows(spark, landed, schema, state["polls"][-1])
    for plan, path in steps:
        sinks.replace(plan(rows), path)
        rows = sinks.read(spark, path)
    for name in files.names(spark, f"{landed}/{BUILT}"):
        files.drop(spark, f"{landed}/{BUILT}/{name}")
    files.create(spark, done, "")
    return True


def refresh_snapshot(stream: DataFrame, steps: list[tuple[Stage, str]], checkpoint: str, landed: str,
                     poll: str = "fetched_at", every: str | None = None, keep: int = 2) -> StreamingQuery:
    """Rebuild a chain of tables from the newest poll, so only the newest snapshot lives.

    A poll is all rows with the same value of ``poll``, and may span several
    micro-batches: each batch is stored by poll below ``landed`` first, and the
    tables are built (``build_snapshot``) from the stored rows of the newest poll
    alone.  A batch without rows of it changes no table.  The ``keep`` newest
    polls stay stored.  A repeated batch gives the same rows, so a restart after
    a failure changes nothing.
    """
    def rebuild(batch: DataFrame, number: int) -> None:
        keep_polls(batch, number, landed, poll, keep)
        build_snapshot(batch.sparkSession, landed, stream.schema, steps)

    writer = stream.writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def catch_up_snapshot(stream: DataFrame, steps: list[tuple[Stage, str]], checkpoint: str, landed: str,
                      poll: str = "fetched_at", keep: int = 2) -> bool:
    """Take in all that has landed, batch by batch, and then build the tables once; false if nothing new came.

    A run that ends before its tables are built leaves that to the next one.
    """
    writer = stream.writeStream.foreachBatch(lambda batch, number: keep_polls(batch, number, landed, poll, keep) and None)
    _trigger(writer.option("checkpointLocation", checkpoint), None).start().awaitTermination()
    return build_snapshot(stream.sparkSession, landed, stream.schema, steps)


def append_stream(rows: DataFrame, path: str, checkpoint: str, every: str | None = None,
                  partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append to a parquet table; the sink's own log makes it exactly-once."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer.outputMode("append"), every).start()


def split_quarantine(stream: DataFrame, text: str, schema: str, path: str, checkpoint: str,
                     every: str | None = None) -> StreamingQuery:
    """Parse a stream into one table with a partition of good and one of broken rows.

    Each text is parsed once; a broken one does not hold up the others.
    """
    status = F.when(F.col(CORRUPT).isNull(), F.lit(GOOD)).otherwise(F.lit(BROKEN))
    rows = parsed(stream, schema, text).withColumn("status", status)
    return append_stream(rows, path, checkpoint, every, ("status",))


def of_status(spark: SparkSession, path: str, status: str) -> DataFrame:
    """The good or the broken partition of a table written by ``split_quarantine``."""
    return spark.read.parquet(path).where(F.col("status") == status).drop("status")
