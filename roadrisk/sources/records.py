"""CSV files cut into records where their fields may hold line breaks, without a task per file (A1).

A file is read as lines, in splits.  Quotes open and close in turn (one inside a field is doubled), so a line begins inside
a field if the quotes before it in its file are odd in number.  The quotes of every split are counted first; running
sums over the splits of a file, one row each, tell how each split begins.  Each task then joins the lines of its
own splits; only what a split begins or ends in the middle of is put together across splits.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .payloads import once

CORRUPT = "_corrupt_record"
WHOLE, TAIL, INSIDE, HEAD, CUT = "whole", "tail", "inside", "head", "cut"
LONGEST = 1_000_000  # characters of an open field after which a record is given up and kept in pieces
OPEN, FIELDS = "quote left open", "wrong number of fields"
PART = "file string, block long, place long, kind string, text string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"), "value")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the lines of each split, and the pieces at its ends."""
    at, held, size, place, kind, is_open = None, [], 0, 0, WHOLE, False
    out: list[tuple] = []

    def emit(what: str) -> None:
        nonlocal held, size, place
        out.append((*at, place, what, "\n".join(held)))
        held, size, place = [], 0, place + 1

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[
            "file", "block", "place", "kind", "text"])

    for batch in batches:
        odd = pc.equal(pc.bit_wise_and(batch.column("quotes"), 1), 1).to_pylist()
        columns = (batch.column(name).to_pylist() for name in ("file", "block", "began_open", "value"))
        for file, block, began_open, value, turns in zip(*columns, odd):
            if at != (file, block):
                if held:
                    emit(INSIDE if kind == HEAD else TAIL)
                at, place, is_open = (file, block), 0, began_open
                kind = HEAD if is_open else WHOLE
            held.append(value)
            size += len(value)
            is_open ^= turns
            if not is_open:
                emit(kind)
                kind = WHOLE
            elif size > LONGEST:
                emit(CUT)
                kind = CUT
        yield batch_of(out)
        out = []
    if held:
        emit({HEAD: INSIDE, CUT: CUT}.get(kind, TAIL))
        yield batch_of(out)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of CSV files: file, whether it is the file's first, its text, and whether its quotes are closed.

    Blank lines between records are left out.  Of a record with more than ``LONGEST`` characters inside open quotes, the pieces come
    as open records, so that a stray quote takes no task's memory; no text is lost.
    """
    lines = _lines(spark, path)
    # One row per split.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    began = lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd")).select(
        "file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("began_open"))
    numbered = lines.withColumn("seq", F.monotonically_increasing_id())
    # A split is read by one task, and its lines stay together and in order whichever way the join is done.
    known = numbered.join(began.where("began_open"), ["file", "block"], "left").sortWithinPartitions("file", "block", "seq")
    parts = known.select("file", "block", "quotes", F.coalesce("began_open", F.lit(False)).alias("began_open"),
                         "value").mapInArrow(_joined, PART)
    whole = parts.where(F.col("kind").isin(WHOLE, CUT)).select(
        "file", (F.col("block") == 0) & (F.col("place") == 0), "text", F.col("kind") == WHOLE)
    # Pieces: at most two per split.  A record begins with a tail.
    order = Window.partitionBy("file").orderBy("block", "place")
    pieces = parts.where(F.col("kind").isin(TAIL, INSIDE, HEAD)).withColumn(
        "number", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    stitched = pieces.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("pieces"),
        F.max(F.col("kind") == HEAD).alias("closed"))
    across = stitched.select(
        "file", (F.col("pieces")[0]["block"] == 0) & (F.col("pieces")[0]["place"] == 0),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "\n"), "closed")
    both = whole.union(across).toDF("file", "first", "text", "closed")
    return both.withColumn("text", F.regexp_replace("text", "\r$", "")).where("NOT closed OR trim(text) <> ''")


def header(spark: SparkSession, path: str | list[str]) -> str:
    """The first line of the files, which all share it."""
    line = spark.read.text(path, lineSep="\n").first()
    return line[0].rstrip("\r") if line else ""


def parsed(spark: SparkSession, path: str | list[str], names: str | None = None) -> DataFrame:
    """The columns of all records as text, with the record in ``_corrupt_record`` and a ``reason`` where it is unfit.

    ``names`` is the header line; without it the first line of the files is taken, which is no record.  A record is
    unfit if its quotes stay open or if it has more or fewer fields than the header; each record is either good or unfit.
    """
    line = names if names is not None else header(spark, path)
    fields = next(csv.reader([line]), [])
    schema = StructType([StructField(name, StringType()) for name in [*fields, CORRUPT]])
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    rows = records(spark, path).where(~(F.col("first") & (F.col("text") == F.lit(line))))
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "maxCharsPerColumn": "-1"}
    read = once(rows, F.from_csv("text", ddl, options), "r")
    reason = F.when(~F.col("closed"), OPEN).when(F.col(f"r.{CORRUPT}").isNotNull(), FIELDS)
    return read.withColumn("reason", reason).select(
        *[F.when(F.col("reason").isNull(), F.col("r").getField(name)).alias(name) for name in fields],
        F.when(F.col("reason").isNotNull(), F.col("text")).alias(CORRUPT), "reason")
