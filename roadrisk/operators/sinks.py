"""Writing tables."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..functions.times import Moment, clock, today
from . import files

LOG, DATA = "_log", "_data"
KEPT_VERSIONS = 2


class TableChanged(Exception):
    """Another writer has replaced the table since this one began; nothing was written."""


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can still be read, rising; none for a missing or a plain table."""
    return [int(name) for name in files.names(spark, f"{path.rstrip('/')}/{LOG}") if name.isdigit()]


def replace(rows: DataFrame, path: str, partition_by: list[str] | None = None, based_on: int | None = None) -> int:
    """Snapshot replace: afterwards the table holds exactly these rows.  Returns the number of the new version.

    A version is a folder of its own that is written whole before an entry of the table's log names it.  The entry is
    created only if there is none of its number, so a reader sees the version before or the new one, never none or half
    of one, and of two writers that began at the same version (``based_on``, else the newest when the write starts) one
    wins; the other raises ``TableChanged``.  Rows may come from the table itself, and a failed write leaves it as it
    was.  The version before stays readable until the next replace.

    Before a partitioned write the rows are rebalanced on the partition columns,
    which keeps the files few and still splits a partition that is large.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    held = versions(spark, path)
    before = based_on if based_on is not None else max(held, default=0)
    folder = uuid.uuid4().hex
    try:
        if partition_by:
            rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(f"{path}/{DATA}/{folder}")
        else:
            rows.write.parquet(f"{path}/{DATA}/{folder}")
    except Exception:
        files.drop(spark, f"{path}/{DATA}/{folder}")
        raise
    if max(versions(spark, path), default=0) != before or not files.create(spark, f"{path}/{LOG}/{before + 1:010d}", folder):
        files.drop(spark, f"{path}/{DATA}/{folder}")
        raise TableChanged(f"{path} is no longer at version {before}")
    for number in held:
        if number <= before + 1 - KEPT_VERSIONS:
            old = files.read_text(spark, f"{path}/{LOG}/{number:010d}")
            files.drop(spark, f"{path}/{LOG}/{number:010d}")
            if old:
                files.drop(spark, f"{path}/{DATA}/{old}")
    if not held:
        # A plain table that stood here before.
        for name in files.names(spark, path):
            if name not in (LOG, DATA):
                files.drop(spark, f"{path}/{name}")
    return before + 1


def _folder(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Where the rows of a version lie, the newest without a number; a table without a log is its own folder."""
    path = path.rstrip("/")
    while True:
        held = versions(spark, path)
        if not held and version is None:
            return path
        number = max(held) if version is None else version
        folder = files.read_text(spark, f"{path}/{LOG}/{number:010d}")
        if folder is not None:
            return f"{path}/{DATA}/{folder}"
        if version is not None:
            raise ValueError(f"{path} has no version {version}")
        # The entry went between the two looks, as there are newer ones.


def read(spark: SparkSession, path: str, schema: str | None = None, version: int | None = None) -> DataFrame:
    """A stored table, replaced or plain.  The rows are pinned to the version that is the newest now, or to ``version``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_folder(spark, path, version))


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if there is none.  A damaged table is an error, not a missing one.  Reading changes nothing."""
    try:
        return read(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def refresh_once_a_day(rows: DataFrame, path: str, as_of: Moment = None) -> bool:
    """Full refresh, skipped when the table already holds rows loaded on this day."""
    table = existing(rows.sparkSession, path)
    if table is not None:
        loaded = F.col("load_timestamp")
        day = today(as_of)
        same_day = (loaded >= day.cast("timestamp_ntz")) & (loaded < F.date_add(day, 1).cast("timestamp_ntz"))
        if not table.where(same_day).isEmpty():
            return False
    replace(with_audit(rows, as_of), path)
    return True


def append(rows: DataFrame, path: str, new_by: list[str] | None = None, order: list[str] | None = None) -> None:
    """Append; with ``new_by`` only rows whose key the table does not hold yet, one row per key.

    Of several new rows of a key the first by ``order`` and then by all its other columns is kept, so a repeated
    load keeps the same one.  NULL is a key like any other, so a row without a key gets in once.  A replaced table gets
    the rows into its newest version.
    """
    spark = rows.sparkSession
    if new_by:
        rows = first_by_key(rows, new_by, order)
        table = existing(spark, path)
        if table is not None:
            held = table.select(*[F.col(name).alias(f"_held_{name}") for name in new_by])
            same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_held_{name}")) for name in new_by])
            rows = rows.join(held, same, "left_anti")
    rows.write.mode("append").parquet(_folder(spark, path))


def first_by_key(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key, the first by ``order`` and then by every other column that has an order; partial sums come before the shuffle."""
    ranked = [*(order or []), *[f.name for f in rows.schema.fields
                                if f.name not in keys and f.name not in (order or []) and has_order(f.dataType)]]
    rest = [name for name in rows.columns if name not in keys]
    if not rest:
        return rows.dropDuplicates(keys)
    place = F.struct(*[F.col(name) for name in ranked or rest])
    kept = rows.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(name) for name in rest]), place).alias("_kept"))
    return kept.select(*[F.col(name) if name in keys else F.col(f"_kept.`{name}`").alias(name) for name in rows.columns])


def has_order(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return has_order(kind.elementType)
    if isinstance(kind, StructType):
        return all(has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def save_table(rows: DataFrame, name: str) -> None:
    """Derived table in the session catalog."""
    rows.write.mode("overwrite").saveAsTable(name)


def publish_view(rows: DataFrame, name: str) -> DataFrame:
    """Named lazy view."""
    rows.createOrReplaceTempView(name)
    return rows


def with_audit(rows: DataFrame, as_of: Moment = None, data_source: str | None = None) -> DataFrame:
    """Load time and, where it has a default, the data source; present values stay."""
    columns: dict[str, Column] = {"load_timestamp": clock(as_of)}
    if data_source is not None:
        columns["data_source"] = F.lit(data_source)
    for name in set(columns) & set(rows.columns):
        columns[name] = F.coalesce(F.col(name), columns[name])
    return rows.withColumns(columns)


def load_stats(rows: DataFrame, time: str | None = None, distinct: tuple[str, ...] = (),
               measures: tuple[str, ...] = ()) -> DataFrame:
    """One row: count, first and last time, distinct values, mean, maximum and minimum of measures."""
    out = [F.count(F.lit(1)).alias("row_count")]
    if time:
        out += [F.min(time).alias("earliest"), F.max(time).alias("latest")]
    out += [F.countDistinct(name).alias(f"distinct_{name}") for name in distinct]
    for name in measures:
        out += [F.avg(name).alias(f"avg_{name}"), F.max(name).alias(f"max_{name}"), F.min(name).alias(f"min_{name}")]
    return rows.agg(*out)


def training_stats(training: DataFrame) -> DataFrame:
    return training.agg(
        F.countDistinct("date").alias("days"), F.countDistinct("city").alias("cities"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.sum("accident_count").alias("total_accidents"), F.avg("avg_temp_f").alias("avg_temperature"),
        F.sum("total_precipitation_mm").alias("total_precipitation"))
