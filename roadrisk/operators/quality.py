"""Data-quality checks that return their failing rows or counts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.times import Moment, clock, hours_before, today


class Check(NamedTuple):
    model: str
    column: str
    kind: str
    accepted: tuple[str, ...] = ()


CHECKS = [Check(model, column, kind, tuple(values.split(",")) if values else ())
          for model, column, kind, values in fixed.rows(fixed.COLUMN_CHECKS, header=False)]


def checks_of(model: str, kind: str | None = None) -> list[Check]:
    return [c for c in CHECKS if c.model == model and kind in (None, c.kind)]


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Non-NULL keys that occur more than once; counted with a map-side combine."""
    return (rows.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs of every listed column, in one pass, as one row per column."""
    wide = rows.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return wide.unpivot([], list(columns), "column_name", "failures")


def unexpected_values(rows: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """Values outside the accepted list with their counts; NULL passes."""
    value = F.col(column).cast("string")
    return rows.where(~value.isin(*accepted)).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n_records"))


def _failures(check: Check) -> Column:
    column = F.col(check.column)
    if check.kind == "not_null":
        return F.count_if(column.isNull())
    return F.count_if(~column.cast("string").isin(*check.accepted))


def run_checks(rows: DataFrame, model: str) -> DataFrame:
    """``model, column_name, check, failures`` for all declared checks of a model, in one pass.

    Every model has one unique key.  Rows are grouped by it, with the failures
    of the other checks summed alongside, so one shuffle serves all checks.
    """
    checks = checks_of(model)
    key = next(c for c in checks if c.kind == "unique")
    others = {f"{c.column}:{c.kind}": c for c in checks if c is not key}
    keyed = rows.groupBy(F.col(key.column).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), *[_failures(c).alias(name) for name, c in others.items()])
    unique = f"{key.column}:unique"
    wide = keyed.agg(
        F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias(unique),
        *[F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for name in others])
    long = wide.unpivot([], [unique, *others], "name", "failures")
    return long.select(F.lit(model).alias("model"), F.split_part("name", F.lit(":"), F.lit(1)).alias("column_name"),
                       F.split_part("name", F.lit(":"), F.lit(2)).alias("check"), "failures")


def date_outliers(accidents: DataFrame, as_of: Moment = None, years: int = fixed.MAX_AGE_YEARS) -> DataFrame:
    """Accidents dated in the future or longer ago than ``years``, with the reason."""
    day, now = F.col("accident_date"), today(as_of)
    oldest = F.add_months(now, -12 * years)
    reason = F.when(day > now, F.lit("Future date")).when(day < oldest, F.lit(f"Too old (>{years} years)"))
    return accidents.select("accident_id", "accident_date", "city", "severity", reason.alias("failure_reason")).where(
        F.col("failure_reason").isNotNull())


def volume_check(rows: DataFrame, key: str, max_duplicate_rate: float = fixed.MAX_DUPLICATE_RATE,
                 min_records: int = fixed.MIN_RECORDS) -> DataFrame:
    """Record count and duplicate rate against the declared thresholds.

    The distinct count comes from a grouping, whose partial step already drops
    most repeats.
    """
    groups = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"),
                        F.count_if(F.col(key).isNotNull()).alias("n_keys"))
    rate = F.when(F.col("n_records") > 0, 1 - F.col("n_keys") / F.col("n_records")).otherwise(F.lit(0.0))
    return totals.select(
        "n_records", "n_keys", rate.alias("duplicate_rate"),
        (rate <= max_duplicate_rate).alias("duplicates_ok"), (F.col("n_records") >= min_records).alias("volume_ok"))


def freshness(rows: DataFrame, time: str = "load_timestamp", as_of: Moment = None,
              warn_hours: int = fixed.FRESH_WARN_HOURS, error_hours: int = fixed.FRESH_ERROR_HOURS) -> DataFrame:
    """Newest load time and its status."""
    newest, now = F.col("newest"), clock(as_of)
    status = (F.when(newest.isNull() | (newest < hours_before(now, error_hours)), F.lit("error"))
              .when(newest < hours_before(now, warn_hours), F.lit("warn")).otherwise(F.lit("pass")))
    return rows.agg(F.max(time).alias("newest")).select("newest", status.alias("status"))


def has_rows(rows: DataFrame) -> DataFrame:
    """One row: whether there is anything; reads a single record."""
    return rows.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))
