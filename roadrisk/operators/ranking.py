"""Row numbers over a whole table or over few large groups (F3, F4) without one big sort task.

All rankings share one range-partitioned sort of narrow entries, one per row
and ranking: one sample of the input gives the splitters of all orders, and
one shuffle moves the entries.  The position of an entry inside its partition
is known from the sort; the partition's offset is a sum over one small row per
partition, ranking and group.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written


class Ranking(NamedTuple):
    """``row_number`` by one value, highest and NULL first, then by the tie-break columns."""

    name: str
    value: str
    within: str | None = None


def _sorted(rows: DataFrame, rankings: list[Ranking], ties: list[str], partitions: int | None) -> DataFrame:
    entries = F.array(*[F.struct(
        F.lit(place).alias("_ranking"),
        (F.col(r.within).cast("string") if r.within else F.lit(None).cast("string")).alias("_group"),
        F.col(r.value).cast("double").alias("_value")) for place, r in enumerate(rankings)])
    narrow = rows.select(F.explode(entries).alias("_entry"), *ties).select("_entry.*", *ties)
    order = [F.col("_ranking"), F.col("_group").asc_nulls_last(), F.col("_value").desc_nulls_first(),
             *[F.col(name) for name in ties]]
    # Without a number adaptive execution sizes the ranges by the data.  The order ends with the unique row key, so the
    # splitters also cut through equal values.
    ranged = narrow.repartitionByRange(*order) if partitions is None else narrow.repartitionByRange(partitions, *order)
    # monotonically_increasing_id numbers the rows of a partition in sort order.
    return ranged.sortWithinPartitions(*order).select(
        "_ranking", "_group", ties[-1], F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_seq"))


def row_numbers(rows: DataFrame, rankings: list[Ranking], ties: list[str], partitions: int | None = None) -> DataFrame:
    """One row per row key with one column per ranking.

    ``rows`` must be a written table; the last of ``ties`` is its unique row key.
    """
    key = ties[-1]
    # Written, because the offsets and the positions must come from the same sort.
    placed = written(_sorted(rows, rankings, ties, partitions), "rankings")

    # One row per ranking, group and partition: at most partitions + groups of all rankings.
    slots = placed.groupBy("_ranking", "_group", "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
    earlier = Window.partitionBy("_ranking", "_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slots.select(
        F.col("_ranking"), F.col("_group"), F.col("_part"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))

    same = ((F.col("p._ranking") == F.col("o._ranking")) & (F.col("p._part") == F.col("o._part"))
            & F.col("p._group").eqNullSafe(F.col("o._group")))
    numbered = placed.alias("p").join(written(offsets, "offsets").alias("o"), same).select(
        F.col(f"p.{key}"), F.col("p._ranking"), (F.col("p._seq") + F.col("o._shift")).alias("_number"))

    def picked(place: int) -> Column:
        return F.max(F.when(F.col("_ranking") == place, F.col("_number")))

    return numbered.groupBy(key).agg(*[picked(place).alias(r.name) for place, r in enumerate(rankings)])
