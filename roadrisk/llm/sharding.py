"""Sharding by a keyed permutation of the row numbers.

A balanced Feistel network over ``2 * half`` bits is a bijection whatever its round function.  Values that leave the
range ``0 .. n-1`` go through it again until they are back inside (cycle walking), so it permutes exactly the ``n`` row
numbers, and ``place % shards`` and ``place // shards`` give shard and slot: shards differ by one row at most, slots have
no gaps, and anybody who knows the row number, ``n`` and the seed computes both without the table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shared import written

ROUNDS = 6
SHARDS = 8
SEED = 20_240_201
POSITION_BITS = 33  # of monotonically_increasing_id, below the partition's number


def _half(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(right: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    x = right * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x & mask


def _keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.SeedSequence(seed).generate_state(ROUNDS, np.uint64)]


def _network(values: np.ndarray, half: int, keys: list[int], back: bool) -> np.ndarray:
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = values >> bits, values & mask
    if back:
        for key in reversed(keys):
            left, right = right ^ _round(left, key, mask), left
    else:
        for key in keys:
            left, right = right, left ^ _round(right, key, mask)
    return left << bits | right


def permute(rows: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """The place of each row number in the shuffle of ``0 .. n-1``; ``back`` gives the row number of each place."""
    half, keys = _half(n), _keys(seed)
    out = np.asarray(rows, dtype=np.uint64).copy()
    walking = np.arange(len(out))
    while len(walking):
        out[walking] = _network(out[walking], half, keys, back)
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def locate(row: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of one row number, without any table."""
    place = int(permute(np.array([row]), n, seed)[0])
    return place % shards, place // shards


def number_rows(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Global numbers ``row_number`` from 0 in the given order, and how many rows there are.

    A range sort splits any key, ties included, by the row's place in the input.  The sorted rows are written before
    they are counted, so a repeated task cannot shift a number.  Rows equal in all of ``order`` should be alike.
    """
    names = rows.columns
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(name).asc_nulls_first() for name in order] + [F.col("_tie")]
    placed = written(
        tied.repartitionByRange(*by).sortWithinPartitions(*by).select(
            *names, F.monotonically_increasing_id().alias("_at")), "numbered")
    part = F.shiftright("_at", POSITION_BITS)
    # One row for each partition of the sort.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")),
                      "offsets")
    number = F.col("_before") + F.col("_at").bitwiseAND((1 << POSITION_BITS) - 1)
    return (placed.withColumn("_part", part).join(offsets, "_part").select(*names, number.alias("row_number")),
            placed.count())


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shard and slot of every document under the law ``rows``: row counts of the shards differ by one at most.

    Row numbers follow (doc_id, size, crc of the text).  Null doc_id sorts first; null text has size 1 and crc 0, as an
    empty text has; repeated rows get places of their own; an empty table gives no rows; other columns are ignored.
    """
    narrow = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"))
    numbered, n = number_rows(narrow, ["doc_id", "size", "text_crc32"])

    def placed(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), n, seed))

    place = F.pandas_udf(placed, T.LongType())

    at = F.col("_place")
    return numbered.withColumn("_place", place("row_number")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (at % shards).cast("int").alias("shard"),
        F.floor(at / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number")
