"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that a Python worker holds split into words at a time.
CHUNK_BYTES = 2_000_000


def small_batches(spark: SparkSession) -> None:
    """Rows of long texts go to Python in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data set."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """One number for a row's content.  Rows that are alike share it, and any verdict on their content."""
    return F.xxhash64(*columns)


def own_name(rows: DataFrame, name: str) -> str:
    """A name for a column that is added for a while: ``name`` after as many underscores as keep it from all others."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def as_bytes(texts: pd.Series) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text stands alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def run_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs between ``starts``, whose last entry is the length; empty runs give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[starts[1:]] - total[starts[:-1]]


def codes_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, and the distinct words."""
    return pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, "int64"), np.zeros(0, object))
