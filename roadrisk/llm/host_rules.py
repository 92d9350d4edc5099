"""Quality rules of single documents, and verdicts on whole hosts with shrunken failure rates."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shared import written
from .common import as_bytes, chunks, codes_of, own_name, row_key, run_sums

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MAX_HOST_RATE = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of pairs of numbers, from 0 on and without gaps, so that they can be paired again."""
    return pd.factorize(left * (int(right.max()) + 1) + right)[0]


def repeated_words(codes: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text the words inside windows of ``window`` words found twice or more in it.

    ``window`` is a power of two: windows get exact numbers by pairing those of half the length.
    """
    out = np.zeros(len(starts) - 1, dtype=np.int64)
    if len(codes) < window:
        return out
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    ids, width = codes.astype(np.int64), 1
    while width < window:
        ids, width = _pairs(ids[:-width], ids[width:]), 2 * width
    inside = owner[: len(ids)] == owner[window - 1:]
    at = np.flatnonzero(inside)
    again = at[pd.Series(ids[at] * len(starts) + owner[at]).duplicated(keep=False).to_numpy()]
    edge = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return run_sums((np.cumsum(edge[:-1]) > 0).astype(np.int64), starts)


def counted(texts: pd.Series) -> pd.DataFrame:
    """The five counts of each text."""
    rows = as_bytes(texts)
    out = np.zeros((len(rows), 5), dtype=np.int64)
    for i, (text, raw) in enumerate(zip(texts, rows)):
        if raw:
            words = raw.split()
            lines = [line for line in raw.split(b"\n") if line.strip()]
            out[i] = (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), 0)
            if not text.isascii():
                out[i, 1] = sum(map(len, (b"".join(words)).decode("utf-8", "surrogatepass")))
    for a, b in chunks(rows):
        starts = np.concatenate([[0], np.cumsum(out[a:b, 0])])
        codes, _ = codes_of([word for raw in rows[a:b] for word in raw.split()])
        out[a:b, 4] = repeated_words(codes, starts)
    return pd.DataFrame(out, columns=list(COUNTS))


count_rules = F.pandas_udf(counted, T.StructType([T.StructField(name, T.LongType()) for name in COUNTS]))


class Prior(NamedTuple):
    """A Beta prior as its mean and its weight in documents; an infinite weight means that hosts do not differ."""

    mean: float
    weight: float


def fitted_prior(hosts: DataFrame) -> Prior:
    """The empirical Beta prior of the hosts' failure rates, by moments weighted with the hosts' sizes.

    Of the spread between the rates, the part that chance makes in hosts of these sizes is taken off first.
    """
    rate = F.col("failed") / F.col("docs")
    row = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum("docs").alias("n"), F.sum("failed").alias("f"),
                    F.sum(F.col("failed") * rate).alias("s")).first()
    if not row["n"]:
        return Prior(0.0, float("inf"))
    mean = row["f"] / row["n"]
    within, total = mean * (1 - mean), row["s"] - row["n"] * mean * mean
    chance = (row["k"] - 1) * within
    between = (total - chance) / max(row["n"] - row["k"], 1)
    return Prior(mean, within / between - 1 if between > 1e-12 and within > between else
                 (1e-9 if between > 1e-12 else float("inf")))


def measured(docs: DataFrame) -> DataFrame:
    """The narrow table of counts: doc_id, host, row key, five counts and ``base_failed``.  Written, texts left out."""
    return written(docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("host"), row_key("doc_id", "text", "source").alias("row"),
        count_rules("text").alias("c")).select(
        "doc_id", "host", "row", "c.*",
        ((F.col("c.n_words") < MIN_WORDS)
         | (100 * F.col("c.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("c.n_words"))).alias("base_failed")), "rules")


def host_verdicts(rules: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per host: docs, failed, its shrunken failure rate and whether it is refused.  Written: one row per host."""
    hosts = written(rules.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts")
    prior = fitted_prior(hosts)
    if prior.weight == float("inf"):
        rate = F.lit(prior.mean)
    else:
        rate = (F.col("failed") + prior.mean * prior.weight) / (F.col("docs") + prior.weight)
    return written(hosts.withColumn("host_rate", rate).withColumn("host_refused", F.col("host_rate") > max_rate),
                   "verdicts")


def judge(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Every document with its counts, its own failure, its host's rate and the verdict ``kept``.

    A document stays if it passes its own rules and its host is not refused.  Null text has no words and fails; null and
    empty source are one nameless host; repeated rows count each time; an empty table gives no rows; other columns are
    ignored.  The table of hosts is a stored aggregate, so Spark broadcasts it only if its real size allows.
    """
    rules = measured(docs)
    return rules.join(host_verdicts(rules, max_rate), "host", "left").withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce("host_refused", F.lit(False)))


def keep_documents(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns."""
    row = own_name(docs, "row")
    kept = written(judge(docs, max_rate).where("kept").select(F.col("row").alias(row)).distinct(), "kept")
    return docs.withColumn(row, row_key("doc_id", "text", "source")).join(kept, row, "left_semi").drop(row)
