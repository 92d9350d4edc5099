"""Quality scores by a factorisation machine.

``score = sigmoid(b + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum (v_if x_i)^2))``: every pair of features interacts
through low-rank factors, and the sum over pairs is got in linear time from the sum and the sum of squares.  Features are
hashed words (each distinct word once, scaled by the root of their number), bins of structure statistics of the whole
text (lengths, capitals, symbols, repeats, lines) and of its metadata (size, bytes per code point).  Labels, language,
source and id are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from zlib import crc32

from .common import as_bytes, chunks, codes_of, held_out, run_sums
from .host_rules import repeated_words

BUCKETS = 1 << 15
RANK = 6
BINS = 12
SAMPLE_ROWS = 8_000  # labelled rows at most that the machine is fitted on, the same for any size of the corpus
STEPS = 1_000  # at least, and 12 passes
EPOCHS = 12
BATCH = 128
RATE = 0.08
PENALTY = 2e-3
LIMIT = 0.3  # score from which label 1 is predicted
STATISTICS = ("log_words", "word_length", "distinct", "top_word", "capitals", "symbols", "digits", "marked_words",
              "shouting", "same_as_last", "repeated", "repeated_lines", "words_a_line", "log_bytes", "bytes_a_point")

_BYTE = np.arange(256)
UPPER = ((_BYTE >= 65) & (_BYTE <= 90)).astype(np.int64)
LETTER = UPPER + ((_BYTE >= 97) & (_BYTE <= 122))
DIGIT = ((_BYTE >= 48) & (_BYTE <= 57)).astype(np.int64)
SYMBOL = np.isin(_BYTE, np.frombuffer(b"#*$%&|<>!~^_=+{}[]\\@", np.uint8)).astype(np.int64)
POINT = ((_BYTE & 0xC0) != 0x80).astype(np.int64)


class Texts(NamedTuple):
    """Features of some texts: statistics, and the hashed distinct words of each."""

    statistics: np.ndarray
    buckets: np.ndarray
    starts: np.ndarray



def featured(texts: list[bytes]) -> Texts:
    """Statistics and hashed words of whole texts; an empty text has zeros and no words."""
    split = [t.split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    starts = np.concatenate([[0], np.cumsum(counts)])
    codes, words = codes_of([w for per in split for w in per])
    out = np.zeros((len(texts), len(STATISTICS)))
    if not len(codes):
        return Texts(out, np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
    raw = np.frombuffer(b"".join(words), np.uint8)
    upper, letter, digit, symbol, points = (run_sums(of[raw], bounds) for of in (UPPER, LETTER, DIGIT, SYMBOL, POINT))
    shout = (letter > 1) & (upper == letter)
    owner = np.repeat(np.arange(len(texts)), counts)
    pair = np.unique(owner * len(words) + codes, return_counts=True)
    pair_owner = pair[0] // len(words)
    n = np.maximum(counts, 1)

    def share(of: np.ndarray) -> np.ndarray:
        return run_sums(of[codes].astype(np.int64), starts)

    size = share(points)
    again = np.zeros(len(codes), dtype=np.int64)
    again[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    most = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(most, pair_owner, pair[1])
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    many = np.array([max(len(x), 1) for x in lines])
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    distinct = np.bincount(pair_owner, minlength=len(texts))
    out[:] = np.stack([
        np.log1p(counts), size / n, distinct / n, most / n, share(upper) / np.maximum(share(letter), 1),
        share(symbol) / np.maximum(size, 1), share(digit) / np.maximum(size, 1), share(symbol > 0) / n, share(shout) / n,
        run_sums(again, starts) / n, repeated_words(codes, starts) / n,
        np.array([1 - len(set(x)) / max(len(x), 1) for x in lines]), counts / many, np.log1p(length),
        length / np.maximum(size + n - 1, 1)], axis=1)
    hashed = np.fromiter((crc32(w.lower()) % BUCKETS for w in words), np.int64, len(words))
    return Texts(out, hashed[pair[0] % len(words)], np.concatenate([[0], np.cumsum(distinct)]))


class Machine(NamedTuple):
    """Cuts of the statistics' bins, bias, weights and factors of bins and words, slope and shift of the calibration."""

    cuts: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def score(self, texts: Texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(texts) + self.shift, -30, 30)))

    def raw(self, texts: Texts) -> np.ndarray:
        place, value, starts = inputs(texts, self.cuts)
        linear = run_sums(self.weights[place] * value, starts)
        scaled = self.factors[place] * value[:, None]
        total = run_sums(scaled, starts)
        squares = run_sums((scaled * scaled).sum(axis=1), starts)
        return self.bias + linear + ((total * total).sum(axis=1) - squares) / 2


def calibrated(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn raw values into chances: a logistic fit to labels drawn in from 0 and 1 a little."""
    ones = labels.sum()
    target = np.where(labels > 0.5, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x, at = np.stack([raw, np.ones(len(raw))], axis=1), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, x.T @ (p - target) + 1e-3 * (at - [1.0, 0.0]))
        at = at - move * min(1.0, 1.0 / np.abs(move).max())
        if np.abs(move).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def inputs(texts: Texts, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All features of each text as places, values and bounds: a bin of each statistic, then its words."""
    rows, stats = texts.statistics.shape
    bins = np.stack([np.searchsorted(cuts[s], texts.statistics[:, s], side="right") + s * BINS for s in range(stats)], 1)
    per = np.diff(texts.starts)
    starts = np.concatenate([[0], np.cumsum(per + stats)])
    place = np.empty(starts[-1], dtype=np.int64)
    value = np.empty(starts[-1])
    own = (starts[:-1, None] + np.arange(stats)).ravel()
    rest = np.ones(len(place), dtype=bool)
    rest[own] = False
    place[own], value[own] = bins.ravel(), 1 / np.sqrt(stats)
    place[rest], value[rest] = texts.buckets + stats * BINS, np.repeat(1 / np.sqrt(np.maximum(per, 1)), per)
    return place, value, starts


def fitted(texts: Texts, labels: np.ndarray, seed: int = 1) -> Machine:
    """AdaGrad on the logistic loss over all distinct words of each row, as they are scored."""
    draw = np.random.default_rng(seed)
    rows, stats = texts.statistics.shape
    marks = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = np.quantile(texts.statistics, marks, axis=0).T if rows else np.zeros((stats, BINS - 1))
    place, value, starts = inputs(texts, cuts)
    size = stats * BINS + BUCKETS
    weights, factors = np.zeros(size), draw.normal(0, 0.05 if rows else 0.0, (size, RANK))
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3) if rows else 0.5
    bias, seen, seen_f = float(np.log(share / (1 - share))), np.full(size, 1e-4), np.full((size, RANK), 1e-4)
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // rows)) if rows else 0):
        order = draw.permutation(rows)
        for at in range(0, rows, BATCH):
            batch = order[at:at + BATCH]
            per = starts[batch + 1] - starts[batch]
            bounds = np.concatenate([[0], np.cumsum(per)])
            index = np.repeat(starts[batch] - bounds[:-1], per) + np.arange(bounds[-1])
            p, x = place[index], value[index]
            scaled = factors[p] * x[:, None]
            total = run_sums(scaled, bounds)
            raw = bias + run_sums(weights[p] * x, bounds) + (
                (total * total).sum(1) - run_sums((scaled * scaled).sum(1), bounds)) / 2
            loss = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]
            each = np.repeat(loss, per) * x
            used, inverse = np.unique(p, return_inverse=True)
            slope = np.bincount(inverse, each, len(used)) / len(batch) + PENALTY * weights[used] / 10
            wide = each[:, None] * (np.repeat(total, per, axis=0) - scaled)
            slope_f = np.stack([np.bincount(inverse, wide[:, f], len(used)) for f in range(RANK)], 1) / len(batch)
            slope_f += PENALTY * factors[used]
            seen[used] += slope * slope
            seen_f[used] += slope_f * slope_f
            weights[used] -= RATE * slope / np.sqrt(seen[used])
            factors[used] -= RATE * slope_f / np.sqrt(seen_f[used])
            bias -= RATE * float(loss.mean())
    machine = Machine(cuts, bias, weights, factors.astype(np.float32))
    return machine._replace(**dict(zip(("slope", "shift"), calibrated(machine.raw(texts), labels)))) if rows else machine


def _sampled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = as_bytes(frame["text"])
        for a, b in chunks(texts):
            held = featured(texts[a:b])
            yield pd.DataFrame({
                "label": frame["label"].to_numpy()[a:b], "statistics": list(held.statistics),
                "buckets": [np.sort(held.buckets[s:e]).astype(np.int32)
                            for s, e in zip(held.starts[:-1], held.starts[1:])]})


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents that may be learned from, the same ones on every run: text and label.

    The ids are chosen first, from the narrow table of labels, by the order of their hashes.  An id that stands on several rows
    counts once, with its smallest text.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("label").alias("label")).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Machine:
    """Fit the machine on a bounded sample of labelled documents; only their features reach the driver."""
    sample = labelled_sample(docs, labels, label, rows).mapInPandas(
        _sampled, "label double, statistics array<double>, buckets array<int>").toArrow().to_pandas()
    # Fixed order, whatever the order of the tasks' results.
    sample = sample.assign(_k=[crc32(b.tobytes()) for b in sample["buckets"]]).sort_values(["_k", "label"])
    per = [len(b) for b in sample["buckets"]]
    texts = Texts(np.array(sample["statistics"].tolist()).reshape(-1, len(STATISTICS)),
                  np.concatenate([*sample["buckets"], np.zeros(0)]).astype(np.int64),
                  np.concatenate([[0], np.cumsum(per)]).astype(np.int64))
    return fitted(texts, sample["label"].to_numpy())


def quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Each document with ``held_out``, its score from 0 to 1 and the prediction (1 from 0.3 on).

    Null and empty texts are scored by their statistics, all zero.  Repeated rows score alike; an id that has several
    labels counts with the best.  Without any label to learn from, all scores are one half.  An empty table gives no
    rows; other columns are ignored.
    """
    machine = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows=rows))

    def scored(texts: pd.Series) -> pd.Series:
        raw = as_bytes(texts)
        parts = [machine.value.score(featured(raw[a:b])) for a, b in chunks(raw)]
        return pd.Series(np.concatenate([*parts, np.zeros(0)]))

    return docs.select("doc_id", held_out().alias("held_out"), F.pandas_udf(scored, T.DoubleType())("text").alias("score")
                       ).withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))
