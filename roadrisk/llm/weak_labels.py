"""Toxicity by weak supervision.

Voters: each entry of a lexicon that labelled rows suggest votes "toxic" where it occurs, patterns of several entries
vote too, and the absence of all entries votes "clean".  A generative label model estimates each voter's accuracy
without looking at labels, by expectation maximisation over the votes, and the correlations that remain between voters
once the class is known; a voter counts the less the more it repeats others.  Its posterior is the target of a linear
classifier over hashed words and word beginnings, which scores every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, held_out, run_sums
from .factorisation import calibrated, labelled_sample

BUCKETS = 1 << 20
SAMPLE_ROWS = 8_000  # labelled rows at most that the lexicon is taken from, and rows that the models are fitted on
LEAST_SUPPORT = 4
LEAST_ODDS = 2.5  # log of the odds ratio
BEGINNINGS = (4, 5, 6)
ROUNDS = 25
EPOCHS = 20
BATCH = 64
NO_LABELS = 1e-3  # share of the class that is assumed without any label
RATE, SPARSITY, PENALTY = 0.3, 0.15, 1e-3
LIMIT = 0.5
WORD = re.compile(r"\w+")


class Words(NamedTuple):
    """Distinct words of some texts: their features (words x 4 hashes), and which words each text has."""

    hashes: np.ndarray
    code: np.ndarray
    starts: np.ndarray


def hashed(texts: list[str]) -> Words:
    """Hashes of each distinct word and of its beginnings; a short word has its own hash again as beginning."""
    split = [WORD.findall(t.lower()) for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = [w for per in split for w in per]
    if not flat:
        return Words(np.zeros((0, 4), np.int64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    code, words = pd.factorize(np.array(flat, dtype=object))
    owner = np.repeat(np.arange(len(texts)), counts)
    pair = pd.unique(owner * len(words) + code)
    out = np.empty((len(words), 1 + len(BEGINNINGS)), dtype=np.int64)
    for i, word in enumerate(words):
        out[i, 0] = crc32(b"w" + word.encode("utf-8", "surrogatepass"))
        for j, n in enumerate(BEGINNINGS, 1):
            # One bucket per beginning and length; words no longer than that have no beginning (-1).
            out[i, j] = crc32(b"%d" % n + word[:n].encode("utf-8", "surrogatepass")) if len(word) > n else -1
    per = np.bincount(pair // len(words), minlength=len(texts))
    return Words(np.where(out < 0, -1, out % BUCKETS), pair % len(words), np.concatenate([[0], np.cumsum(per)]))


def _str_chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > CHUNK_BYTES:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def _sampled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [t if isinstance(t, str) else "" for t in frame["text"]]
        for a, b in _str_chunks(texts):
            words = hashed(texts[a:b])
            each = [words.hashes[words.code[s:e]].ravel() for s, e in zip(words.starts[:-1], words.starts[1:])]
            yield pd.DataFrame({"label": frame["label"].to_numpy()[a:b],
                                "features": [np.unique(x[x >= 0]).astype(np.int32) for x in each]})


def _frequency(features: list[np.ndarray]) -> np.ndarray:
    return np.bincount(np.concatenate([*features, np.zeros(0, np.int64)]), minlength=BUCKETS)


def lexicon(features: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Every feature that enough rows of label 1 have and that speaks for this label."""
    toxic = [f for f, y in zip(features, labels) if y > 0.5]
    clean = [f for f, y in zip(features, labels) if y <= 0.5]
    one, zero = _frequency(toxic), _frequency(clean)
    odds = np.log((one + 0.5) / (len(toxic) + 1)) - np.log((zero + 0.5) / (len(clean) + 1))
    return np.flatnonzero((one >= LEAST_SUPPORT) & (odds >= LEAST_ODDS))


def votes_of(features: list[np.ndarray], entries: np.ndarray) -> np.ndarray:
    """1 toxic, -1 clean, 0 no vote: one voter per entry, three that look at several, one for the absence of all."""
    place = np.full(BUCKETS, -1)
    place[entries] = np.arange(len(entries))
    votes = np.zeros((len(features), len(entries) + 4), dtype=np.int8)
    for i, f in enumerate(features):
        hit = place[f]
        hit = hit[hit >= 0]
        votes[i, hit] = 1
        votes[i, -4] = 1 if len(hit) >= 2 else 0
        votes[i, -3] = 1 if len(hit) >= 3 else 0
        votes[i, -2] = 1 if len(hit) > 0.02 * len(f) and len(hit) else 0
        votes[i, -1] = 0 if len(hit) else -1
    return votes


class LabelModel(NamedTuple):
    """Share of the class, chance of each vote (-1, 0, 1) given the class, weight of each voter."""

    prior: float
    chance: np.ndarray  # class x voter x vote
    weight: np.ndarray
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.log(self.chance)
        each = np.arange(votes.shape[1])
        odds = ((log[1, each, votes + 1] - log[0, each, votes + 1]) * self.weight).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds + np.log(self.prior / (1 - self.prior)), -30, 30)))


def label_model(votes: np.ndarray, prior: float) -> LabelModel:
    """Accuracies and correlations of the voters from their votes alone, started from a majority of the votes."""
    p = np.where((votes == 1).any(axis=1), 0.9, 0.05 if len(votes) else 0.5)
    voters = votes.shape[1]
    weight, correlation = np.ones(voters), np.eye(voters)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    chance = np.full((2, voters, 3), 1 / 3)
    for step in range(ROUNDS if len(votes) else 0):
        given = np.stack([1 - p, p])
        counted = np.stack([given @ (votes == v) for v in (-1, 0, 1)], axis=2)
        chance = (counted + 0.1) / (given.sum(axis=1)[:, None, None] + 0.3)
        model = LabelModel(prior, chance, weight, correlation)
        p = model.posterior(votes)
        prior = float(np.clip((p.sum() + 1) / (len(p) + 2), 1e-3, 1 - 1e-3))
        if step in (ROUNDS // 3, 2 * ROUNDS // 3):
            mean = chance[:, :, 2] - chance[:, :, 0]
            rest = votes - (p[:, None] * mean[1] + (1 - p)[:, None] * mean[0])
            scale = np.sqrt(np.maximum((rest * rest).mean(axis=0), 1e-9))
            correlation = (rest.T @ rest) / max(len(votes), 1) / np.outer(scale, scale)
            shared = np.clip(correlation - np.diag(np.diag(correlation)), 0, 1)
            weight = 1 / (1 + shared.sum(axis=1))
    return LabelModel(prior, chance, weight, correlation)


class Linear(NamedTuple):
    """Bias and weights of hashed features, slope and shift of the calibration."""

    bias: float
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def score(self, words: Words) -> np.ndarray:
        each = np.where(words.hashes >= 0, self.weights[words.hashes], 0.0).sum(axis=1)
        raw = self.bias + run_sums(each[words.code], words.starts)
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))


def linear(features: list[np.ndarray], target: np.ndarray, seed: int = 1) -> Linear:
    """Logistic regression on soft labels by follow-the-regularised-leader, which keeps most weights at zero.

    Weights are not negative: clean words speak for nothing, so no length of clean text outweighs the toxic words in it.
    """
    draw = np.random.default_rng(seed)
    z, n, weights = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS)
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3)) if len(target) else NO_LABELS
    bias, seen, limit = np.log(share / (1 - share)), 1.0, SPARSITY * np.sqrt(len(target))
    for _ in range(EPOCHS if len(target) else 0):
        order = draw.permutation(len(target))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            flat = np.concatenate([features[i] for i in batch])
            per = np.array([len(features[i]) for i in batch])
            bounds = np.concatenate([[0], np.cumsum(per)])
            loss = 1 / (1 + np.exp(-np.clip(bias + run_sums(weights[flat], bounds), -30, 30))) - target[batch]
            used, inverse = np.unique(flat, return_inverse=True)
            slope = np.bincount(inverse, np.repeat(loss, per), len(used))
            sigma = (np.sqrt(n[used] + slope * slope) - np.sqrt(n[used])) / RATE
            z[used] += slope - sigma * weights[used]
            n[used] += slope * slope
            weights[used] = np.maximum(-(z[used] + limit), 0.0) / (PENALTY + (0.1 + np.sqrt(n[used])) / RATE)
            step = float(loss.sum())
            seen += step * step
            bias -= RATE * step / np.sqrt(seen)
    if not len(target):
        return Linear(float(bias), weights.astype(np.float32))
    raw = np.array([bias + weights[f].sum() for f in features])
    return Linear(float(bias), weights.astype(np.float32), *calibrated(raw, (target > 0.5).astype(float)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[Linear, LabelModel]:
    """Lexicon from a bounded sample of labelled rows, then label model and classifier from votes on those texts."""
    sample = labelled_sample(docs, labels, "toxic", rows).mapInPandas(
        _sampled, "label double, features array<int>").toArrow().to_pandas()
    sample = sample.assign(_k=[crc32(f.tobytes()) for f in sample["features"]]).sort_values(["_k", "label"])
    features, known = [f.astype(np.int64) for f in sample["features"]], sample["label"].to_numpy()
    votes = votes_of(features, lexicon(features, known))
    model = label_model(votes, float(known.mean()) if len(known) else NO_LABELS)
    return linear(features, model.posterior(votes)), model


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Each document with ``held_out``, its score from 0 to 1 and the prediction (1 from 0.5 on).

    Null and empty texts have no words and get the score of the bias alone.  Repeated rows score alike; an id that has
    several labels counts with the highest.  Without labels no lexicon exists and all scores are low.  An empty table
    gives no rows; other columns are ignored.
    """
    classifier = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows)[0])

    def scored(texts: pd.Series) -> pd.Series:
        plain = [t if isinstance(t, str) else "" for t in texts]
        parts = [classifier.value.score(hashed(plain[a:b])) for a, b in _str_chunks(plain)]
        return pd.Series(np.concatenate([*parts, np.zeros(0)]))

    return docs.select("doc_id", held_out().alias("held_out"), F.pandas_udf(scored, T.DoubleType())("text").alias("score")
                       ).withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))
