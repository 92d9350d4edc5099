import random

import numpy as np
import pandas as pd
import pytest
from zlib import crc32

from roadrisk.llm import factorisation, weak_labels


def may_learn(doc_id):
    return crc32(str(doc_id).encode()) % 5 != 0


def prose(rng, n, extra=()):
    words = [f"{rng.choice('bcdfghklmnprst')}{rng.choice('aeiou')}{rng.choice(['n', 'r', 'st', 'lo'])}" for _ in range(n)]
    for word in extra:
        words.insert(rng.randrange(len(words)), word)
    return " ".join(words)


def test_linear_time_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    texts = factorisation.featured([b"one two two THREE ###", b"", b"a b c d e f\na b c d e f"])
    size = len(factorisation.STATISTICS) * factorisation.BINS + factorisation.BUCKETS
    machine = factorisation.Machine(rng.normal(0, 1, (len(factorisation.STATISTICS), factorisation.BINS - 1)).cumsum(1),
                                    0.3, rng.normal(size=size), rng.normal(0, 0.1, (size, 3)))
    place, value, starts = factorisation.inputs(texts, machine.cuts)
    for row, got in enumerate(machine.raw(texts)):
        p, x = place[starts[row]:starts[row + 1]], value[starts[row]:starts[row + 1]]
        pairs = sum(machine.factors[p[i]] @ machine.factors[p[j]] * x[i] * x[j]
                    for i in range(len(p)) for j in range(i + 1, len(p)))
        assert np.isclose(got, 0.3 + machine.weights[p] @ x + pairs)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    rows = []
    for i in range(500):
        kind = rng.random()
        toxic = ["nastiest", "vermin" + rng.choice(["ly", "ous", "ish"])] if i % 4 == 0 else []
        text = prose(rng, rng.randrange(40, 200), toxic * rng.randrange(1, 3))
        if kind < 0.15:
            text = text.upper().replace(" ", "!! ")
        elif kind < 0.3:
            text = text.replace(" ", "### ")
        rows.append((i, text, 0 if kind < 0.3 else 1, 1 if toxic else 0))
    return rows


def frames(spark, documents, corpus):
    docs = documents([r[:2] for r in corpus])
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in corpus], "doc_id long, quality int, toxic int")
    return docs, labels


def accuracy(out, truth):
    held = [r for r in out if r.held_out]
    assert held and {r.doc_id for r in held} == {i for i in truth if not may_learn(i)}
    return sum(r.predicted == truth[r.doc_id] for r in held) / len(held)


def test_quality_is_learned_and_held_out_labels_are_not_used(spark, documents, corpus):
    docs, labels = frames(spark, documents, corpus)
    out = factorisation.quality(docs, labels).collect()
    assert accuracy(out, {r[0]: r[2] for r in corpus}) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    # Turned labels of held-out rows change nothing.
    turned = spark.createDataFrame([(r[0], r[2] if may_learn(r[0]) else 1 - r[2], 0) for r in corpus],
                                   "doc_id long, quality int, toxic int")
    again = factorisation.quality(docs.repartition(5), turned).collect()
    scores = {r.doc_id: r.score for r in again}
    assert all(abs(scores[r.doc_id] - r.score) < 1e-9 for r in out)


def test_the_fit_sees_all_words_of_a_long_text():
    text = " ".join(f"w{i}" for i in range(3000))
    (frame,) = factorisation._sampled(iter([pd.DataFrame({"text": [text, "a b"], "label": [1.0, 0.0]})]))
    whole = factorisation.featured([text.encode(), b"a b"])
    assert [len(b) for b in frame["buckets"]] == [3000, 2]
    assert all(sorted(b) == sorted(whole.buckets[s:e])
               for b, s, e in zip(frame["buckets"], whole.starts[:-1], whole.starts[1:]))


def test_toxicity_is_learned_from_votes(spark, documents, corpus):
    docs, labels = frames(spark, documents, corpus)
    out = weak_labels.toxicity(docs, labels).collect()
    assert accuracy(out, {r[0]: r[3] for r in corpus}) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_label_model_finds_accuracies_and_copies_of_voters():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.3

    def voter(hit, false):
        return np.where(rng.random(4000) < np.where(truth, hit, false), 1, 0)

    first = voter(0.8, 0.02)
    votes = np.stack([first, voter(0.6, 0.05), voter(0.5, 0.03), first, first, voter(0.7, 0.02)], 1).astype(np.int8)
    model = weak_labels.label_model(votes, 0.3)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93
    assert model.weight[0] < 0.6 * model.weight[1]
    assert model.correlation[0, 3] > 0.9


@pytest.mark.parametrize("score, column", [(factorisation.quality, "quality"), (weak_labels.toxicity, "toxic")])
def test_odd_rows(spark, documents, odd_rows, score, column):
    docs = documents(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 0, 0), (2, None, None), (4, 1, 1), (4, 0, 0), (6, 1, 0), (None, 1, 1), (7, 0, 1)],
                                 "doc_id long, quality int, toxic int")
    for labels in (none, some):
        out = score(docs, labels).collect()
        assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
        assert [r.held_out for r in out if r.doc_id is None] == [False, False]
        alike = {round(r.score, 12) for r in out if r.doc_id in (1, 2)}
        assert len(alike) == 1
        assert score(documents([]), labels).count() == 0
    if column == "quality":
        assert {r.score for r in score(docs, none).collect()} == {0.5}
    else:
        assert {r.predicted for r in score(docs, none).collect()} == {0}


def test_an_id_on_very_many_rows_counts_once(spark, documents):
    docs = documents([(3, f"text {i % 7} of one id") for i in range(20_000)] + [(5, None), (6, "other"), (6, None)])
    labels = spark.createDataFrame([(i, 1.0) for i in (3, 5, 6)], "doc_id long, quality double")
    held = [i for i in (3, 5, 6) if may_learn(i)]
    got = factorisation.labelled_sample(docs, labels, "quality", 10).collect()
    assert sorted(str(r.text) for r in got) == sorted({3: "text 0 of one id", 5: "None", 6: "other"}[i] for i in held) and held


def test_every_entry_that_qualifies_votes():  # fifty features on eight rows each
    features = [np.array([i, 1000 + i // 8]) for i in range(400)] + [np.array([5000])] * 400
    labels = np.array([1.0] * 400 + [0.0] * 400)
    entries = weak_labels.lexicon(features, labels)
    assert entries.tolist() == list(range(1000, 1050))
    votes = weak_labels.votes_of(features, entries)
    assert (votes[:400] == 1).any(axis=1).all() and (votes[400:, -1] == -1).all()


def test_label_model_against_a_second_computation():
    rng = np.random.default_rng(8)
    votes = rng.integers(-1, 2, (60, 4)).astype(np.int8)
    model = weak_labels.label_model(votes, 0.4)
    for row, got in zip(votes, model.posterior(votes)):
        one, zero = model.prior, 1 - model.prior
        for voter, vote in enumerate(row):
            one *= model.chance[1, voter, vote + 1] ** model.weight[voter]
            zero *= model.chance[0, voter, vote + 1] ** model.weight[voter]
        assert got == pytest.approx(one / (one + zero))
