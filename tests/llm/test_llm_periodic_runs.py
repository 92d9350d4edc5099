import random
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadrisk.llm import periodic_runs, queries

from .conftest import LONG

SF = "/root/testdata/sf0.001"


def runs_by_hand(x, least_words, least_periods):
    """Every period on its own: maximal stretches of words equal to the word a period later, without those of a shorter period."""
    found = {}
    n = len(x)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            begin = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            if i - begin >= q:
                found.setdefault((begin, i + q - begin), q)  # the smallest period comes first
    return sorted((s, l, q) for (s, l), q in found.items() if l >= max(least_words, least_periods * q))


def planted_by_hand(doc_id, words):
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def by_hand(doc_id, text):
    words = planted_by_hand(doc_id, [w.decode() for w in (text or "").encode().split()])
    found = runs_by_hand(words, 24, 3)
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digest = lambda t: sha256(t.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{l},{q}\n" for s, l, q in found)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("letters, longest", [(1, 60), (2, 40), (3, 60), (6, 200)])
def test_all_runs_against_every_period(letters, longest):
    draw = np.random.default_rng(letters)
    for _ in range(150):
        x = draw.integers(0, letters, draw.integers(0, longest))
        if len(x) > 9 and draw.random() < 0.5:
            a, p = draw.integers(0, len(x) - 4), draw.integers(1, 6)
            x[a:] = np.resize(x[a:a + p], len(x) - a)
        assert [tuple(r) for r in periodic_runs.runs(x, 2, 2).tolist()] == runs_by_hand(x.tolist(), 2, 2)


def test_suffix_order_against_sorting():
    draw = np.random.default_rng(0)
    for n in (0, 1, 2, 50, 200):
        x = draw.integers(0, 3, n)
        order, place, lcp = periodic_runs.suffix_order(x)
        want = sorted(range(n), key=lambda i: x[i:].tolist())
        assert order.tolist() == want and place[order].tolist() == list(range(n))
        for k in range(1, n):
            a, b = x[want[k - 1]:], x[want[k]:]
            m = min(len(a), len(b))
            assert lcp[k] == (m if (a[:m] == b[:m]).all() else int(np.argmax(a[:m] != b[:m])))


def _rows(frame):
    return sorted(((r.doc_id if r.doc_id is not None else -1, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256,
                    r.collapsed_sha256) for r in frame.collect()), key=str)


@pytest.fixture
def answered(spark, documents, monkeypatch):
    def answer(rows):
        frame = documents(rows).repartition(3)
        monkeypatch.setattr(queries, "table", lambda *_: frame)
        return _rows(queries.op13_periodic_runs(spark, ""))
    return answer


def test_query_on_odd_rows(answered, odd_rows):
    rows = [r for r in odd_rows if r[1] != LONG]
    draw = random.Random(2)
    rows += [(i, " ".join(draw.choice("ab c d e é".split()) for _ in range(draw.randint(0, 90)))) for i in range(100, 300)]
    rows += [(9, "a b c " * 30), (9, "a b c " * 30), (11, "x\ty\n" * 12 + "z " + "p q r s t u " * 7), (12, "w " * 5000)]
    # Two runs of the same exponent, and one that ends inside another.
    rows += [(13, "a b " * 12 + "c " + "d e " * 12), (14, "a a b " * 9 + "a " * 30)]
    assert answered(rows) == sorted(((i if i is not None else -1, *by_hand(i, t)) for i, t in rows), key=str)
    assert sum(by_hand(i, t)[0] > 0 for i, t in rows) > 10


def test_very_long_text_and_no_rows(answered):
    (row,) = answered([(5, LONG + " " + "tail end " * 20_000)])
    assert row[1] == 1 and row[2:6] == (30_000, 40_000, 2, 20_000_000)
    assert answered([]) == []


def test_planted_periods(spark, documents):
    rows = [(i, " ".join(f"w{k}" for k in range(40 + i % 9))) for i in range(300)] + [(None, "a b"), (307, None), (330, "")]
    got = {r.doc_id: r.text for r in periodic_runs.with_periods(documents(rows)).collect()}
    assert all((got[i] or "").split() == planted_by_hand(i, (t or "").split()) for i, t in rows)
    assert sum(got[i] != t for i, t in rows) > 20
    assert periodic_runs.periodic_runs(documents(rows).where(F.col("doc_id") == 299)).columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_query_against_brute_force_on_given_rows(spark):
    import pyarrow.parquet as pq
    rows = [r for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = {r[0]: r[1:] for r in _rows(queries.op13_periodic_runs(spark, SF))}
    short = [r for r in rows if len((r["text"] or "").split()) < 500]
    assert len(got) == len(rows) and len(short) > 100
    assert all(got[r["doc_id"]] == by_hand(r["doc_id"], r["text"]) for r in short)
