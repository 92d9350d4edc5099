import hashlib
import random

import numpy as np
import pytest

from roadrisk.llm import suffix_dedup

LENGTH, GRAM = 20, 8


def brute(rows, length, first=False):
    places = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    texts = [(t or "").encode() for _, t in rows]
    for i in order:
        for s in range(len(texts[i]) - length + 1):
            places.setdefault(texts[i][s:s + length], []).append((i, s))
    out = []
    for i, text in enumerate(texts):
        hit = np.zeros(len(text), bool)
        for s in range(len(text) - length + 1):
            found = places[text[s:s + length]]
            if len(found) > 1 and not (first and found[0] == (i, s)):
                hit[s:s + length] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~hit])
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out.append((str(rows[i][0]), len(text), int(hit.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(documents, rows, keep="none"):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in suffix_dedup.dedup(documents(rows), LENGTH, GRAM, keep).collect())


def repetitive(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 5)))
    passages = [" ".join(word() for _ in range(rng.randrange(4, 20))) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [" ".join(word() for _ in range(rng.randrange(12))) for _ in range(3)]
        parts[1:1] = rng.sample(passages, rng.randrange(3))
        rows.append((i, " ".join(parts)))
    return rows + [(100 + i, rows[i][1]) for i in range(4)] + [(200, "xyz" * 40), (201, "b" * 90)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [2, 2000])
def test_spans_equal_brute_force(documents, monkeypatch, keep, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = repetitive(5)
    assert found(documents, rows, keep) == brute(rows, LENGTH, keep == "first")


def test_odd_rows(documents, odd_rows):
    assert found(documents, odd_rows) == brute(odd_rows, LENGTH)
    assert found(documents, []) == []
    with pytest.raises(ValueError):
        found(documents, odd_rows, "some")


def test_long_texts_are_looked_at_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 50)
    text = bytes(random.Random(1).choices(b"ab", k=333))
    parts, owner, shift = suffix_dedup._pieces([text, b"xy"], None, LENGTH)
    assert owner == [0] * 7 + [1] and all(text[s:s + len(p)] == p for p, s in zip(parts[:-1], shift))
    starts = []
    for part, at in zip(parts, shift):
        got = suffix_dedup.anchors([part], LENGTH, GRAM)
        starts += [at + s for a, b in zip(got.first, got.last) for s in range(a, b + 1)]
    assert starts == list(range(len(text) - LENGTH + 1))


@pytest.mark.parametrize("seed", range(3))
def test_factors_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    raw = rng.integers(97, 99, 120).astype(np.uint8)
    position = rng.permutation(120)
    chosen = np.sort(rng.choice(120, 90, replace=False))
    lpf, later = suffix_dedup.previous_and_later_factors(raw, position, chosen, 16)

    def shared(a, b):
        n = 0
        while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return n

    for i, a in enumerate(chosen):
        for got, sign in ((lpf[i], 1), (later[i], -1)):
            want = max([shared(a, b) for b in chosen if sign * position[b] < sign * position[a]], default=0)
            assert min(got, 16) == min(want, 16)


def test_nearest_smaller():
    values = np.array([5, 3, 4, 4, 9, 8, 1, 2])
    assert suffix_dedup.nearest_smaller(values).tolist() == [-1, -1, 1, 1, 3, 3, -1, 6]
