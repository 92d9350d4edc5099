import random
from bisect import bisect
from collections import Counter
from itertools import product

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from roadrisk.llm import alignment

from .conftest import LONG

TEXTS = ["a plain text of words", "two  blanks,   three\n\nand lines \n end ", " leading", "\ttab\x1cfile", "né 漢字仮名交じり文 𝄞𝄞 end",
         "unhappily <|endoftext|> <s> <0x41> </s>", "mark ▁ inside", "a b   c\u0085d", "x" * 500, "=" * 77 + " " * 40,
         "3.14159, 2024-01-01T00:00:00Z; foo(bar)[baz] = {'q': 1}", " ", "\n", "it's we'll I'M don't", "à́ é zero​width ᠎ x", None, ""]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.MODEL_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL_B)


def spelt_by_hand(tokenizers, text):
    """(ids of A, ids of B, groups) by whole encoding and sets of ends; None where there are no tokens."""
    a, b = tokenizers
    if not text:
        return None
    raw = (" " + text).encode()
    byte = alignment._byte_alphabet()
    sides = []
    for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(byte[c] for c in a.id_to_token(i))),
                       (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                        else b.id_to_piece(i).replace("▁", " ").encode())):
        parts = [spell(i) for i in ids]
        if b"".join(parts) != raw:
            return None
        sides.append((ids, np.cumsum([len(p) for p in parts]).tolist()))
    ends = sorted(set(sides[0][1]) & set(sides[1][1]))
    groups, last = [], 0
    for end in ends:
        groups.append(tuple(ids[bisect(at, last):bisect(at, end)] for ids, at in sides))
        last = end
    return sides[0][0], sides[1][0], groups


def by_hand(tokenizers, texts):
    found = [spelt_by_hand(tokenizers, t) or ([], [], []) for t in texts]
    links = [Counter(pair for a, b in groups for pair in product(a, b)) for _, _, groups in found]
    docs = Counter(pair for one in links for pair in one)
    most = {}
    for (a, _), n in docs.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (a, b, groups), one in zip(found, links):
        spelt = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        out.append((len(a), len(b), len(groups), spelt, sum(one.values()),
                    sum(n for pair, n in one.items() if docs[pair] == most[pair[0]]), sum(n * docs[pair] for pair, n in one.items())))
    return out


def result(frame, frequent=alignment.FREQUENT):
    found = alignment.align(frame).withColumn("text", alignment.spelt("groups")).drop("groups")
    rows = alignment.scored(found, frequent).collect()
    written = alignment.align(frame, text=True).where("part = 0").select("doc_id", "groups").collect()
    assert sorted(map(str, written)) == sorted(str(r).replace("text=", "groups=") for r in found.where("part = 0").select("doc_id", "text").collect())
    return [(r.doc_id, (r.n_a, r.n_b, r.n_groups, r.text, r.n_links, r.n_best, r.count_sum)) for r in rows]


@pytest.mark.parametrize("frequent", [1, 20, 1 << 16])
def test_against_whole_encoding(documents, tokenizers, frequent):
    texts = TEXTS + ["a plain text of words", "words of unhappily plain text"]
    got = result(documents(list(enumerate(texts))).repartition(3), frequent)
    assert [r for _, r in sorted(got)] == by_hand(tokenizers, texts)
    assert dict(got)[6][:3] == (0, 0, 0) and dict(got)[0][0] > 0


def test_random_texts_in_few_and_many_blocks(documents, tokenizers, monkeypatch):
    draw = random.Random(5)
    signs = ["a", "the", "ing", " ", "  ", "\n", "é", "漢", " ", "Z", "9", "'s", "-", "qx", "▁"]
    texts = ["".join(draw.choice(signs[:14 + (n % 7 == 0)]) for _ in range(draw.randint(1, 60))) for n in range(150)]
    want = by_hand(tokenizers, texts)
    assert [r for _, r in sorted(result(documents(list(enumerate(texts)))))] == want
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 9)  # texts in several parts, no pair in two of them
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(150)), "_row": list(range(150)), "text": texts})
    parts = {}
    for out in alignment._aligned(iter([batch]), alignment._read(alignment.MODEL_A), alignment._read(alignment.MODEL_B)):
        for row in out.to_pylist():
            held = parts.setdefault(row["_row"], {"n": 0, "links": Counter()})
            held["n"] += 1
            assert not held["links"].keys() & set(row["pairs"]) and (row["groups"] is None) == (row["part"] > 0)
            held["links"].update(dict(zip(row["pairs"], row["times"])))
    assert max(h["n"] for h in parts.values()) > 2
    for i, text in enumerate(texts):
        groups = (spelt_by_hand(tokenizers, text) or ([], [], []))[2]
        assert parts[i]["links"] == Counter(a << alignment.ID_BITS | b for ga, gb in groups for a, b in product(ga, gb))


def test_common_ends_against_sets():
    draw = np.random.default_rng(1)
    for trial in range(300):
        last = int(draw.integers(1, 200))
        every = draw.random() ** 2
        a, b = (np.flatnonzero(np.append(draw.random(last) < draw.choice([every, 0.95]), True)) for _ in "ab")
        if trial % 3 == 0:
            b = a.copy()
        place_a, place_b = alignment.common_ends(a, b)
        both = np.intersect1d(a, b)
        assert a[place_a - 1].tolist() == both.tolist() == b[place_b - 1].tolist()


def test_odd_rows(documents, odd_rows, tokenizers):
    got = result(documents(odd_rows))
    want = by_hand(tokenizers, [t for _, t in odd_rows])
    plain = lambda rows: sorted((i if i is not None else -1, r) for i, r in rows)
    assert plain(got) == plain([(i, r) for (i, _), r in zip(odd_rows, want)])
    assert next(r for i, r in got if i == 5)[0] > len(LONG.split())


def test_no_rows(documents):
    assert result(documents([])) == []


def test_a_worker_forgets_words(documents, tokenizers, monkeypatch):
    known = alignment.Words(alignment._read(alignment.MODEL_A), alignment._read(alignment.MODEL_B))
    first = alignment._Aligned(known, ["one two", "three"])
    known.forget()
    again = alignment._Aligned(known, ["zero", "one two", "three"])
    assert first.a.tolist() == again.a.tolist()[len(again.a) - len(first.a):] and len(known.fits) == 4
