import math
from collections import Counter

import numpy as np
import pytest

from roadrisk.llm import segmentation as sampling

MODEL = sampling.read_model()
VOCAB = sampling.vocabulary(MODEL)


def every_segmentation(text):
    """All piece sequences of a text with their chances, by trying every cut."""
    marked = sampling.MARK + text.replace(sampling.MARK, sampling.OWN_MARK).replace(" ", sampling.MARK)
    out = {}

    def cut(at, ids, log):
        if at == len(marked):
            out[tuple(ids)] = log
            return
        node, single = 0, False
        for end in range(at, len(marked)):
            slot = int(sampling._followed(VOCAB, np.array([node << 21 | ord(marked[end])]))[0])
            if slot < 0:
                break
            node = int(VOCAB.ends[slot])
            piece = int(VOCAB.piece_at[node])
            if piece >= 0:
                single |= end == at
                cut(end + 1, ids + [piece], log + VOCAB.log_prob[piece])
        if not single:
            raw = sampling._bytes_of(ord(marked[at]))
            cut(at + 1, ids + [int(VOCAB.byte_ids[b]) for b in raw], log + len(raw) * VOCAB.byte_log_prob)

    cut(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {ids: log - total for ids, log in out.items()}


def sampled(texts, keys, k, seed=sampling.SEED):
    out = {}
    for rank, at, ids, bounds, log, value, inclusion in sampling.segment(texts, np.array(keys), MODEL, k, seed):
        for j, text in enumerate(at):
            out.setdefault(int(text), []).append(
                (rank, tuple(ids[bounds[j]:bounds[j + 1]].tolist()), float(log[j]), float(value[j]), float(inclusion[j])))
    return out


def test_samples_follow_the_law_without_replacement():
    text, n = "the cat é", 12_000
    chance = every_segmentation(text)
    out = sampled([text] * n, range(n), 2)
    first, pairs, estimate = Counter(), Counter(), Counter()
    for paths in out.values():
        (_, a, log, g1, i1), (_, b, _, g2, i2) = paths
        assert a != b and g1 > g2 and math.isclose(log, chance[a], abs_tol=1e-9)
        first[a] += 1
        pairs[a, b] += 1
        for _, ids, log, _, inclusion in paths:
            estimate[ids] += math.exp(log - inclusion)
    top = sorted(chance, key=chance.get, reverse=True)[:3]
    for a in top:
        p = math.exp(chance[a])
        assert abs(first[a] / n - p) < 5 * math.sqrt(p / n)
        assert abs(estimate[a] / n - p) < 0.02  # inclusion scores make an unbiased estimate
        for b in top:
            if a != b:
                q = p * math.exp(chance[b]) / (1 - p)
                assert abs(pairs[a, b] / n - q) < 5 * math.sqrt(q / n) + 1e-3


def test_all_segmentations_of_a_small_text_come_out_once():
    text = "zq ab"
    chance = every_segmentation(text)
    (paths,) = sampled([text], [3], len(chance) + 5).values()
    assert sorted(ids for _, ids, *_ in paths) == sorted(chance)
    assert [p[3] for p in paths] == sorted((p[3] for p in paths), reverse=True)
    assert all(p[4] == 0.0 for p in paths)


@pytest.mark.parametrize("text", ["a", " ", "  two  spaces \n\t", "▁ own mark ▁▁", "漢字 𝄞 \x00 ​", "é" * 300, "ab" * 2000])
def test_round_trip(text):
    for _, ids, *_ in sampled([text], [1], 3)[0]:
        assert sampling.decoded(list(ids), VOCAB.spelling) == text


def test_far_regions_are_valued_where_they_matter(monkeypatch):
    texts = ["some words and some more of them, quite a few", "zq ab", "aaaa", "", "x " * 50]
    want = sampled(texts, range(5), 12)
    monkeypatch.setattr(sampling, "MOST", 60.0)
    for floor in (-0.001, -1.0, -8.0):
        monkeypatch.setattr(sampling, "FLOOR", floor)
        assert sampled(texts, range(5), 12) == want


def test_samples_depend_on_the_key_alone():
    texts = ["some words here", "and some others there", "some words here"]
    rounded = lambda paths: [(r, ids, *(round(x, 9) for x in more)) for r, ids, *more in paths]
    alone, together = sampled(texts[:1], [5], 3)[0], sampled(texts, [4, 9, 5], 3)
    assert rounded(alone) == rounded(together[2]) and [p[1:] for p in together[2]] != [p[1:] for p in sampled(texts[:1], [6], 3)[0]]


def test_many_texts_are_decoded_at_once(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(sampling, "CHUNK", 7)
    texts = ["", "a b", None, "é漢", " x", "", "long " * 9]
    ids = [None if t is None else list(sampled([t], [0], 1)[0][0][1]) for t in texts]
    out = sampling._decoded_all(pa.array(ids, pa.list_(pa.int32())), MODEL)
    assert out.to_pylist() == texts
    broken = pa.array([[28705, int(VOCAB.byte_ids[0xFF])]], pa.list_(pa.int32()))
    assert sampling._decoded_all(broken, MODEL).to_pylist() == ["\ufffd"]
    assert sampling._decoded_all(broken.slice(0, 0), MODEL).to_pylist() == []


def test_odd_rows(spark, documents, odd_rows):
    out = sampling.encode_samples(documents(odd_rows)).withColumn("text", sampling.decode("pieces")).collect()
    texts = {}
    for i, t in odd_rows:
        texts.setdefault(i, set()).add(t or "")
    assert all(r.text in texts[r.doc_id] for r in out)
    both = sampling.encode_samples(documents(odd_rows), with_text=True).withColumn("text", sampling.decode("pieces"))
    assert both.where("decoded != text").count() == 0 and both.where("decoded is null").count() == 0
    assert sum(r["rank"] == 1 for r in out) == len(odd_rows)
    assert {(r["rank"], r.log_prob, r.log_inclusion) for r in out if not r.pieces} == {(1, 0.0, 0.0)}
    twice = [tuple(r.pieces) for r in out if r.doc_id == 4 and r["rank"] == 2 and r.text.startswith("one")]
    assert len(twice) == 2 and len(set(twice)) == 1
    again = sampling.encode_samples(documents(odd_rows[::-1]).repartition(5)).collect()
    key = lambda rows: sorted((str(r.doc_id), r["rank"], tuple(r.pieces), round(r.perturbed, 9)) for r in rows)
    assert key(out) == key(again)
    assert sampling.encode_samples(documents([])).count() == 0


def test_units_are_those_of_the_pattern():
    texts = ["", " ", "  ", "a", "a b", " a b", "a b ", "a  b", "a\nb c\t d", "▁", "▁ a", "a ▁b", "a\u00a0b c", "é ü", "nan None"]
    for text in texts:
        marked = sampling.MARK + text.replace(sampling.MARK, sampling.OWN_MARK).replace(" ", sampling.MARK) if text else ""
        assert [sampling.MARK + u for u in sampling._units(text)] == sampling.UNIT.findall(marked), repr(text)
