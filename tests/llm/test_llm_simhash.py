import random

import numpy as np
import pytest
import xxhash

from roadrisk.llm import components, simhash


def clustered(seed, centres=40, members=12, flips=3):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        code = rng.getrandbits(64)
        for _ in range(members):
            out.add(code)
            for bit in rng.sample(range(64), rng.randrange(flips + 1)):
                code ^= 1 << bit
    return sorted(out)


def groups(codes, distance=3):
    lead = {c: c for c in codes}

    def find(c):
        while lead[c] != c:
            c = lead[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                lead[find(a)] = find(b)
    return {c: find(c) for c in codes}


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace(
        "\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "One", "One two", "a B c", "a b c d e É f  g\n\th", "x " * 100])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_gray_rank_neighbours_differ_by_one_bit():
    codes = np.arange(1024, dtype=np.uint64)
    order = codes[np.argsort(simhash.gray_rank(codes))]
    assert set(np.bitwise_count(order[1:] ^ order[:-1]).tolist()) == {1}


@pytest.mark.parametrize("seed", range(3))
def test_index_finds_exactly_the_near_codes(seed):
    codes = np.array(clustered(seed), dtype=np.uint64)
    index = simhash.GrayIndex(codes, fan_out=4)
    queries, found = index.search(codes, 3)
    pairs = set(zip(codes[queries].tolist(), index.codes[found].tolist()))
    assert pairs == {(a, b) for a in codes.tolist() for b in codes.tolist() if (a ^ b).bit_count() <= 3}
    members, leads = simhash.linked(codes)
    want = groups(codes.tolist())
    got = dict(zip(members.tolist(), leads.tolist()))
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in want for b in want)


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_links_connect_all_groups_however_batches_cut_buckets(spark, batch):
    codes = clustered(9, centres=15)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code long")
        roots = {r.node: r.root for r in components.components(simhash.near_links(frame)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    want = groups(codes)
    signed = {c: c - (1 << 64) if c >> 63 else c for c in codes}
    got = {c: roots.get(signed[c], signed[c]) for c in codes}
    assert len(set(got.values())) == len(set(want.values()))
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in codes for b in codes)


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 99), (5, 5)], "a long, b long")
    assert {r.node: r.root for r in components.components(links).collect()} == {
        **{i: 0 for i in range(1, 61)}, 100: 99}
    assert components.components(links.limit(0)).count() == 0


def test_near_copies_of_odd_rows(documents, odd_rows):
    out = simhash.near_copies(documents(odd_rows)).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in out) == sorted(
        (str(i), f"{brute_fingerprint(t):016x}") for i, t in odd_rows)
    assert {r.component_id for r in out if r.fingerprint == "0" * 16} == {1}
    assert {r.component_id for r in out if r.doc_id is None} == {1, 4}
    kept = simhash.one_of_each(documents(odd_rows))
    assert kept.columns == documents([]).columns
    assert sorted((r.doc_id, r.text[:8] if r.text else r.text) for r in kept.collect()) == [
        (1, None), (4, "another "), (4, "one two "), (5, "word0x0 "), (6, "né 漢字 𝄞 "), (7, "aaaaaaaa")]
    nameless = documents([(None, "x y z"), (None, "x y z"), (None, "p q r s t")])
    assert simhash.one_of_each(nameless).count() == 2
    assert simhash.near_copies(documents([])).count() == simhash.one_of_each(documents([])).count() == 0
