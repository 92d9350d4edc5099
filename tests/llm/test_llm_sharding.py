from zlib import crc32

import numpy as np
import pytest

from roadrisk.llm import sharding


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 64, 65, 1000])
def test_permutation_is_a_bijection_with_an_inverse(n):
    rows = np.arange(n)
    places = sharding.permute(rows, n, seed=5)
    assert sorted(places.tolist()) == list(range(n))
    assert sharding.permute(places, n, seed=5, back=True).tolist() == rows.tolist()


def test_seed_changes_the_order_and_places_are_computable():
    a, b = (sharding.permute(np.arange(500), 500, seed) for seed in (1, 2))
    assert (a != b).mean() > 0.9
    assert sharding.locate(17, 500, 8, 1) == (int(a[17]) % 8, int(a[17]) // 8)


def test_shards_of_odd_rows(documents, odd_rows):
    out = sharding.shard(documents(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    by_shard = {s: sorted(r.slot for r in out if r.shard == s) for s in range(8)}
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    size = sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in out)
    raw = [(i if i is not None else -1, (t or "").encode()) for i, t in odd_rows]
    assert size == sorted((i, len(t) + 1, crc32(t)) for i, t in raw)
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}
    for r in out:
        assert sharding.locate(r.row_number, len(out)) == (r.shard, r.slot)


def test_row_numbers_do_not_depend_on_the_partitioning(documents):
    rows = [(i % 50, f"t{i % 70}") for i in range(400)]
    key = lambda df: sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in sharding.shard(df).collect())
    assert key(documents(rows).repartition(1)) == key(documents(rows[::-1]).repartition(7))


def test_no_rows(documents):
    assert sharding.shard(documents([])).count() == 0
