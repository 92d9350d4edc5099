import random
import re

import pandas as pd

from roadrisk.llm import host_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, hit = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            hit.update(j for i in places for j in range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def texts():
    rng = random.Random(4)
    out = [None, "", " ", "\x0b\x0c", "a b c d e f g h " * 3, "x\r\ny\nx\r\n\n\n y", "é# 漢|\x1f字 \xa0 z"]
    for _ in range(60):
        out.append("".join(rng.choice(["a", "b", "é", " ", " ", "\n", "#"]) for _ in range(rng.randrange(200))))
    return out


def test_counts_equal_brute_force():
    rows = texts()
    found = host_rules.counted(pd.Series(rows, dtype=object))
    assert [tuple(r) for r in found.to_numpy().tolist()] == [brute(t) for t in rows]


def test_prior_takes_off_what_chance_makes(spark):
    same = spark.createDataFrame([(f"h{i}", 1000, 100) for i in range(20)], "host string, docs long, failed long")
    assert host_rules.fitted_prior(same).weight == float("inf")
    apart = spark.createDataFrame([(f"h{i}", 1000, 900 if i < 5 else 10) for i in range(20)],
                                  "host string, docs long, failed long")
    prior = host_rules.fitted_prior(apart)
    assert 0 < prior.weight < 5 and abs(prior.mean - 0.2325) < 1e-9
    assert host_rules.fitted_prior(same.limit(0)).mean == 0


def test_bad_hosts_go_whole_and_small_ones_are_drawn_in(documents):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good, f"good{i % 9}") for i in range(180)] + [(200 + i, "short", "bad") for i in range(40)]
    rows += [(300 + i, good, "bad") for i in range(4)] + [(400, "short", "tiny"), (401, good, "tiny")]
    out = {r.doc_id: r for r in host_rules.judge(documents(rows)).collect()}
    assert out[300].host_refused and not out[300].base_failed and not out[300].kept
    assert not out[401].host_refused and out[401].kept and not out[400].kept
    assert 0.05 < out[400].host_rate < 0.5 < out[200].host_rate < 40 / 44
    kept = host_rules.keep_documents(documents(rows))
    assert kept.columns == documents([]).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.kept}


def test_odd_rows(documents, odd_rows):
    out = host_rules.judge(documents(odd_rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r.doc_id, r.n_words, r.word_chars) for r in out], key=key) == sorted(
        [(i, *brute(t)[:2]) for i, t in odd_rows], key=key)
    nameless = documents([(1, "x", None), (2, "y", "")])
    assert {r.host for r in host_rules.judge(nameless).collect()} == {""}
    assert host_rules.judge(documents([])).count() == host_rules.keep_documents(documents([])).count() == 0
    twice = documents([(1, " ".join(map(str, range(30)))), (1, " ".join(map(str, range(30))))])
    assert host_rules.keep_documents(twice).count() == 2
