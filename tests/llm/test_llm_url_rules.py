import random
import re

import pytest
from pyspark.sql import functions as F

from roadrisk.llm import url_rules

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, host string, rule string, prefix string, verdict int, url_ string"


@pytest.fixture
def judged(spark):
    def judge(urls, rules=url_rules.RULES):
        pages = spark.createDataFrame([(i, u, "h", "r", "p", 3, "x") for i, u in enumerate(urls)], PAGES)
        out = url_rules.judge(pages, spark.createDataFrame(list(rules), RULES)).collect()
        return [(r.host, r.path, r.rule, r.verdict) for r in sorted(out, key=lambda r: r.page_id)]
    return judge


def by_hand(url, rules):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h + (p or "")), len(h), v, h + (p or "")) for h, p, v in rules if h is not None and v is not None
           and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_rules_of_the_query(judged):
    urls = ["http://a.example.org/es/1", "https://example.org/en/17", "http://EXAMPLE.org/en/2?x=/es/", "http://org/", "http://org",
            "http://x.com/fr/", "http://com/de/1#a", "http://x.com/en", "http://example.net/de/", "http://notexample.org/es/1",
            "example.org/es/", "", None, "http://x.org/a?b://c", "http://u:p@X.com:80/de/", "ftp://a.com:80/de/", "http://x.com./de/"]
    out = judged(urls)
    assert out == [by_hand(u, url_rules.RULES) for u in urls]
    assert [r[2:] for r in out[:6]] == [("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"),
                                        ("org/", "allow"), (None, "allow"), ("com/fr/", "allow")]


def test_random_rules_against_brute_force(judged):
    draw = random.Random(3)
    host = lambda: ".".join(draw.choice(["a", "b", "ab", ""]) for _ in range(draw.randint(1, 4)))
    path = lambda: draw.choice(["", "/"]) and "/" + "/".join(draw.choice(["a", "ab", "", "1"]) for _ in range(draw.randint(0, 4)))
    rules = [(host(), draw.choice([path(), None]), draw.choice(["allow", "block"])) for _ in range(150)] + [(None, "/", "block"), ("a", "/", None)]
    urls = [f"http://{host()}{path()}{draw.choice(['', '?q/a', '#/b'])}" for _ in range(400)]
    out = judged(urls, rules)
    assert out == [by_hand(u, rules) for u in urls]
    assert {r[3] for r in out} == {"allow", "block"} and len({r[2] for r in out}) > 30


def test_prefix_collisions_are_confirmed_by_digest(judged, monkeypatch):
    monkeypatch.setattr(url_rules, "PREFIX_DIGITS", 0)  # everything meets
    urls = ["http://a.example.org/es/1", "http://x.com/en", "http://b.net/"]
    assert judged(urls) == [by_hand(u, url_rules.RULES) for u in urls]


def test_expansion_stays_within_the_rules(spark):
    urls = spark.createDataFrame([("a.b.c.d", "/1/2/3/4/5"), ("", "")], "host string, path string")
    rows = url_rules.expressions(urls, 2, 1).collect()
    assert {(r.suffix, r.folder) for r in rows if r.host} == {("d", ""), ("d", "/"), ("c.d", ""), ("c.d", "/")}
    assert [(r.suffix, r.folder) for r in rows if not r.host] == [("", "")]


def test_very_long_urls_repeats_and_empty_tables(judged):
    long = "http://" + "a." * 30_000 + "example.org/es/" + "b/" * 100_000
    out = judged([long, long, "http://q.org/"])
    assert out[0] == out[1] and out[0][2:] == ("example.org/es/", "block") and out[2][2] == "org/"
    assert judged([]) == []
    assert judged(["http://q.org/", None], []) == [("q.org", "/", None, "allow"), ("", "", None, "allow")]
