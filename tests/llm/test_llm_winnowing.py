import random
import re

from roadrisk.llm import winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((str(doc), len(w), len(hit), sorted(str(f) for f in found if f is not None),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def found(documents, spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"]), r.contaminated)
                  for r in winnowing.contamination(documents(docs), bench).collect())


def test_every_window_is_found(documents, spark):
    rng = random.Random(2)
    # Few words, so that grams repeat and overlap.
    text = lambda n, kinds: " ".join(rng.choice(kinds) for _ in range(n))
    few, many = ["a", "B", "é"], [f"w{i}" for i in range(300)]
    items = [(i, text(rng.randrange(13, 30), many)) for i in range(12)] + [(20, text(14, few)), (21, text(40, few))]
    docs = [(i, text(rng.randrange(80), many)) for i in range(20)] + [(50 + i, text(200, few)) for i in range(5)]
    for i, (_, item) in enumerate(items):
        w = item.split()
        a = rng.randrange(max(len(w) - 12, 1))
        docs.append((100 + i, f"{text(30, many)}, {'-'.join(w[a:a + 13]).upper()}! {text(30, many)}"))
        docs.append((200 + i, f"{text(3, many)} {' '.join(w[a:a + 12])} {text(3, many)} {item}"))
    assert found(documents, spark, docs, items) == brute(docs, items)


def test_short_items_are_windows_by_themselves(documents, spark):
    items = [(1, "alpha"), (2, "beta gamma"), (3, "One two three four five six seven"), (4, "alpha"), (5, "12 13 14 15 16"),
             (6, "?!"), (None, "delta"), (7, None), (8, " ".join("abcdefghijkl")), (9, " ".join("abcdefghijklm"))]
    docs = [(1, "alpha beta"), (2, "x beta, gamma alpha"), (3, "zero one two three four five six seven eight"),
            (4, "delta"), (5, "11 12 13 14 15 16 17"), (6, " ".join("abcdefghijkl")), (7, " ".join("zabcdefghijklmn")),
            (8, "nothing " * 50), (9, "alpha " + "nothing " * 19), (10, "alpha " + "nothing " * 20)]
    assert found(documents, spark, docs, items) == brute(docs, items)


def test_odd_rows(documents, spark, odd_rows):
    items = [(1, "two three four"), (1, "two three four"), (2, "a" * 3000)]
    assert found(documents, spark, odd_rows, items) == brute(odd_rows, items)
    assert found(documents, spark, odd_rows, []) == brute(odd_rows, [])
    assert found(documents, spark, [], items) == []
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = winnowing.clean_documents(documents(odd_rows), bench)
    assert clean.columns == documents([]).columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(b[0] for b in brute(odd_rows, items) if not b[4])
