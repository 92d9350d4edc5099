import importlib
import random
import sys

import corpus_pipeline
import numpy as np
from roadrisk.llm import secrets, segmentation, winnowing


def text(rng, n=60):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_each_stage_takes_effect(spark, documents, tmp_path):
    rng = random.Random(3)
    plain, shared, item = text(rng, 300), text(rng, 300), text(rng, 40)
    words = shared.split()
    near = " ".join(words[:150] + ["changed"] + words[151:])
    rows = [(1, plain), (2, "too short"), (3, shared), (4, shared), (5, near), (6, f"{text(rng, 30)} {item}"),
            (7, f"{text(rng)} token=abcdefgh1234 {text(rng, 5)}"), (8, None), (1, plain)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    states = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.schema.simpleString() == docs.schema.simpleString()
            own = out.select("row", "spans", "_row", "_spans", "__ROW").distinct().collect()
            assert [tuple(r) for r in own] == [(1, "s", "own", 9, 0.25)]
        out.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
        states.append(docs)
    ids = [sorted(r.doc_id for r in d.select("doc_id").collect()) for d in states]
    assert ids[0] == [1, 1, 3, 4, 5, 6, 7] and ids[1] == [1, 3, 6, 7] and ids[2] == ids[3] == [1, 3, 7]
    masked = {r.doc_id: r.text for r in states[3].collect()}
    assert "token=" not in masked[7] and masked[7].count("*") == len("token=abcdefgh1234") and masked[1] == plain
    final = states[4].collect()
    assert {r.doc_id for r in final} == {1, 3, 7} and {r["rank"] for r in final} == {1, 2, 3}
    spelling = segmentation.vocabulary(segmentation.read_model()).spelling
    assert all(segmentation.decoded(r.pieces, spelling) == masked[r.doc_id] for r in final)
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda rs: sorted((r.doc_id, r["rank"], tuple(r.pieces)) for r in rs)
    assert key(run) == key(final)


def test_stages_of_no_rows(spark, documents, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_entry_lists_each_operator_and_works_without_them(monkeypatch):
    driver = importlib.import_module("__spark_entry__")
    names = list(driver.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))
    for gone in ("corpus_pipeline", "roadrisk.llm"):
        with monkeypatch.context() as patch:
            for name in [m for m in sys.modules if m.startswith(gone) or m == "__spark_entry__"]:
                patch.delitem(sys.modules, name)
            class Finder:
                def find_spec(self, name, path=None, target=None):
                    if name == gone:
                        raise ModuleNotFoundError(f"No module named {name!r}", name=name)
            patch.setattr(sys, "meta_path", [Finder(), *sys.meta_path])
            bare = importlib.import_module("__spark_entry__")
            assert bare.corpus is None and not [n for n in bare.queries() if n.startswith(("op", "pipeline"))]
