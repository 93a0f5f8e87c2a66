import json

import public_tokenizers
import pytest

import corpus_pipeline
from assayloom.llm.queries import oracle_sql, queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    words = ["river", "stone", "walk", "green", "letter", "morning", "paper", "quiet", "apple", "window"]
    say = lambda i, n: " ".join(words[(i * 7 + k * k + k // 3) % 10] + str((i * 31 + k) % 97) for k in range(n))
    rows = [(i, say(i, 40) + (" grumble snarl" if i % 5 == 0 else ""), "en", "s", 1) for i in range(200)]
    item = "this passage is in the benchmark and must not be learned by any model at all"
    rows += [(300, say(1001, 30) + " " + item, None, None, None), (301, say(1, 40), "en", "s", 1), (302, say(1, 39) + " changed", "en", "s", 1), (303, "write to jo@site.com please", "en", "s", 27), (304, None, None, None, None), (305, "", "en", "s", 0)]
    rows += [rows[7]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
        if name != "packing":
            assert docs.columns == columns
            seen.append({r["doc_id"]: r for r in docs.collect()})
            assert len(seen[-1]) == docs.count() or name == "toxicity"
    toxic, near, clean, private = seen
    gone = {i for i in range(200) if i % 5 == 0}
    assert toxic.keys() == ({*range(200)} - gone) | {300, 301, 302, 303, 304, 305}
    assert near.keys() == toxic.keys() - {301, 302}
    assert clean.keys() == near.keys() - {300}
    assert private.keys() == clean.keys()
    assert (private[303]["text"], private[303]["n_chars"], private[304]["text"], private[305]["text"]) == ("write to <EMAIL> please", 23, None, "")
    assert {r["doc_id"] for r in docs.collect()} == private.keys()


def test_run_and_empty(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() >= 160
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").filter("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registration():
    assert sorted(int(k[2:].split("_")[0]) for k in queries()) == list(range(1, 14))
    assert oracle_sql().keys() <= queries().keys()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and json.dumps([n for n, _ in corpus_pipeline.STAGES])
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_intermediate_tables_go(spark, folder):
    """After a run only its last stage's tables are left, and a table that is still read stays."""
    import glob
    import os

    from assayloom.llm import common

    common.MADE.clear()
    corpus_pipeline.LEFT.clear()
    out = corpus_pipeline.run(spark, folder)
    there = [p for p in common.MADE if os.path.isdir(p)]
    assert there == common.MADE and any("stage-packing" in p for p in there) and not any("near-cop" in p or "stage-toxicity" in p for p in there)
    assert out.count() > 100
    kept = common.written(spark.range(3), "kept")
    gone = common.written(spark.range(3), "gone")
    paths = common.MADE[-2:]
    assert common.removed(spark, paths, kept) == paths[:1]
    assert kept.count() == 3 and glob.glob(paths[0] + "/*") and not os.path.exists(paths[1]) and gone is not None
