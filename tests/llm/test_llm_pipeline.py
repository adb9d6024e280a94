import math
import random
from collections import Counter

import pytest

import corpus_pipeline
from test_llm_corpus import check_packed, groups, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    rows = []
    for i in range(80):
        lang = ("x", "y")[i % 2]
        rows.append((i, words(rng, rng.randrange(20, 200), ("abcdefg", "mnopqrs")[i % 2]), lang, f"s{i % 3}", 0))
    rows += [(100, rows[0][1], "x", "s0", 0), (101, rows[1][1] + " end", "y", "s1", 0), (102, None, "x", None, 0), (103, "12 !", "x", "s0", 0), (104, "abc defg cab a.b1@x.org card 4111111111111111", "x", "s1", 0)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return path, rows


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        if name != "packing":
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append(docs.collect())
    language, deduped, clean, mixed, packed = seen
    kept = {r["doc_id"] for r in language}
    assert {102, 103}.isdisjoint(kept) and {r[0] for r in rows} - kept == {102, 103}
    want, _ = groups({r[0]: r[1] for r in rows if r[0] in kept}, 5)
    assert {r["doc_id"] for r in deduped} == {i for i, c in want.items() if i == c}
    was = {r["doc_id"]: r["text"] for r in deduped}
    assert all("4111111111111111" not in r["text"] and "a.b1@" not in r["text"] and r["n_chars"] == len(r["text"]) for r in clean)
    assert all(r["text"] == was[r["doc_id"]] for r in clean if r["doc_id"] != 104)
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    size = sum(len(r["text"].split()) for r in clean)
    assert abs(sum(len(r["text"].split()) for r in mixed) - size) <= 4
    assert len(packed) >= len(mixed) and check_packed(packed, 4096) <= math.ceil(sum(r["length"] for r in packed) / 4096) + 1


def test_run_is_the_stages_in_a_row(spark, folder):
    path, _ = folder
    assert corpus_pipeline.run(spark, path).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dup", "pii", "mixing", "packing"]


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, rejected string, length int, offset string, target double, component_id string"
    for name, rows in (("empty", []), ("some", [(i, f"abc defg cab number {i} " * 9, "x", None, 0, "clash", 1, "clash", 0.5, "clash") for i in range(12)])):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for stage, run in corpus_pipeline.STAGES[:-1]:
            made = run(spark, docs, path)
            assert made.columns == docs.columns and (stage == "near_dup" or made.count() == len(rows))
        assert corpus_pipeline.run(spark, path).count() == (12 if rows else 0) or rows


def test_stages_leave_no_tables_behind(spark, folder, tmp_path, monkeypatch):
    import os

    from claimscope.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(corpus_pipeline, "shared_dir", lambda spark: str(tmp_path))
    corpus_pipeline.run(spark, folder[0]).count()
    left = sorted(x.rsplit("-", 1)[0] for x in os.listdir(tmp_path))
    assert [x for x in left if x.startswith("stage-")] == ["stage-mixing"]  # the last stage's input
    assert not {"sketches", "nodes", "edges", "sets", "sizes", "budgets", "lengths"} & set(left)


def test_a_cluster_needs_a_shared_folder():
    from claimscope.llm import common

    class Session:
        def __init__(self, master, folder=None):
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "an app"})
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}

    with pytest.raises(ValueError):
        common.shared_dir(Session("spark://host:7077"))
    assert common.shared_dir(Session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    assert common.shared_dir(Session("local[2]")) == common.shared_dir(Session("local[4]"))
