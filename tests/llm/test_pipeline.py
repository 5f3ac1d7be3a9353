"""The pipeline's stages, each against what it is given."""

import os
from collections import Counter

import corpus_pipeline
import pytest

from sitefold.llm import common as C

from .conftest import SCHEMA, prose
from .test_operators import base_spans, classes, counted


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, prose(k % 90, 60) + (" ###" * 20 if k % 5 == 0 else ""), "en", f"s{k % 3}", 0, 0, "", "", "") for k in range(1000, 1300)]
    docs.unionByName(spark.createDataFrame(rows, SCHEMA)).write.parquet(f"{place}/documents.parquet")
    labels = spark.createDataFrame([(k, 0 if k % 5 == 0 else 1) for k in range(1000, 1300)], "doc_id long, quality int")
    labels.write.parquet(f"{place}/labels.parquet")
    return place


def test_stages(spark, folder):
    docs = C.table(spark, folder, "documents")
    columns, results = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scan", "source_mix", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = C.written(stage(spark, docs, folder), name)
        after = docs.collect()
        results[name] = after
        if name != "packing":
            assert docs.columns == columns
        if name == "quality_rules":
            assert all(n >= 20 and 100 * c <= 30 * n for n, _, _, _, c in (counted(x["text"]) for x in after))
            clean = {x["doc_id"] for x in before if x["doc_id"] and x["doc_id"] >= 1000 and x["doc_id"] % 5}
            assert clean <= {x["doc_id"] for x in after} and not {k for k in range(1000, 1300, 5)} & {x["doc_id"] for x in after}
        if name == "near_duplicates":
            want = classes([(x["doc_id"], x["text"]) for x in before if x["doc_id"] is not None])
            assert sorted(x["doc_id"] for x in after if x["doc_id"] is not None) == sorted(i for i, (_, c) in want.items() if c == i)
        if name == "secret_scan":
            assert len(after) == len(before) and not any(base_spans(x["text"] or "") for x in after)
        if name == "source_mix":
            assert set(Counter(x["doc_id"] for x in after).values()) <= {1, 2}
        if name == "packing":
            assert Counter(x["doc_id"] for x in after).keys() == {x["doc_id"] for x in before}
    run = corpus_pipeline.run(spark, folder)
    assert run.count() == len(results["packing"])


def test_empty_tables(spark, folder, tmp_path):
    place = os.fspath(tmp_path)
    for t in ("documents", "labels"):
        C.table(spark, folder, t).limit(0).write.parquet(f"{place}/{t}.parquet")
    assert corpus_pipeline.run(spark, place).count() == 0
