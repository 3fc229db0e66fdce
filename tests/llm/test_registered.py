"""Registered queries against their SQL, and the pipeline against what its stages promise."""

import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.compare import compare, connect
from tests.llm.data import documents, more_rows, odd_rows
from tidemark.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    if ORACLES[name] is not None:
        compare(spark, name, QUERIES[name], ORACLES[name], FOLDER, connect(FOLDER))


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline"} == set(range(1, 14))
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("labels", [[], [(i, None, 0) for i in range(100, 120)]])
def test_pipeline_keeps_all_without_usable_labels(spark, tmp_path, labels):
    rows = odd_rows() + more_rows(100, 20)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality_classifier(spark, documents(spark, rows), str(tmp_path))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows)


def test_pipeline(spark, tmp_path):
    rows = odd_rows() + more_rows(100, 60) + [(200 + i, *more_rows(100, 1)[0][1:]) for i in range(3)]
    labels = [(i, 1, 0) for i in range(100, 150)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    frames = []
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        frames.append(docs.collect())
        if at < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
    good, single, cleaned, mixed, tokens = frames
    # All labels are good, so whatever looks like them stays; of four equal texts one does.
    assert {r.doc_id for r in good} >= set(range(100, 160))
    assert {r.doc_id for r in single} & {100, 200, 201, 202} == {100}
    assert Counter(r.doc_id for r in cleaned) == Counter(r.doc_id for r in single)
    size = lambda found: sum(len(WORD.findall(r.text or "")) for r in found)
    assert size(cleaned) - 4 <= size(mixed) <= size(cleaned)
    assert len(tokens) == len(mixed)
    assert all(r.n_tokens == len(r.ids) for r in tokens)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(tokens)
