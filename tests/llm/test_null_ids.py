"""Rows whose every column is null, and rows of one id with different texts, go through every query and the pipeline."""

import pytest

import corpus_pipeline
from skein.llm import queries

TEXT = "a shared passage of many words that repeats in some other rows too " * 6


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("nulls"))
    rows = [(None, None, None, None, None), (None, TEXT, "en", None, 1), (None, TEXT, None, "s", 1), (7, TEXT + " one", "en", "s", 1), (7, TEXT + " two", "en", "s", 1), (-3, TEXT, "en", "s", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(None, 1, None), (7, None, 0), (-3, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, folder, name):
    rows = queries.QUERIES[name](spark, folder).collect()
    assert len(rows) == 6
    if name.startswith("op5"):
        assert sorted(r.n_removed > 0 for r in rows) == [False] + [True] * 5
    if name.startswith("op1_"):
        assert sorted(r.class_id is None for r in rows) == [False] * 3 + [True] * 3


def test_pipeline(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
