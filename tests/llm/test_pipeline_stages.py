"""The pipeline's stages, each on its own input, and the registered queries against SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from millrace.llm import oracles, queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    frame = queries.QUERIES[name](spark, SF_DIR)
    result = con.execute(oracles.ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert Counter(map(tuple, frame.select(*names).collect())) == Counter(result.fetchall())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_stages(spark, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, kept, SF_DIR).cache()
        if name != "BPE encoding":
            assert kept.schema.names == docs.schema.names, name
        assert 0 < kept.count() <= before.count()
    assert kept.filter("n_tokens is null or length(ids) != 4 * n_tokens").count() == 0


def test_stages_of_awkward_rows(spark):
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, "12 34", None, None, 5),
        (4, "password=abcdefgh123 said the fox", "en", "a", 99),
        (4, "password=abcdefgh123 said the fox", "en", "a", 99),
        (None, "a text without a key", "en", "a", 20),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    out = {name: stage(spark, frame, SF_DIR).collect() for name, stage in corpus_pipeline.STAGES}
    assert sorted(r.doc_id or 0 for r in out["language ID"]) == [0, 4, 4]
    assert len(out["n-gram Jaccard join"]) == len(rows)
    assert len(out["benchmark decontamination"]) == len(rows)
    hidden = [r for r in out["secret scans"] if r.doc_id == 4]
    assert all(r.text == "<secret> said the fox" and r.n_chars == 21 for r in hidden)
    assert len(out["BPE encoding"]) == len(rows)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame.limit(0), SF_DIR).count() == 0, name
