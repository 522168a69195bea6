"""Registered queries of this subpackage, and the pipeline against plain versions of its stages."""

import os

import pytest

import corpus_pipeline
from eventide.llm import toxicity
from eventide.llm.common import table
from eventide.llm.queries import CHECKS, QUERIES
from tests.compare import database, differences
from tests.llm.test_contamination import plain
from tests.llm.test_dedup import plain_groups
from tests.llm.test_jaccard import plain_kept

FOLDER = os.environ.get("EVENTIDE_TEST_FOLDER", "/root/testdata/sf0.001")


def test_names():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []
    assert "pipeline" in QUERIES and set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), database(FOLDER), CHECKS[name]) == []


def test_stages_against_plain_versions(spark):
    docs = table(spark, FOLDER, "documents")
    judged = {r.doc_id for r in toxicity.judged(docs, table(spark, FOLDER, "labels")).collect() if not r.predicted}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id in judged}
    rows = {i: rows[i] for i in {k for _, k, _ in plain_groups(list(rows.items()))}}
    names = set(plain_kept(list(rows.items())))  # five-word Jaccard of 0.8 or more, all pairs compared
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    clean = {i for i in names if not plain(rows[i], items)[-1]}

    got = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in got.select("doc_id").collect()} == clean and got.count() == len(clean)
    assert got.where("not round_trip").count() == 0
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, FOLDER)
        assert at.columns == docs.columns, name


def test_stages_on_odd_rows(spark, odd):
    docs = odd.selectExpr("doc_id", "text", "lang", "kept as source", "length(text) as n_chars")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, rows, FOLDER)
            assert found.count() <= rows.count(), name
