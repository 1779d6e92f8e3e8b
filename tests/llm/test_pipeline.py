"""The corpus pipeline, stage by stage, and the registered queries."""

import collections

import pytest

import __spark_entry__
import corpus_pipeline
from riskloom.llm import simhash
from riskloom.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {f"{q.split('_')[0]}_" for q in QUERIES}
    assert set(ORACLE) <= set(QUERIES)
    registered = __spark_entry__.queries()
    assert set(QUERIES) <= set(registered) and registered["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, name):
    rows = QUERIES[name](spark, SMALL)
    assert rows.count() > 0
    assert len(rows.columns) == len(set(rows.columns))


def test_stages_by_stage(spark, documents, tmp_path):
    docs, seen = documents, []
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == documents.columns
        seen.append((name, docs, after))
        docs = after
    stages = {name: (before, after) for name, before, after in seen}
    before, after = stages["quality_rules"]
    assert 0 < after.count() < before.count()
    before, after = stages["simhash_near_dedup"]
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == sorted(set(groups.values()))
    before, after = stages["personal_data"]
    assert after.count() == before.count()
    assert not after.where("text rlike '[A-Za-z0-9]@[a-z0-9]+[.][a-z]'").count()
    before, after = stages["mix_sources"]
    words = lambda t: len((t or "").split())
    total = sum(words(r.text) for r in before.collect())
    taken = sum(words(r.text) for r in after.collect())
    assert abs(taken - total) <= 0.05 * total
    times = collections.Counter(r.doc_id for r in after.collect())
    assert max(times.values()) <= 3
    before, after = stages["best_fit_packing"]
    # Python's split knows more blanks than the six of the words here, so compare with the operator's own.
    from pyspark.sql import functions as F

    from riskloom.llm.common import words_of

    tokens = before.agg(F.sum(F.size(words_of(F.col("text"))) + 1)).first()[0]
    assert after.agg(F.sum("size")).first()[0] == tokens


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "piece", "start", "size", "bin_id", "capacity", "bin_offset"]
    assert out.count() > 0


@pytest.mark.parametrize("table", ["odd_docs", "no_docs"])
def test_stages_on_odd_and_empty_tables(request, spark, table, tmp_path):
    docs = request.getfixturevalue(table)
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert (docs.count() > 0) == (table == "odd_docs")
