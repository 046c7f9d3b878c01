"""The pipeline on the small tables, and on odd ones."""

from compare import connect, differences

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ledgerline.llm import decontam, pii, queries as llm, simhash
from ledgerline.llm.common import table


def test_registration():
    assert set(llm.QUERIES) | {"pipeline"} <= set(queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "best-fit packing"]
    assert set(llm.ORACLES) <= set(oracle_sql())


def test_stages_take_effect(spark, tables):
    docs = table(spark, tables, "documents")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], tables).cache())
        assert seen[-1].schema == docs.schema
    counts = [d.count() for d in seen]
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4]
    groups = {r.component_id for r in simhash.near_duplicates(seen[1]).collect()}
    assert {r.doc_id for r in seen[2].collect()} == groups
    items = table(spark, tables, "benchmark")
    assert all(not r.spans for r in decontam.find_passages(seen[3], items).collect())
    assert all(not pii.base_spans(r.text) for r in seen[4].collect())
    packed = corpus_pipeline.run(spark, tables).collect()
    assert {r.doc_id for r in packed} == groups


def test_odd_documents(spark, odd, tables, none):
    for start in (odd, none):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, tables)
            assert docs.columns == odd.columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, tables).filter("piece = 0").count()
        assert out == docs.count() and (out > 0) == (start is odd)
