from __future__ import annotations

import duckdb

import corpus_pipeline
from eventlake.llm.tables import stored, table
from tests.llm.conftest import SF


def test_each_stage_acts_on_what_the_one_before_kept(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        kept[name] = docs
        if name != "tokens":
            assert docs.columns == columns
    counts = {name: df.count() for name, df in kept.items()}
    n = table(spark, SF, "documents").count()
    assert n > counts["toxicity"] > counts["near duplicates"] > counts["decontamination"] > 0.6 * n
    assert counts["tokens"] == counts["mixing"]
    leaks = duckdb.sql(f"SELECT doc_id FROM '{SF}/documents.parquet' d JOIN '{SF}/benchmark.parquet' b ON contains(d.text, b.text)").fetchall()
    left = {r["doc_id"] for r in kept["decontamination"].select("doc_id").collect()}
    assert not left & {x for x, in leaks}
    toxic = duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE toxic = 1").fetchall()
    assert len(left & {x for x, in toxic}) < 0.05 * len(toxic)
    texts = [r["text"] for r in kept["near duplicates"].select("text").collect()]
    assert len(texts) == len(set(texts))


def test_stages_take_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        assert docs.count() == 0
