"""The pipeline's stages, each on its own input."""

import corpus_pipeline
from conftest import SMALL_SF

import __spark_entry__ as entry
from plexus.llm import decontamination, queries, quality_rules, simhash
from plexus.llm.common import table


def test_stages(spark):
    docs = table(spark, SMALL_SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "decontamination", "secret_scans", "packing"]
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SMALL_SF).cache()
        assert docs.columns == before.columns
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "quality_rules":
            kept = quality_rules.judge(before, table(spark, SMALL_SF, "labels")).where("kept")
            assert ids[name] == {r.doc_id for r in kept.collect()}
        if name == "simhash_near_dedup":
            assert ids[name] == {r.component_id for r in simhash.near_duplicates(before).collect()}
        if name == "decontamination":
            bad = decontamination.contaminated(before, table(spark, SMALL_SF, "benchmark"))
            assert ids[name] == ids["simhash_near_dedup"] - {r.doc_id for r in bad.collect()}
        if name == "secret_scans":
            assert ids[name] == ids["decontamination"]
    pieces = corpus_pipeline.pack(spark, docs, SMALL_SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == ids["secret_scans"]


def test_registered():
    found = entry.queries()
    assert set(queries.QUERIES) <= set(found) and "pipeline" in found
    assert [f"op{n}_" for n in range(1, 11)] == [f"op{n}_" for n in range(1, 11) if any(q.startswith(f"op{n}_") for q in found)]
