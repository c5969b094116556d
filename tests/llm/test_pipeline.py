import __spark_entry__ as entry
import corpus_pipeline
from listweave.llm.common import read_table
from listweave.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_stages_keep_the_columns(spark):
    docs = read_table(spark, SF, "documents")
    schema = docs.schema
    seen = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), schema)
        assert docs.columns == schema.names
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(set(ids)) == len(ids) and set(ids) <= seen
        seen = set(ids)
        if name == "near_dedup":
            assert all(r.doc_id == r.component_id for r in near_duplicates(docs).collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in last.collect()} == seen


def test_run_equals_stages(spark):
    a = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    b = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    assert a == b and a


def test_edge_cases(spark, docs, no_docs):
    for given, rows in ((docs, None), (no_docs, 0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, SF)
            assert rows is None or out.count() == rows
            out.count()
