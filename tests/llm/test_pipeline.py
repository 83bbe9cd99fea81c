import corpus_pipeline
from marketlake.llm.common import durable
from marketlake.llm.queries import oracle_sql, queries
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


def test_sql_agrees(spark):
    con = connect("/root/testdata/sf0.01")
    for name, sql in oracle_sql().items():
        got = queries()[name](spark, "/root/testdata/sf0.01").toPandas()
        assert compare(got, con.sql(sql).df()) is None, name


def test_stages_hand_on_whole_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = durable(stage(spark, before, SF))
        assert after.columns == docs.columns, name
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        assert {r.doc_id for r in after.select("doc_id").collect()} <= ids, name
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert last.count() == before.count()


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    assert got.columns[:2] == ["doc_id", "n_tokens"] and got.count() > 0


def test_stages_take_odd_rows(spark, odd, none):
    for docs in (odd, none):
        before = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = durable(stage(spark, before, SF))
            assert after.columns == docs.columns, name
            before = after
        last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
        assert last.count() == before.count()
