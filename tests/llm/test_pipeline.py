import corpus_pipeline as C
from fleetwise.llm import queries as Q
from fleetwise.llm import toxicity

EDGE = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "some text of a few words", None, "s", 5), (2, "some text of a few words", None, "s", 5),
        (3, "long " * 30000, "en", None, 1), (4, "a\nb c 　", "xx", "s", None)]


def test_stages_on_edge_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(toxicity, "STEPS", 10)
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS score", "2 AS size", "3 AS fp", "4 AS t", "5 AS toxicity", "6 AS key", "7 AS item_id", "8 AS _stay")
    spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "an item of eight words or a few more")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        for name, stage in C.STAGES:
            got = stage(spark, rows, str(tmp_path))
            if name != C.STAGES[-1][0]:
                assert got.columns == docs.columns, name
                assert [f.dataType for f in got.schema] == [f.dataType for f in docs.schema], name
            got.count()


def test_pipeline_is_its_stages(spark, monkeypatch):
    """Toxic documents go, one of each group stays, benchmark passages go, and the files hold the mix."""
    monkeypatch.setattr(toxicity, "STEPS", 20)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = {r.doc_id for r in docs.collect()}
    for name, stage in C.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, sf), "stage")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= held and len(now) > 0.5 * len(held)
        held = now
    leaks = Q.QUERIES["op1_benchmark_overlaps"](spark, sf).select("doc_id").distinct().collect()
    assert leaks and not held & {r.doc_id for r in leaks}
    ran = C.run(spark, sf).collect()
    assert sorted(r.doc_id for r in ran) == sorted(r.doc_id for r in docs.collect())
