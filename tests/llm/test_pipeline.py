import sys

import corpus_pipeline
from revstrata.llm.common import written


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, n = docs.columns, docs.count()
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, sf), name)
        assert out.columns == names and 0 < out.count() <= n and out.exceptAll(docs).isEmpty()
        docs, n = out, out.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()} and all(r.lossless for r in last)


def test_run_on_odd_and_no_rows(spark, tmp_path, odd, none):
    """Nulls in any column, empty and long texts, repeated rows, columns whose names clash with those that stages add, and an empty table."""
    from pyspark.sql import functions as F

    clash = odd.withColumn("topic", F.lit("own")).withColumn("weight", F.lit(1)).withColumn("predicted", F.lit(7)).withColumn("lang_pred", F.lit("xx")).withColumn("ids", F.lit("mine"))
    for name, docs in (("odd", clash), ("none", clash.limit(0))):
        sf = str(tmp_path / name)
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        rows = corpus_pipeline.run(spark, sf).collect()
        ids = [r.doc_id for r in rows]
        assert all(r.lossless and r.n_pieces == len(r.ids) for r in rows)
        # 3, 4, 5 and 9 have no letters; 1 stands for the copies 1, 2 and 2; the others may be thinned by mixing
        assert set(ids) <= {1, 6, 7, 8, None} and len(ids) == len(set(ids)) and (name == "odd" or not rows)


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert "revstrata.llm" in sys.modules
