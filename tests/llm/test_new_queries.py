import duckdb

from revstrata.llm import licences, queries
from revstrata.tables import load


def test_centroids_equal_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    expected = con.execute(queries.oracle_sql()["op13_centroids"]).fetchall()
    got = [tuple(r) for r in queries.op13_centroids(spark, d).collect()]
    assert sorted(got) == sorted(expected) and len(got) == load(spark, d, "embeddings").count()


def test_licence_columns(spark):
    d = "/root/testdata/sf0.001"
    scanner, expected = licences.Scanner(), []
    for r in load(spark, d, "documents").collect():
        n, places, spans, most = scanner.scan((r.text or "").encode())
        base = sorted({scanner.labels[p] for _, p in places})
        every = sorted({*base, *(scanner.labels[t] for t, *_ in spans)})
        starts = [s for s, _ in places]
        expected.append((r.doc_id, n, len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(every), max(m / k for m, k in zip(most, scanner.sizes, strict=True))))
    got = [tuple(r) for r in queries.op12_licences(spark, d).collect()]
    assert sorted(got) == sorted(expected) and any(r[2] for r in got)
