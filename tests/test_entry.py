import __spark_entry__


def test_contract():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert "ref_listing" in queries and set(sql) <= set(queries)


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0
