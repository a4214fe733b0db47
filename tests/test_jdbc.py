"""The JDBC source over an embedded database: whole, by ranges, and with what Spark pushes down."""

from __future__ import annotations

from loomtext.sources import io

URL = "jdbc:derby:memory:loomtext;create=true"
DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_read_jdbc(spark):
    rows = [(i, f"name {i}", i * 1.5) for i in range(100)]
    df = spark.createDataFrame(rows, "ID int, NAME string, MCAP double")
    df.write.format("jdbc").options(url=URL, dbtable="CAPS", **DRIVER).mode("overwrite").save()
    whole = io.read_jdbc(spark, URL, "CAPS", **DRIVER)
    assert sorted(map(tuple, whole.collect())) == rows
    ranges = io.read_jdbc(spark, URL, "CAPS", column="ID", bounds=(0, 100), partitions=4, **DRIVER)
    assert ranges.rdd.getNumPartitions() == 4 and sorted(map(tuple, ranges.collect())) == rows
    some = io.read_jdbc(spark, URL, "(SELECT ID, MCAP FROM CAPS WHERE ID < 50) T", **DRIVER).filter("ID >= 40")
    assert "PushedFilters: [*IsNotNull(ID), *GreaterThanOrEqual(ID,40)]" in some._jdf.queryExecution().toString()
    assert sorted(r.ID for r in some.collect()) == list(range(40, 50))
