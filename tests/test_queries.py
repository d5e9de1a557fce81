"""Queries outside the llm subpackage against their SQL."""

import pytest

import __spark_entry__ as driver
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"
QUERIES = {name: query for module in driver.MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in driver.MODULES for name, sql in module.ORACLE_SQL.items()}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert_same(QUERIES[name](spark, SF), con, SQL[name])


def test_entry_and_registry(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.queries())


def test_daily_counts_of_a_stream(spark, tmp_path):
    from brindle.streaming.counts import daily_counts

    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = daily_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.outputMode("append").format("memory").queryName("daily").option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    got = {(r.day.date(), r.event_type, r.n) for r in spark.table("daily").collect()}
    want = {(r.day, r.event_type, r.n) for r in events.selectExpr("to_date(ts) AS day", "event_type").groupBy("day", "event_type").count().withColumnRenamed("count", "n").collect()}
    assert got and got <= want  # days that the watermark has not passed are not final
