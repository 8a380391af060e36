"""Bucketed artifact tables: what an upsert moves, and crawls that are missing."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import artifacts


def frame(spark, *rows):
    df = spark.createDataFrame([(d, u, s, k) for d, u, s, k in rows], "domain string, url string, status string, k string")
    return df.withColumn("metadata", F.create_map("k", "status")).drop("k")


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture
def shuffled(spark):
    """No table is small enough to be broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_upserts_move_new_rows_only(spark, tmp_path, shuffled):
    table = artifacts.write_bucketed(frame(spark, ("a", "1", "old", "x"), ("a", "2", "old", "x"), ("b", "1", "old", "x")), "crawls", ["domain", "url"])
    frame(spark, ("a", "2", "new", "y"), ("a", "2", "newer", "z"), ("c", "1", "new", "y")).write.parquet(str(tmp_path / "new"))
    rows = spark.read.parquet(str(tmp_path / "new"))
    for _ in range(2):  # the next snapshot is as good a table as the first
        plan = plan_of(artifacts.upserted(table, rows, [F.desc("status")]))
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        table = artifacts.upsert_artifacts(table, rows, [F.desc("status")], "crawls")
        got = {(r["domain"], r["url"]): (r["status"], r["metadata"]) for r in table.read(spark).collect()}
        assert got == {("a", "1"): ("old", {"x": "old"}), ("b", "1"): ("old", {"x": "old"}), ("a", "2"): ("newer", {"x": "old", "z": "newer"}), ("c", "1"): ("new", {"y": "new"})}


def test_results_meet_their_crawls(spark, shuffled):
    crawls = artifacts.write_bucketed(frame(spark, ("a", "1", "ok", "x"), ("b", "2", "failed", "x")), "crawls", ["domain", "url"]).read(spark).drop("metadata")
    search = spark.createDataFrame([("q", "a", "1"), ("r", "b", "2"), ("s", "a", "1")], "query string, domain string, url string")
    joined = artifacts.crawled_results(search, crawls)
    assert plan_of(joined).count("Exchange hashpartitioning") == 1
    assert sorted((r["query"], r["status"]) for r in joined.collect()) == [("q", "ok"), ("r", "failed"), ("s", "ok")]
    with pytest.raises(Exception, match="no crawl artifact for 9"):
        artifacts.crawled_results(search.union(spark.createDataFrame([("t", "a", "9")], search.schema)), crawls).collect()
