"""The filter of known ids: exact results, few rows past it, and what is shuffled."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lookups


def test_filter_keeps_all_members_and_few_others(spark):
    ids = spark.range(0, 30_000, 3).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(300_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("x"))
    passed = lookups.may_hold(rows, "k", ids, 10_000)
    assert passed.columns == ["k", "x"]
    assert passed.join(ids, "k", "left_semi").count() == 10_000
    assert passed.count() < 10_000 + 290_000 / 150


@pytest.mark.parametrize("most", [lookups.MOST_BITS, 0])
def test_anti_join_is_exact(spark, monkeypatch, most):
    """Nulls are never known, repeated ids stay as often as they are given; without room for a filter the join is plain."""
    monkeypatch.setattr(lookups, "MOST_BITS", most)
    ids = spark.createDataFrame([(i % 50, i) for i in range(100)] + [(None, -1)], "k long, n int")
    done = spark.range(10_000).filter("id % 7 = 0").select(F.col("id").alias("k")).union(spark.createDataFrame([(None,)], "k long"))
    got = sorted(lookups.not_yet_of_many(ids, done, "k").select("n").collect())
    assert got == sorted(lookups.not_yet(ids, done, "k").select("n").collect())
    assert lookups.not_yet_of_many(ids.limit(0), done, "k").count() == 0
    assert lookups.not_yet_of_many(ids, done.limit(0), "k").count() == 101


def test_known_ids_are_filtered_before_they_move(spark, tmp_path):
    """The filter stands between the scan of the known ids and their exchange."""
    spark.range(1_000).select(F.col("id").alias("k")).write.parquet(str(tmp_path / "done"))
    done, ids = spark.read.parquet(str(tmp_path / "done")), spark.range(5).select(F.col("id").alias("k"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookups.not_yet_of_many(ids, done, "k")
        plan = joined._sc._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    side = plan[plan.index("SortMergeJoin") :]
    known = side[side.index("BroadcastHashJoin") - 400 :]
    assert known.index("Exchange hashpartitioning(k") < known.index("BroadcastHashJoin") < known.index("FileScan")
