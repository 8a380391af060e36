import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_uneven, materialize
from ledgerloom.llm.jaccard import connected_components


def scans(df):
    return len(re.findall(r"FileScan", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("keys, hot, most, read", [(40, 0, 2048, 2), (40, 500, 2048, 2), (300, 0, 200, 2), (300, 500, 200, 5)])
def test_join_uneven_reads_each_side_once(spark, keys, hot, most, read):
    left = spark.range(keys * 3).select((F.col("id") % keys).alias("k"), F.col("id").alias("x")).union(spark.range(hot).select(F.lit(0).cast("long"), F.col("id")))
    left = materialize(left.union(spark.sql("select cast(null as long), 7L")), "test-left")
    right = materialize(left.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("y")), "test-right")
    out = join_uneven(left, right, ["k"], "n", most)
    assert out.columns == ["k", "x", "y"]
    assert scans(out) <= read
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, left.join(right.drop("n"), "k").collect()))


def test_join_uneven_several_rows_a_key(spark):
    left = spark.range(600).select((F.col("id") % 300).alias("k"), F.col("id").alias("x"))
    right = spark.range(900).select((F.col("id") % 300).alias("k"), F.lit(2).alias("n"), F.col("id").alias("y"))
    for most in (50, 2048):
        assert join_uneven(left, right, ["k"], "n", most).count() == 1800


def test_rounds_of_components_read_edges_once(spark, monkeypatch):
    from ledgerloom.llm import jaccard

    read = {}

    def written(df, tag, codec="snappy"):
        read[tag] = max(read.get(tag, 0), scans(df))
        return materialize(df, tag, codec)

    monkeypatch.setattr(jaccard, "materialize", written)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (102, 103), (200, 200)], "u long, v long")
    found = {r[0]: r[1] for r in connected_components(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)}
    assert read["cc-large"] <= 2 and read["cc-small"] <= 2
