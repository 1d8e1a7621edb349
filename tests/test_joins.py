from pyspark.sql import functions as F

from wardlake.operators.joins import attach_each, skew_safe_join


def test_skew_safe_join_both_paths(spark):
    big = spark.createDataFrame([(1 if i % 3 else 2, i) for i in range(300)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    expect = sorted((r.k, r.v, r.name) for r in big.join(small, "k").collect())
    for limit in (10, 1):  # broadcast path, then salted path
        got = sorted((r.k, r.v, r.name) for r in skew_safe_join(big, small, ["k"], limit=limit).collect())
        assert got == expect


def test_attach_each_both_paths(spark):
    big = spark.range(50).withColumnRenamed("id", "u")
    small = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "p string")
    for limit in (10, 1):
        got = attach_each(big, small, limit=limit, buckets=4)
        assert got.count() == 150
        assert got.groupBy("u").agg(F.count("p").alias("n")).where("n != 3").count() == 0


def test_column_family_round_trip(spark):
    from wardlake.sources.sinks import from_column_families, to_column_families
    df = spark.createDataFrame([("k1", "a", True), ("k2", "b", False)], "ad_id string, page string, clicked boolean")
    fam = to_column_families(df, "ad_id", "analyst1")
    assert fam.columns == ["rowkey", "analyst1"]
    back = from_column_families(fam, "analyst1", "ad_id")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
