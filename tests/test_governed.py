from pyspark.sql import functions as F

import __spark_entry__ as se
from wardlake.sources.tables import scan_parquet


def test_governed_rows_subset_of_raw(spark, sf_dir):
    q = se.queries()
    gov = q["row_filter"](spark, sf_dir)
    raw = scan_parquet(spark, sf_dir, "orders")
    assert gov.count() <= raw.count()
    assert gov.join(raw, "o_orderkey", "left_anti").count() == 0


def test_mask_keeps_row_count(spark, sf_dir):
    q = se.queries()
    masked = q["column_mask"](spark, sf_dir)
    assert masked.count() == scan_parquet(spark, sf_dir, "customer").count()


def test_user_filter_sees_masked_values(spark, sf_dir):
    # a filter applied by the reader goes on top of the masked projection
    q = se.queries()
    g = q["governed_read_customer"](spark, sf_dir)
    assert g.where(F.col("c_mktsegment") == "BUILDING").count() == 0  # masked to XXXXXXXX


def test_filter_reaches_scan(spark, sf_dir):
    q = se.queries()
    plan = q["row_filter"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan


def test_subqueries_in_policies_are_refused(spark):
    import pytest

    from wardlake.operators import governed as g
    df = spark.createDataFrame([("2024-03-01", "abc", 5)], "d string, s string, n int").withColumn("d", F.to_date("d"))
    df.createOrReplaceTempView("hidden_rows")
    assert g.apply_row_filter(df, "extract(year from d) = 2024 AND s <> 'select from'").count() == 1
    for bad in ("n IN (SELECT n FROM hidden_rows)", "EXISTS (SELECT 1 FROM hidden_rows)",
                "n > (SELECT max(n) FROM hidden_rows)"):
        with pytest.raises(ValueError, match="subquery"):
            g.apply_row_filter(df, bad)
        with pytest.raises(ValueError, match="subquery"):
            g.apply_masks(df, {"s": ("MASK_NULL", None, bad)})
    with pytest.raises(ValueError, match="subquery"):
        g.apply_masks(df, {"n": ("CUSTOM", "{col} + (SELECT max(n) FROM hidden_rows)", None)})


def test_conditional_mask(spark):
    from wardlake.operators import governed as g
    df = spark.createDataFrame([("a", 1), ("b", 9), ("c", None)], "s string, n int")
    got = [r.s for r in g.apply_masks(df, {"s": ("MASK_NULL", None, "n < 5")}).collect()]
    assert got == [None, "b", None]
