import datetime as dt

from pyspark.sql import types as T

from wardlake.functions.masks import mask_column


def _one(spark, value, dtype, kind, expr=None):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", dtype)]))
    return df.select(mask_column("c", dtype, kind, expr)).first()[0]


def test_show_first_4(spark):
    # letters and digits after the first four become 'x'; other characters stay
    assert _one(spark, "abcdEF12-x", T.StringType(), "MASK_SHOW_FIRST_4") == "abcdxxxx-x"


def test_show_last_4(spark):
    assert _one(spark, "Customer#000000042", T.StringType(), "MASK_SHOW_LAST_4") == "xxxxxxxx#xxxxx0042"
    assert _one(spark, "abc", T.StringType(), "MASK_SHOW_LAST_4") == "abc"


def test_mask_default(spark):
    assert _one(spark, "Ab1-z", T.StringType(), "MASK") == "Xxn-x"


def test_hash_null_none(spark):
    h = _one(spark, "abc", T.StringType(), "MASK_HASH")
    assert h == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert _one(spark, "abc", T.StringType(), "MASK_NULL") is None
    assert _one(spark, "abc", T.StringType(), "MASK_NONE") == "abc"


def test_date_show_year(spark):
    got = _one(spark, dt.datetime(1996, 7, 14, 10, 0), T.TimestampNTZType(), "MASK_DATE_SHOW_YEAR")
    assert got == dt.datetime(1996, 1, 1)


def test_custom(spark):
    assert _one(spark, 123456.78, T.DoubleType(), "CUSTOM", "round({col}, -3)") == 123000.0
