import pytest
from pyspark.sql import functions as F

from wardlake.functions.globs import glob_to_regex

CASES = [
    ("orders", "orders", False, True), ("orders", "order", False, False), ("orders", "ord*", False, True),
    ("orders", "*", False, True), ("part", "par?", False, True), ("parts", "par?", False, False),
    ("a.b", "a.b", False, True), ("axb", "a.b", False, False), ("ORDERS", "orders", True, True),
    ("ORDERS", "orders", False, False), ("x(1)", "x(1)", False, True), ("a\\Eb", "a\\Eb", False, True),
    ("tpch", "TPCH", True, True), ("/en/825", "/en/*", False, True), ("", "*", False, True),
]


@pytest.mark.parametrize("value,pattern,ic,expected", CASES)
def test_glob(spark, value, pattern, ic, expected):
    df = spark.createDataFrame([(value, pattern)], "v string, p string")
    got = df.select(F.regexp_like("v", glob_to_regex(F.col("p"), ic)).alias("m")).first()["m"]
    assert got is expected


def test_glob_against_fnmatch_bruteforce(spark):
    """Random (value, pattern) pairs over a small alphabet, one Spark job,
    compared with Python's fnmatchcase (no '[' in the alphabet)."""
    import fnmatch
    import random
    rnd = random.Random(7)
    alpha_v, alpha_p = "ab.x/", "ab.x/*?"
    pairs = []
    for _ in range(600):
        v = "".join(rnd.choice(alpha_v) for _ in range(rnd.randint(0, 6)))
        p = "".join(rnd.choice(alpha_p) for _ in range(rnd.randint(0, 5)))
        pairs.append((v, p))
    df = spark.createDataFrame(pairs, "v string, p string")
    got = [r.m for r in df.select(F.regexp_like("v", glob_to_regex(F.col("p"))).alias("m")).collect()]
    assert got == [fnmatch.fnmatchcase(v, p) for v, p in pairs]
