import json
import random

import pytest
from pyspark.sql import functions as F

from wardlake.functions import jsoncols as jc

# Authored strictness corpus: (text, accepted by the strict parse).
CORPUS = [
    ('{"a": 1}', True), ("[1, 2, 3]", True), ('"text"', True), ("42", True), ("null", True),
    ("[1,]", False), ('{"a":01}', False), ('{"a":0x14}', False), ("{'a': 1}", False),
    ('{"a" 1}', False), ("[1, 2", False), ('{"a": tru}', False), ("", False), ("plain words", False),
    ('{"a": "tab\tinside"}', False),
]


@pytest.mark.parametrize("text,ok", CORPUS)
def test_strict_corpus(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(jc.parse_strict(F.col("t")).isNotNull()).first()[0]
    assert got is ok


# Authored: text after or between complete values.
TRAILING = ['["Extra close"]]', "1 2", "1, 2", '1, "v": 2', '{"a": 1}}', '1}, {"a":2', "1], [2", '{"a": 1} x', '"a" "b"', "[1],"]


@pytest.mark.parametrize("text", TRAILING)
def test_trailing_text_is_refused(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(jc.parse_strict(F.col("t")).isNull()).first()[0] is True


def _walk(v, path="$"):
    if isinstance(v, dict) and v:
        return [x for k, w in v.items() for x in _walk(w, f"{path}.{k}")]
    if isinstance(v, list) and v:
        return [x for k, w in enumerate(v) for x in _walk(w, f"{path}[{k}]")]
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "number", type(None): "null"}[type(v)]
    return [(path, kind, None if kind in ("object", "array", "null") else json.dumps(v) if kind != "string" else v)]


def test_nested_documents(spark):
    """A walk and a canonical text of random nested documents against plain Python."""
    rng = random.Random(6)

    def made(depth):
        kind = rng.random()
        if depth and kind < .35:
            return {rng.choice(["z", "a", "é", "B", "k9", "long_key"]): made(depth - 1) for _ in range(rng.randint(0, 4))}
        if depth and kind < .6:
            return [made(depth - 1) for _ in range(rng.randint(0, 3))]
        return rng.choice([None, True, False, 7, -12345678901, "text", "", "quo\"te \n é"])

    docs = [made(5) for _ in range(60)] + [{"a": {"b": {"c": [[[{"d": None}]]]}}}, [], {}]
    df = spark.createDataFrame([(k, json.dumps(d, ensure_ascii=False, indent=1)) for k, d in enumerate(docs)] + [(99, "[1"), (98, None)],
                               "id int, t string")
    got = sorted(((r.id, r.path, r.type, r.value) for r in jc.flatten(df, ["id"], "t").collect()), key=str)
    assert got == sorted(((k, *x) for k, d in enumerate(docs) for x in _walk(d)), key=str)
    texts = {r.id: r.c for r in df.select("id", jc.canonical_text(F.col("t")).alias("c")).collect()}
    assert texts == {**{k: json.dumps(d, ensure_ascii=False, sort_keys=True, separators=(",", ":")) for k, d in enumerate(docs)},
                     99: None, 98: None}


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, "[1,]"), (3, "nope")], "id int, t string")
    good, bad = jc.quarantine(df, "t")
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.id for r in bad.collect()) == [2, 3]


def test_nonfinite(spark):
    df = spark.createDataFrame([('{"v": NaN}',), ('{"v": Infinity}',), ('{"v": -Infinity}',), ('{"v": 2.5}',)], "t string")
    vals = [r[0] for r in df.select(jc.parse_nonfinite(F.col("t"), "v double")["v"]).collect()]
    assert vals[1] == float("inf") and vals[2] == float("-inf") and vals[3] == 2.5 and vals[0] != vals[0]


def test_canonical_sorted_keys(spark):
    df = spark.createDataFrame([(2, "b", 1.5)], "z int, a string, m double")
    assert df.select(jc.canonical(["z", "a", "m"])).first()[0] == '{"a":"b","m":1.5,"z":2}'


def test_empty_containers_and_arrays_of_nulls(spark):
    df = spark.createDataFrame([(1, '{"a": [], "b": {}, "c": [null], "d": [[]], "e": [{}], "f": "[]"}')], "id int, t string")
    leaves = jc.flatten(df, ["id"], "t")
    assert "opened" in leaves._jdf.queryExecution().optimizedPlan().toString()  # before: each container written out again per read
    got = {(r.path, r.type) for r in leaves.collect()}
    assert got == {("$.a", "array"), ("$.b", "object"), ("$.c[0]", "null"), ("$.d[0]", "array"), ("$.e[0]", "object"), ("$.f", "string")}
