"""Newest item per glob against trying every glob on every item."""

import fnmatch
import random

from wardlake.operators.retail import latest_matching


def test_against_every_pair(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 5))) for _ in range(60)] + [None]
    items = [(k, rng.choice(names), rng.randint(0, 20)) for k in range(400)]
    globs = [("all", "*"), ("none", "zz*"), ("two", "a*"), ("two", "b?*"), ("exact", names[3]), ("inner", "?a*b"), ("empty", "")]
    got = latest_matching(spark.createDataFrame(items, "id int, name string, day int"),
                          spark.createDataFrame(globs, "label string, glob string"), "name", ["day", "id"])
    assert got.columns == ["label", "id", "name", "day"]
    want = {}
    for label, glob in globs:
        for k, name, day in items:
            if name is not None and fnmatch.fnmatchcase(name, glob):
                want[label] = max(want.get(label, (-1, -1, "")), (day, k, name))
    assert {r.label: (r.day, r.id, r.name) for r in got.collect()} == want
