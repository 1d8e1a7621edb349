"""Resource matching (literal, wildcard, excludes, ignore-case, missing levels) against brute force."""

import fnmatch
import itertools

from wardlake.operators.matching import match_resources

KEYS = [(d, t, c) for d, t, c in itertools.product(["tpch", "web", "TPCH"], ["orders", "part", "parts", "nation"],
                                                   ["c1", "p_x", "secret"])]
# (policy_id, level, pattern, excludes)
RES = [
    (1, "database", "tpch", False), (1, "table", "*", False), (1, "column", "*", False),
    (2, "database", "tpch", False), (2, "table", "par?", False), (2, "column", "p_*", False),
    (3, "database", "*", False), (3, "table", "nation", True), (3, "table", "part", True),
    (4, "table", "orders", False),                       # no database/column level: covers all
    (5, "database", "web", False), (5, "udf", "f*", False),  # a level the keys lack: never fits
    (6, "column", "secret", True),                       # excludes only
    (7, "database", "tp?h", False), (7, "column", "c1", False), (7, "column", "secret", False),
]
IGNORE_CASE = {"database": True, "table": True, "column": False}


def brute(key):
    vals = {"database": key[0], "table": key[1], "column": key[2]}
    out = set()
    for pid in sorted({r[0] for r in RES}):
        ok = True
        for level in sorted({r[1] for r in RES if r[0] == pid}):
            rows = [r for r in RES if r[0] == pid and r[1] == level]
            if level not in vals:
                ok = False
                break
            v = vals[level]
            ic = IGNORE_CASE.get(level, False)
            hit = any(fnmatch.fnmatchcase(v.lower() if ic else v, p.lower() if ic else p) for _, _, p, _ in rows)
            if hit == rows[0][3]:
                ok = False
                break
        if ok:
            out.add(pid)
    return out


def test_match_resources_bruteforce(spark):
    keys = spark.createDataFrame(KEYS, "db string, tbl string, col string")
    res = spark.createDataFrame([(p, "svc", l, pat, ex, False) for p, l, pat, ex in RES],
                                "policy_id long, service string, level string, pattern string, excludes boolean, "
                                "recursive boolean")
    opts = spark.createDataFrame([("svc", l, ic, False) for l, ic in IGNORE_CASE.items()],
                                 "service string, level string, ignore_case boolean, recursive_supported boolean")
    m = match_resources(keys, ["db", "tbl", "col"], {"database": "db", "table": "tbl", "column": "col"},
                        res, opts, "svc")
    got = {(r.db, r.tbl, r.col, r.policy_id) for r in m.collect()}
    want = {(*k, pid) for k in KEYS for pid in brute(k)}
    assert got == want
