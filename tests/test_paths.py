"""Path matching (recursive prefixes, exact paths, wildcards) against brute force."""

import fnmatch

from wardlake.operators.matching import match_paths, path_ancestors

PATHS = ["/", "/en", "/en/825", "/en/825/x", "/fr/801", "/fr/9", "/orders/1996/42/1", "/orders/1996/420/1",
         "/english", "/user/u7/a"]
POLICIES = [  # (policy_id, pattern, recursive)
    (1, "/en", True), (2, "/en/825", False), (3, "/fr/8*", False), (4, "/orders/1996/42", True),
    (5, "/", True), (6, "/user/u7/", True), (7, "/e?", True),
]


def brute(path, pattern, recursive):
    pattern = pattern.rstrip("/") or "/"
    if "*" in pattern or "?" in pattern:
        return fnmatch.fnmatchcase(path, pattern) or (recursive and fnmatch.fnmatchcase(path, pattern + "/*"))
    if recursive:
        return pattern == "/" or path == pattern or path.startswith(pattern + "/")
    return path == pattern


def test_match_paths_bruteforce(spark):
    reqs = spark.createDataFrame([(i, p) for i, p in enumerate(PATHS)], "rid int, path string")
    res = spark.createDataFrame([(pid, "store", "path", pat, False, rec) for pid, pat, rec in POLICIES],
                                "policy_id long, service string, level string, pattern string, excludes boolean, "
                                "recursive boolean")
    got = {(r.rid, r.policy_id) for r in match_paths(reqs, ["rid"], res, "store").collect()}
    want = {(i, pid) for i, p in enumerate(PATHS) for pid, pat, rec in POLICIES if brute(p, pat, rec)}
    assert got == want


def test_ancestors(spark):
    df = spark.createDataFrame([("/a/b/c",), ("/",), ("/a/",)], "path string")
    got = [sorted(r[0]) for r in df.select(path_ancestors("path")).collect()]
    assert got == [sorted(["/a/b/c", "/a/b", "/a", "/"]), ["/"], sorted(["/a", "/"])]


def test_excluded_paths(spark):
    from wardlake.operators.matching import match_paths
    reqs = spark.createDataFrame([(1, "/a/b"), (2, "/a"), (3, "/c/d"), (4, "/x/1/y")], "id int, path string")
    res = spark.createDataFrame(
        [(1, "s", "path", "/a", True, True), (1, "s", "path", "/x/*", True, True), (2, "s", "path", "/a", True, False),
         (3, "s", "path", "/c", False, True)],
        "policy_id int, service string, level string, pattern string, excludes boolean, recursive boolean")
    got = sorted((r.policy_id, r.id, r.pattern) for r in match_paths(reqs, ["id"], res, "s").collect())
    assert got == [(1, 3, None), (2, 1, None), (2, 3, None), (2, 4, None), (3, 3, "/c")]


RES = "policy_id long, service string, level string, pattern string, excludes boolean, recursive boolean"


def test_own_paths(spark):
    """The macro stands for the requesting user, also beside a wildcard and in an excluding policy."""
    reqs = spark.createDataFrame([(1, "u1", "/user/u1/a"), (2, "u12", "/user/u1/a"), (3, "u1", "/logs/u1-x"),
                                  (4, "u1-x", "/logs/u1-x"), (5, "u\\E", "/user/u\\E"), (6, None, "/user/u1/a")],
                                 "id int, user string, path string")
    res = spark.createDataFrame([(1, "s", "path", "/user/{USER}", False, True), (2, "s", "path", "/logs/{USER}*", False, False),
                                 (3, "s", "path", "/user/{USER}", True, True)], RES)
    got = sorted((r.id, r.policy_id) for r in match_paths(reqs, ["id"], res, "s", "user").collect())
    assert got == [(1, 1), (2, 3), (3, 2), (3, 3), (4, 2), (4, 3), (5, 1), (6, 3)]
    none = match_paths(reqs, ["id"], res.where("policy_id = 1"), "s")
    assert none.count() == 0


def test_ten_thousand_wildcards(spark):
    """Many wildcard paths against brute force; the plan holds no nested loop."""
    rows = [(k, "s", "path", f"/d{k % 97}/s{k}/*.log" if k % 3 else f"/d{k % 97}/s{k}?", False, k % 2 == 0) for k in range(10_000)]
    reqs = [(k, f"/d{k % 97}/s{k * 7 % 10_000}/a.log" if k % 2 else f"/d{k % 97}/s{k}x/y") for k in range(300)]
    df = match_paths(spark.createDataFrame(reqs, "rid int, path string"), ["rid"], spark.createDataFrame(rows, RES), "s")
    got = {(r.rid, r.policy_id) for r in df.collect()}
    by_folder = {}
    for pid, _, _, pat, _, rec in rows:
        by_folder.setdefault(pat.split("/")[1], []).append((pid, pat, rec))
    want = {(i, pid) for i, p in reqs for pid, pat, rec in by_folder[p.split("/")[1]] if brute(p, pat, rec)}
    assert got == want and len(want) > 40
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_requests_are_not_regrouped(spark):
    """Shallow policies are joined in place and a request is not joined back: only the deep join shuffles requests."""
    reqs = spark.createDataFrame([(i, p) for i, p in enumerate([*PATHS, "//en//825/", "", None])], "rid int, path string")
    res = spark.createDataFrame([(pid, "store", "path", pat, False, rec) for pid, pat, rec in POLICIES], RES)
    df = match_paths(reqs, ["rid"], res, "store")
    got = {(r.rid, r.policy_id) for r in df.collect()}
    want = {(i, pid) for i, p in enumerate(PATHS) for pid, pat, rec in POLICIES if brute(p, pat, rec)}
    # a path that is not written in its short form meets the root alone
    assert got == want | {(len(PATHS), 5), (len(PATHS) + 1, 5)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_salt" not in plan
