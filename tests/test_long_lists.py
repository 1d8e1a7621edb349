"""Policies that name more principals than a row may hold are decided like the others."""

from wardlake.operators import access
from test_decide_truth_table import ITEM_COLS, RES_COLS, item, res


def test_long_list_of_principals(spark):
    n = access.LONG_LIST + 50
    items = [item(1, "allow", "user", f"u{k}", "select") for k in range(n)]
    items += [item(2, "deny", "group", f"g{k}", "select") for k in range(n)] + [item(2, "deny_exception", "user", "u7", "select")]
    items += [item(3, "allow", "user", "u9999", "select")]
    keys = spark.createDataFrame([(u, "select", t) for u in ("u1", "u7", "u9999", "x") for t in ("t1", "t2")],
                                 "user string, access string, tbl string")
    members = spark.createDataFrame([("u1", "g3"), ("u7", "g3")], "user string, grp string")
    princ = access.user_tags(keys, members, spark.createDataFrame([], "role string, grp string"))
    opts = spark.createDataFrame([("svc", "table", False, False)],
                                 "service string, level string, ignore_case boolean, recursive_supported boolean")
    resources = spark.createDataFrame([res(1, "table", "*"), res(2, "table", "t2"), res(3, "table", "t1")], RES_COLS)
    got = {(r.user, r.tbl): r.decision for r in access.decide(
        keys, ["user", "access", "tbl"], {"table": "tbl"}, spark.createDataFrame(items, ITEM_COLS), resources, opts, princ, "svc").collect()}
    assert got == {("u1", "t1"): "ALLOW", ("u1", "t2"): "DENY", ("u7", "t1"): "ALLOW", ("u7", "t2"): "ALLOW",
                   ("u9999", "t1"): "ALLOW", ("u9999", "t2"): "NOT_DETERMINED", ("x", "t1"): "NOT_DETERMINED",
                   ("x", "t2"): "NOT_DETERMINED"}
