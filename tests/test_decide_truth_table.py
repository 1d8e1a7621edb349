"""Frozen decision rule (see wardlake/operators/access.py)."""

import pytest

from wardlake.operators import access

ITEM_COLS = ("policy_id long, service string, policy_type int, priority int, is_enabled boolean, "
             "is_audit_enabled boolean, deny_all_else boolean, item_kind string, item_no int, "
             "principal_kind string, principal string, access string, is_allowed boolean")
RES_COLS = "policy_id long, service string, level string, pattern string, excludes boolean, recursive boolean"

S = "svc"


def item(pid, kind, pk, p, acc, prio=0, enabled=True, dae=False):
    return (pid, S, 0, prio, enabled, True, dae, kind, 0, pk, p, acc, True)


def res(pid, level, pattern, excludes=False):
    return (pid, S, level, pattern, excludes, False)


# policy 1: t1.* allow group g1 select, allow-exception user u9
# policy 2: t1.secret deny group g2 select, deny-exception user u8
# policy 3 (override): t2.* deny group g3 select; allow g3 update
# policy 4: t3.* deny-all-else, allow user u5 select
# policy 5: tables except t1 (excludes), allow public update
# policy 6: disabled, t1.* allow public drop
# policy 8: t4.* deny-all-else without any item
ITEMS = [
    item(1, "allow", "group", "g1", "select"), item(1, "allow_exception", "user", "u9", "select"),
    item(2, "deny", "group", "g2", "select"), item(2, "deny_exception", "user", "u8", "select"),
    item(3, "deny", "group", "g3", "select", prio=1), item(3, "allow", "group", "g3", "update", prio=1),
    item(4, "allow", "user", "u5", "select", dae=True),
    item(5, "allow", "group", "public", "update"),
    item(6, "allow", "group", "public", "drop", enabled=False),
    item(7, "allow", "group", "g2", "select"),
    (8, S, 0, 0, True, True, True, None, None, None, None, None, None),
]
RES = [
    res(1, "table", "t1"), res(1, "column", "*"),
    res(2, "table", "t1"), res(2, "column", "secret"),
    res(3, "table", "t2"),
    res(4, "table", "t3"),
    res(5, "table", "t1", excludes=True),
    res(6, "table", "t1"),
    res(7, "table", "t2"),
    res(8, "table", "t4"),
]
MEMBERS = [("u1", "g1"), ("u2", "g2"), ("u3", "g3"), ("u8", "g2"), ("u9", "g1"), ("u12", "g1"), ("u12", "g2")]

TRUTH = [
    # user, access, table, column, decision, policy
    ("u1", "select", "t1", "a", "ALLOW", 1),            # group allow
    ("u9", "select", "t1", "a", "NOT_DETERMINED", None),  # allow exception cancels the allow
    ("u2", "select", "t1", "secret", "DENY", 2),        # deny item
    ("u12", "select", "t1", "secret", "DENY", 2),       # deny beats allow
    ("u8", "select", "t1", "secret", "NOT_DETERMINED", None),  # deny exception cancels the deny
    ("u2", "select", "t2", "a", "ALLOW", 7),            # normal allow, no override matches g2
    ("u3", "select", "t2", "a", "DENY", 3),             # override deny
    ("u3", "update", "t2", "a", "ALLOW", 3),            # override allow wins over nothing
    ("u5", "select", "t3", "a", "ALLOW", 4),            # allowed inside deny-all-else
    ("u1", "select", "t3", "a", "DENY", 4),             # deny-all-else
    ("u1", "update", "t2", "a", "ALLOW", 5),            # excludes: t2 is not t1
    ("u1", "update", "t1", "a", "NOT_DETERMINED", None),  # excludes: t1 excluded
    ("u1", "drop", "t1", "a", "NOT_DETERMINED", None),  # disabled policy ignored
    ("u1", "select", "t4", "a", "DENY", 8),             # deny-all-else of a policy without items
    ("u7", "select", "t9", "a", "NOT_DETERMINED", None),  # nothing fits
]


@pytest.fixture(scope="module")
def decided(spark):
    items = spark.createDataFrame(ITEMS, ITEM_COLS)
    resources = spark.createDataFrame(RES, RES_COLS)
    opts = spark.createDataFrame([(S, "table", False, False), (S, "column", False, False)],
                                 "service string, level string, ignore_case boolean, recursive_supported boolean")
    keys = spark.createDataFrame([t[:4] for t in TRUTH], "user string, access string, tbl string, col string")
    members = spark.createDataFrame(MEMBERS, "user string, grp string")
    roles = spark.createDataFrame([], "role string, grp string")
    princ = access.user_tags(keys.select("user"), members, roles)
    out = access.decide(keys, ["user", "access", "tbl", "col"], {"table": "tbl", "column": "col"},
                        items, resources, opts, princ, S)
    return {(r.user, r.access, r.tbl, r.col): (r.decision, r.policy_id) for r in out.collect()}


@pytest.mark.parametrize("row", TRUTH, ids=[f"{t[0]}-{t[1]}-{t[2]}.{t[3]}" for t in TRUTH])
def test_truth_table(decided, row):
    assert decided[row[:4]] == (row[4], row[5])
