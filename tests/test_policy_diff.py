"""Structural diff of two policy exports."""

import json

from wardlake.operators import policies as pol


def _export(tmp_path, name, policies):
    path = tmp_path / name
    path.write_text(json.dumps({"policies": policies}))
    return str(path)


def _policy(guid, paths, **more):
    item = {"accesses": [{"type": "read"}], "users": ["a"], "groups": [], "roles": [], "conditions": [], "delegateAdmin": False}
    return {"id": 1, "guid": guid, "service": "s", "name": guid, "version": 1, "isEnabled": True,
            "resources": {"path": {"values": paths, "isRecursive": True}}, "policyItems": [item], **more}


def test_path_flag_mask_and_whole_policies(spark, tmp_path):
    mask = {"accesses": [{"type": "select"}], "users": [], "groups": ["g"], "roles": [], "conditions": ["c1"],
            "dataMaskInfo": {"dataMaskType": "MASK", "valueExpr": None, "conditionExpr": "x < 5"}}
    before = [_policy("p1", ["/a", "/tmp"]), _policy("p2", ["/b"]), _policy("p4", ["/same"])]
    after = [_policy("p1", ["/a"], version=2, isEnabled=False, dataMaskPolicyItems=[mask]), _policy("p3", ["/c"]), _policy("p4", ["/same"])]
    got = pol.policy_version_diff(pol.read_export(spark, _export(tmp_path, "a.json", before)),
                                  pol.read_export(spark, _export(tmp_path, "b.json", after)))
    rows = {(r.guid, r.path, r.previous_value, r.current_value, r.policy_change) for r in got.collect()}
    assert {r for r in rows if r[0] == "p1"} == {
        ("p1", "resources.path.values", "/tmp", None, "changed"), ("p1", "version", "1", "2", "changed"),
        ("p1", "isEnabled", "true", "false", "changed"), ("p1", "mask", None, "group:g select MASK x < 5", "changed"),
        ("p1", "mask.conditions", None, "c1", "changed")}
    assert {r[4] for r in rows if r[0] == "p2"} == {"dropped_policy"}
    assert {r[4] for r in rows if r[0] == "p3"} == {"new_policy"}
    assert not [r for r in rows if r[0] == "p4"]


def test_repeated_and_missing_guids(spark, tmp_path):
    """Documents that share a guid pair all their values; a document without a guid takes no part."""
    before = [_policy("p1", ["/a"], version=1), _policy("p1", ["/a", "/b"], version=2), _policy(None, ["/n"])]
    after = [_policy("p1", ["/a"], version=2), _policy("p1", ["/c"], version=2)]
    got = pol.policy_version_diff(pol.read_export(spark, _export(tmp_path, "a.json", before)),
                                  pol.read_export(spark, _export(tmp_path, "b.json", after)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == [
        ("p1", "resources.path.values", "/b", None, "changed"), ("p1", "resources.path.values", None, "/c", "changed"),
        ("p1", "version", "1", "2", "changed")]


def test_exports_meet_in_one_shuffle(spark, tmp_path):
    """The facts of a policy are compared as lists in the row: no distinct and no join of single facts."""
    path = _export(tmp_path, "a.json", [_policy("p1", ["/a"])])
    plan = pol.policy_version_diff(pol.read_export(spark, path), pol.read_export(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
