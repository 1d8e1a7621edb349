import json

import pytest

from wardlake.operators import policies as pol
from wardlake.operators import policylog as pl


def test_malformed_export_raises(spark, tmp_path):
    p = tmp_path / "e.jsonl"
    p.write_text(json.dumps({"policies": [{"id": 1, "service": "s"}]}) + '\n{"policies": [{"id": 2, "ser\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        pol.read_export(spark, str(p), multi_line=False).collect()


def test_path_without_scheme_is_taken_whole(spark):
    cols = ("log_ts string, seq long, service string, kind string, policy_id long, groups string, "
            "read_allowed string, write_allowed string, first_values string")
    fields = spark.createDataFrame([("t", 1, "objectstore", "update", 7, "g", "true", "false", "s3://b/x plain/y")], cols)
    r = pl.grants_object_store(fields).first()
    assert [a.removeprefix(pl.ARN_PREFIX) for a in r.resources] == ["b/x", "plain/y"]


def test_a_policy_without_items_keeps_its_header(spark, tmp_path):
    p = tmp_path / "e.json"
    p.write_text('{"policies": [{"id": 5, "service": "s", "isDenyAllElse": true}, '
                 '{"id": 6, "service": "s", "policyItems": [{"users": ["u"]}]}]}')
    rows = pol.v2_items(pol.read_export(spark, str(p))).orderBy("policy_id").collect()
    assert [(r.policy_id, r.deny_all_else, r.item_kind, r.principal, r.access) for r in rows] == [
        (5, True, None, None, None), (6, False, "allow", "u", None)]
