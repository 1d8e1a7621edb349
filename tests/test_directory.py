from wardlake.operators import directory as d

LDIF = """dn: CN=alice,OU=Users,DC=x
changetype: add
objectClass: top
objectClass: user
cn: alice
sAMAccountName: Alice
userAccountControl: 514

dn: CN=team,OU=Groups,DC=x
changetype: add
objectClass: group
cn: team

dn: CN=team,OU=Groups,DC=x
changetype: modify
add: member
member: CN=alice,OU=Users,DC=x
-

dn: CN=alice,OU=Users,DC=x
changeType: Modify
replace: userAccountControl
userAccountControl: 512
-
"""


def test_parse_and_apply(spark, tmp_path):
    p = tmp_path / "in.ldf"
    p.write_text(LDIF)
    e = d.parse_entries(d.read_ldif(spark, str(p)))
    rows = e.select("dn", "changetype", "op", "op_attr").collect()
    assert len(rows) == 4
    assert sorted({r.changetype for r in rows}) == ["add", "modify"]
    a = {(r.dn, r.attr, r.value) for r in d.apply_changes(e).collect()}
    assert ("CN=alice,OU=Users,DC=x", "useraccountcontrol", "512") in a
    assert ("CN=alice,OU=Users,DC=x", "useraccountcontrol", "514") not in a
    assert ("CN=team,OU=Groups,DC=x", "member", "CN=alice,OU=Users,DC=x") in a
    assert ("CN=alice,OU=Users,DC=x", "objectclass", "user") in a


def test_first_rdn(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("cn=Bob,OU=Users,DC=x",)], "dn string")
    r = df.select(d.dn_first_rdn(F.col("dn")), d.under_base(F.col("dn"), "ou=users,dc=x")).first()
    assert r[0] == "Bob" and r[1] is True


def test_folded_encoded_and_empty_values(spark, tmp_path):
    p = tmp_path / "in.ldf"
    p.write_text("dn: CN=long,OU=Us\n ers,DC=x\nchangetype: add\ncn:: w6k=\nmail:\nnote: a: b\n")
    e = d.parse_entries(d.read_ldif(spark, str(p))).first()
    assert e.dn == "CN=long,OU=Users,DC=x"
    assert (e.attributes["cn"], e.attributes["mail"], e.attributes["note"]) == (["é"], [""], ["a: b"])


def _applied(spark, path, **kw):
    return {(r.dn, r.attr, r.value) for r in d.apply_changes(d.parse_entries(d.read_ldif(spark, str(path), **kw))).collect()}


CHANGES = """dn: CN=t
changetype: add
cn: t
member: a
member: b
mail: x

dn: CN=t
changetype: modify
add: member
member: c
member: a
-
delete: member
member: b
-
replace: mail
mail: y
mail: z
-
delete: phone
-

dn: CN=gone
changetype: add
cn: old
note: old

dn: CN=gone
changetype: delete


dn: CN=gone
cn: new

dn: CN=t
changetype: modify
delete: mail
mail: y
-
add: mail
mail: w
"""
AFTER = {("CN=t", "cn", "t"), ("CN=t", "member", "a"), ("CN=t", "member", "c"), ("CN=t", "mail", "z"),
         ("CN=t", "mail", "w"), ("CN=gone", "cn", "new")}


def test_several_operations_deletes_and_order(spark, tmp_path):
    (tmp_path / "a.ldf").write_text(CHANGES)
    (tmp_path / "b.ldf").write_bytes(CHANGES.replace("\n", "\r\n").encode())
    assert _applied(spark, tmp_path / "a.ldf") == AFTER
    assert _applied(spark, tmp_path / "b.ldf") == AFTER
    assert _applied(spark, tmp_path / "b.ldf", record_sep="\r\n\r\n") == AFTER


def test_later_file_wins_whatever_its_size(spark, tmp_path):
    one = "dn: CN=a\nchangetype: modify\nreplace: mail\nmail: {}\n-\n"
    (tmp_path / "1.ldf").write_text(one.format("first"))
    (tmp_path / "2.ldf").write_text("\n".join([one.format("second")] + [one.format("x").replace("CN=a", f"CN={i}")
                                                                      for i in range(300)]))
    assert ("CN=a", "mail", "second") in _applied(spark, tmp_path)
    assert ("CN=a", "mail", "first") not in _applied(spark, tmp_path)


def test_renames_raise(spark, tmp_path):
    import pytest
    (tmp_path / "a.ldf").write_text("dn: CN=a\nchangetype: modrdn\nnewrdn: CN=b\n")
    with pytest.raises(Exception, match="changetype not supported"):
        _applied(spark, tmp_path / "a.ldf")


def test_records_are_read_and_taken_apart_once(spark, tmp_path):
    (tmp_path / "a.ldf").write_text(CHANGES)
    changes = d.changes_of(d.parse_entries(d.read_ldif(spark, str(tmp_path / "a.ldf"))))
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert plan.count("regexp_extract(") <= 4  # a line of an attribute, a line of an operation; before: for each key
    kinds = {(r.attr, r.value, r.kind) for r in changes.where("dn = 'CN=t'").collect()}
    assert {("mail", None, "reset"), ("phone", None, "reset"), ("member", "b", "cut"), ("mail", "w", "put")} <= kinds
    assert (None, None, "gone") in {(r.attr, r.value, r.kind) for r in changes.where("dn = 'CN=gone'").collect()}
