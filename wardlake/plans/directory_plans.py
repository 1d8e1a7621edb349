"""Directory entries: LDIF built from ``customer`` by Spark, then parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators import directory as d
from wardlake.operators.joins import skew_safe_join
from wardlake.plans import fixtures as fx
from wardlake.plans.registry import query
from wardlake.session import cut_lineage, fresh_path
from wardlake.sources.tables import scan_parquet

# Directory layout.
USERS_OU = "OU=Users,DC=lake,DC=example"
GROUPS_OU = "OU=Groups,DC=lake,DC=example"


def _user_dn(key):
    return F.concat(F.lit("CN=u"), key.cast("string"), F.lit("," + USERS_OU))


def _group_dn(grp):
    return F.concat(F.lit("CN="), grp, F.lit("," + GROUPS_OU))


def _rec(*parts):
    return F.concat(F.concat_ws("\n", *parts), F.lit("\n"))


def ldif_adds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users (disabled at add) and groups."""
    c = scan_parquet(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    users = c.select(_rec(
        F.concat(F.lit("dn: "), _user_dn(k)), F.lit("changetype: add"), F.lit("objectClass: top"),
        F.lit("objectClass: person"), F.lit("objectClass: user"), F.concat(F.lit("cn: u"), k.cast("string")),
        F.concat(F.lit("sAMAccountName: U"), k.cast("string")), F.concat(F.lit("name: "), F.col("c_name")),
        F.lit("userAccountControl: 514"), F.concat(F.lit("distinguishedName: "), _user_dn(k))).alias("value"))
    groups = fx.memberships(spark, sf_dir).select("grp").distinct().select(_rec(
        F.concat(F.lit("dn: "), _group_dn(F.col("grp"))), F.lit("changetype: add"), F.lit("objectClass: top"),
        F.lit("objectClass: group"), F.concat(F.lit("cn: "), F.col("grp")),
        F.concat(F.lit("sAMAccountName: "), F.col("grp")),
        F.concat(F.lit("distinguishedName: "), _group_dn(F.col("grp")))).alias("value"))
    return users.unionByName(groups)


def ldif_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One membership record per member, an enable record for customers with
    a positive balance, and for every tenth customer a record that deletes one
    object class and adds a title."""
    c = scan_parquet(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    k = F.col("c_custkey")
    members = fx.memberships(spark, sf_dir).select(_rec(
        F.concat(F.lit("dn: "), _group_dn(F.col("grp"))), F.lit("changetype: modify"), F.lit("add: member"),
        F.concat(F.lit("member: CN="), F.col("user"), F.lit("," + USERS_OU)), F.lit("-")).alias("value"))
    enable = c.where(F.col("c_acctbal") > 0).select(_rec(
        F.concat(F.lit("dn: "), _user_dn(k)), F.lit("changeType: Modify"), F.lit("replace: userAccountControl"),
        F.lit("userAccountControl: 512"), F.lit("-")).alias("value"))
    tenth = c.where(k % 10 == 0).select(_rec(
        F.concat(F.lit("dn: "), _user_dn(k)), F.lit("changetype: modify"), F.lit("delete: objectClass"),
        F.lit("objectClass: top"), F.lit("-"), F.lit("add: title"), F.lit("title: keeper"), F.lit("-")).alias("value"))
    return members.unionByName(enable).unionByName(tenth)


def ldif_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ldif_adds(spark, sf_dir).unionByName(ldif_changes(spark, sf_dir))


def landed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the LDIF text, parse it once into a Parquet stage, read that back
    (every directory query reads the parsed records several times)."""
    path = fresh_path(spark, "directory_ldif")
    ldif_records(spark, sf_dir).write.mode("overwrite").text(path)
    return cut_lineage(d.parse_entries(d.read_ldif(spark, path)), name="directory_entries")


USER_DN_SQL = f"'CN=u' || CAST(c.c_custkey AS VARCHAR) || ',{USERS_OU}'"
GROUP_DN_SQL = f"'CN=' || m.grp || ',{GROUPS_OU}'"


def _records_sql() -> str:
    return f"""
WITH m AS ({fx.MEMBERSHIPS_SQL}),
recs AS (
  SELECT {USER_DN_SQL} AS dn, 'add' AS changetype FROM customer c
  UNION ALL SELECT DISTINCT {GROUP_DN_SQL}, 'add' FROM m
  UNION ALL SELECT {GROUP_DN_SQL}, 'modify' FROM m
  UNION ALL SELECT {USER_DN_SQL}, 'modify' FROM customer c WHERE c.c_acctbal > 0
  UNION ALL SELECT {USER_DN_SQL}, 'modify' FROM customer c WHERE c.c_custkey % 10 = 0
)"""


@query("scan_directory_entries", lambda: _records_sql() + " SELECT dn, changetype FROM recs")
def q_scan_directory_entries(spark, sf_dir):
    return landed_entries(spark, sf_dir).select("dn", "changetype")


def _user_attrs_sql(uac: str) -> str:
    return f"""
  SELECT {USER_DN_SQL} AS dn, a.attr, a.value FROM customer c, LATERAL (
    SELECT 'objectclass' AS attr, unnest(['top', 'person', 'user']) AS value
    UNION ALL SELECT 'cn', 'u' || CAST(c.c_custkey AS VARCHAR)
    UNION ALL SELECT 'samaccountname', 'U' || CAST(c.c_custkey AS VARCHAR)
    UNION ALL SELECT 'name', c.c_name
    UNION ALL SELECT 'useraccountcontrol', {uac}
    UNION ALL SELECT 'distinguishedname', {USER_DN_SQL}) a"""


def _group_attrs_sql() -> str:
    return f"""
  SELECT DISTINCT {GROUP_DN_SQL} AS dn, a.attr, a.value FROM m, LATERAL (
    SELECT 'objectclass' AS attr, unnest(['top', 'group']) AS value
    UNION ALL SELECT 'cn', m.grp UNION ALL SELECT 'samaccountname', m.grp
    UNION ALL SELECT 'distinguishedname', {GROUP_DN_SQL}) a"""


@query("parse_directory_entries", lambda: f"""
WITH m AS ({fx.MEMBERSHIPS_SQL})
SELECT dn, 'add' AS changetype, attr, value FROM ({_user_attrs_sql("'514'")} UNION ALL {_group_attrs_sql()})
""")
def q_parse_directory_entries(spark, sf_dir):
    e = landed_entries(spark, sf_dir).where(F.col("changetype") == "add")
    return (e.select("dn", "changetype", F.explode("attributes").alias("attr", "vals"))
            .where(~F.col("attr").isin("dn", "changetype"))
            .select("dn", "changetype", "attr", F.explode("vals").alias("value")))


APPLIED_SQL = lambda: f"""
WITH m AS ({fx.MEMBERSHIPS_SQL}),
applied AS (
  SELECT u.dn, u.attr, u.value FROM ({_user_attrs_sql("CASE WHEN c.c_acctbal > 0 THEN '512' ELSE '514' END")}) u
  WHERE NOT (u.attr = 'objectclass' AND u.value = 'top'
             AND CAST(regexp_extract(u.dn, '^CN=u([0-9]+)', 1) AS BIGINT) % 10 = 0)
  UNION ALL SELECT {USER_DN_SQL}, 'title', 'keeper' FROM customer c WHERE c.c_custkey % 10 = 0
  UNION ALL {_group_attrs_sql()}
  UNION ALL SELECT {GROUP_DN_SQL}, 'member', 'CN=' || m."user" || ',{USERS_OU}' FROM m
)"""


@query("apply_changes", lambda: APPLIED_SQL() + " SELECT DISTINCT dn, attr, value FROM applied")
def q_apply_changes(spark, sf_dir):
    return d.apply_changes(landed_entries(spark, sf_dir))


@query("dn_attribute", lambda: f"""
WITH m AS ({fx.MEMBERSHIPS_SQL})
SELECT DISTINCT dn, regexp_extract(dn, '^CN=([^,]+)', 1) AS rdn, lower(dn) LIKE lower('%{USERS_OU}') AS in_users_ou
FROM (SELECT {USER_DN_SQL} AS dn FROM customer c UNION ALL SELECT {GROUP_DN_SQL} FROM m)
""")
def q_dn_attribute(spark, sf_dir):
    e = landed_entries(spark, sf_dir).where(F.col("changetype") == "add")
    return e.select("dn", d.dn_first_rdn(F.col("dn")).alias("rdn"),
                    d.under_base(F.col("dn"), USERS_OU).alias("in_users_ou")).distinct()


def _applied_users(spark, sf_dir):
    return d.apply_changes(landed_entries(spark, sf_dir))


@query("enabled_accounts", "SELECT 'u' || CAST(c_custkey AS VARCHAR) AS \"user\" FROM customer WHERE c_acctbal > 0")
def q_enabled_accounts(spark, sf_dir):
    a = _applied_users(spark, sf_dir)
    uac = a.where(F.col("attr") == "useraccountcontrol").select("dn", F.col("value").cast("int").alias("uac"))
    sam = a.where(F.col("attr") == "samaccountname").select("dn", F.lower("value").alias("user"))
    # 512 = normal account; bit 2 set = disabled.
    return uac.where((F.col("uac").bitwiseAND(2) == 0) & (F.col("uac").bitwiseAND(512) == 512)) \
        .join(sam, "dn").select("user")


@query("user_lowercase", """
SELECT 'u' || CAST(e.user_id AS VARCHAR) AS "user", count(*) AS n_events
FROM events e JOIN customer c ON c.c_custkey = e.user_id GROUP BY e.user_id
""")
def q_user_lowercase(spark, sf_dir):
    a = _applied_users(spark, sf_dir)
    sam = a.where(F.col("attr") == "samaccountname").select(F.lower("value").alias("user")).distinct()
    ev = scan_parquet(spark, sf_dir, "events").select(F.lower(fx.user_name(F.col("user_id"))).alias("user"))
    # counted before the join: a user who makes most of the events is one row of it
    return ev.groupBy("user").agg(F.count(F.lit(1)).alias("n_events")).join(sam, "user").select("user", "n_events")


@query("filter_object_class", lambda: f"""
WITH m AS ({fx.MEMBERSHIPS_SQL}) SELECT DISTINCT {GROUP_DN_SQL} AS dn, m.grp AS sam FROM m
""")
def q_filter_object_class(spark, sf_dir):
    e = landed_entries(spark, sf_dir)
    return (e.where(F.array_contains(F.col("attributes")["objectclass"], "group")
                    & F.col("attributes")["samaccountname"].isNotNull())
            .select("dn", F.col("attributes")["samaccountname"][0].alias("sam")).distinct())


def group_members(applied: DataFrame) -> DataFrame:
    """JN-02: member DN -> the user entry with that distinguishedName."""
    members = applied.where(F.col("attr") == "member").select(F.col("dn").alias("gdn"), F.col("value").alias("mdn"))
    groups = applied.where(F.col("attr") == "cn").select(F.col("dn").alias("gdn"), F.col("value").alias("grp"))
    users = (applied.where(F.col("attr") == "distinguishedname").select(F.col("dn").alias("udn"), F.col("value").alias("mdn"))
             .join(applied.where(F.col("attr") == "samaccountname")
                   .select(F.col("dn").alias("udn"), F.lower("value").alias("user")), "udn"))
    # Every member row of a big group carries the same group DN: the group
    # side (one row per group) is joined skew-safe; the user side is keyed by
    # the member DN, which is spread.
    return skew_safe_join(members, groups, ["gdn"]).join(users, "mdn").select("grp", "user")


@query("resolve_group_members", lambda: f"SELECT grp, \"user\" FROM ({fx.MEMBERSHIPS_SQL})")
def q_resolve_group_members(spark, sf_dir):
    return group_members(_applied_users(spark, sf_dir))


@query("members_per_group", lambda: f"SELECT grp, count(*) AS n_members FROM ({fx.MEMBERSHIPS_SQL}) GROUP BY grp")
def q_members_per_group(spark, sf_dir):
    return group_members(_applied_users(spark, sf_dir)).groupBy("grp").agg(F.count(F.lit(1)).alias("n_members"))
