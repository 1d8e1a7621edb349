"""Policy tables: read, normalize, implied grants, macros, roles."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators import access
from wardlake.operators import policies as pol
from wardlake.operators.joins import attach_each, sized_join
from wardlake.operators.matching import match_index, pattern_rows
from wardlake.plans import fixtures as fx
from wardlake.plans.policy_sql import policies_cte
from wardlake.plans.registry import query
from wardlake.session import cut_lineage, fresh_path
from wardlake.sources.tables import scan_parquet


def authored_v2(spark: SparkSession) -> DataFrame:
    return pol.read_export(spark, fx.POLICY_FILES, multi_line=True)


def derived_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pol.order_policies(scan_parquet(spark, sf_dir, "orders"))


def legacy(spark: SparkSession) -> DataFrame:
    return pol.read_legacy(spark, fx.LEGACY_FILE)


def servicedefs(spark: SparkSession) -> DataFrame:
    return pol.read_servicedefs(spark, fx.SERVICEDEF_FILE)


def _authored_and(spark: SparkSession, sf_dir: str, derived: bool) -> DataFrame:
    v2 = authored_v2(spark)
    return v2.unionByName(derived_v2(spark, sf_dir)) if derived else v2


def all_items(spark: SparkSession, sf_dir: str, derived: bool = True) -> DataFrame:
    return pol.v2_items(_authored_and(spark, sf_dir, derived)).unionByName(pol.legacy_items(legacy(spark)))


def all_resources(spark: SparkSession, sf_dir: str, derived: bool = True) -> DataFrame:
    return pol.v2_resources(_authored_and(spark, sf_dir, derived)).unionByName(pol.legacy_resources(legacy(spark)))


def expanded_items(spark: SparkSession, sf_dir: str, derived: bool = True) -> DataFrame:
    return pol.expand_implied(all_items(spark, sf_dir, derived), pol.implied_grants(servicedefs(spark)))


# The service whose policies are derived from the data (one per order).
DERIVED_SERVICE = "objectstore"
_SCHEMAS: dict = {}
_SNAPSHOTS: dict[tuple, str] = {}
_BOUNDS: dict[tuple, dict[str, int]] = {}


def _snapshot_key(spark: SparkSession, sf_dir: str, service: str) -> tuple:
    """A snapshot holds for these versions of the policy files (names, sizes, times)."""
    files = tuple((f, os.stat(f).st_size, os.stat(f).st_mtime_ns) for f in [*fx.POLICY_FILES, fx.LEGACY_FILE, fx.SERVICEDEF_FILE])
    return files, spark.sparkContext.applicationId, sf_dir, service.rsplit(":", 1)[-1] == DERIVED_SERVICE


def policy_snapshot(spark: SparkSession, sf_dir: str, service: str = DERIVED_SERVICE,
                    names: tuple = ("items_x", "resources", "level_opts")) -> dict[str, DataFrame]:
    """Normalized policy tables, each written once per application and scale dir, when first asked for.

    Normalizing is a batch job whose output every decision reads; landing
    it as Parquet in the shared folder cuts the lineage (nothing is
    recomputed if an executor is lost later) and makes size checks on it a
    cheap metadata count. The policies derived from the orders are part of it
    only for the service that they belong to. ``long_lists`` and ``index`` are what decisions read: the lists of
    principals that are too long for a row, and one row per policy.
    """
    key = _snapshot_key(spark, sf_dir, service)
    base = _SNAPSHOTS.setdefault(key, fresh_path(spark, "policy_snapshot"))
    bounds = _BOUNDS.setdefault(key, {})

    def table(name: str) -> DataFrame:
        made = f"table:{name}"
        if made not in bounds:
            # Partitioned by service: a decision for one service reads only its
            # own policies (partition pruning), however large the others grow.
            df = build[name]()
            _SCHEMAS[f"{base}/{name}"] = df.schema
            writer = df.write
            (writer if name == "level_opts" else writer.partitionBy("service")).parquet(f"{base}/{name}")
            bounds[made] = 1
            if name in prefixes:
                # Rows per service, recorded once: any subset of a service is bounded by it, so later broadcast
                # checks need no job.
                counts = read(name).groupBy("service").count().collect()
                bounds.update({prefixes[name] + r["service"]: r["count"] for r in counts})
        return read(name)

    def read(name: str) -> DataFrame:
        return spark.read.schema(_SCHEMAS[f"{base}/{name}"]).parquet(f"{base}/{name}")

    build = {
        "items_x": lambda: expanded_items(spark, sf_dir, key[-1]),
        "resources": lambda: all_resources(spark, sf_dir, key[-1]),
        "level_opts": lambda: pol.ignore_case_levels(servicedefs(spark)),
        "long_lists": lambda: access.long_lists(expanded_items(spark, sf_dir, key[-1])),
        "index": lambda: access.policy_index(
            expanded_items(spark, sf_dir, key[-1]), all_resources(spark, sf_dir, key[-1]),
            pol.ignore_case_levels(servicedefs(spark)), table("long_lists")),
    }
    prefixes = {"items_x": "items:", "resources": "", "long_lists": "long:", "index": "index:"}
    return {name: table(name) for name in names}


def resource_bound(spark: SparkSession, sf_dir: str, service: str) -> int | None:
    """Row count of the service's policy resources (with ``items:`` before the name, of its policy items, with ``long:``,
    of its long lists of principals, with ``index:`` of its policies) recorded with the snapshot; None, which leaves the size checks on, for a service
    without any."""
    kind, _, name = service.rpartition(":")
    policy_snapshot(spark, sf_dir, name, ({"": "resources", "items": "items_x", "long": "long_lists", "index": "index"}[kind],))
    return _BOUNDS[_snapshot_key(spark, sf_dir, service)].get(service)


def service_index(spark: SparkSession, sf_dir: str, service: str) -> dict:
    """What ``access.decide_by_index`` needs of a service: index, long_items, bound."""
    mine, long = F.col("service") == service, None
    index = policy_snapshot(spark, sf_dir, service, ("index",))["index"].where(mine)
    if resource_bound(spark, sf_dir, "long:" + service):
        snap = policy_snapshot(spark, sf_dir, service, ("items_x", "long_lists"))
        long = access.long_items_of(snap["items_x"].where(mine), snap["long_lists"].where(mine))
    return {"index": index, "long_items": long, "bound": resource_bound(spark, sf_dir, "index:" + service)}


def with_cte(body: str) -> str:
    return f"WITH {policies_cte()}\n{body}"


@query("scan_policies", lambda: with_cte("""
SELECT p.id AS policy_id, p.service, p.policyType AS policy_type, p.isEnabled AS is_enabled,
       CAST(len(p.policyItems) AS INTEGER) AS n_allow, CAST(len(p.denyPolicyItems) AS INTEGER) AS n_deny
FROM (SELECT p FROM pol_all UNION ALL
      SELECT {'id': p.id, 'service': p.service, 'policyType': p.policyType, 'isEnabled': p.isEnabled,
              'policyItems': p.policyItems, 'denyPolicyItems': p.denyPolicyItems} FROM pol_orders)
"""))
def q_scan_policies(spark, sf_dir):
    # The store is landed as JSON Lines, one export document per line (a
    # splittable layout), then read back with the declared schema.
    path = fresh_path(spark, "policy_store")
    docs = authored_v2(spark).unionByName(derived_v2(spark, sf_dir))
    # At most 1000 policies per document: the group size is bounded, whatever
    # the store size.
    (docs.withColumn("_b", F.expr("id div 1000"))
         .groupBy("_b").agg(F.collect_list(F.struct(*[c for c in docs.columns])).alias("policies"))
         .select("policies").write.mode("overwrite").json(path))
    back = pol.read_export(spark, path, multi_line=False)
    return back.select(F.col("id").alias("policy_id"), "service", F.col("policyType").alias("policy_type"),
                       F.col("isEnabled").alias("is_enabled"), F.size("policyItems").alias("n_allow"),
                       F.size("denyPolicyItems").alias("n_deny"))


@query("normalize_policies", lambda: with_cte("SELECT * FROM items"))
def q_normalize_policies(spark, sf_dir):
    return all_items(spark, sf_dir)


@query("policy_resources", lambda: with_cte("SELECT * FROM resources"))
def q_policy_resources(spark, sf_dir):
    return all_resources(spark, sf_dir)


@query("expand_implied_grants", lambda: with_cte("SELECT * FROM items_x"))
def q_expand_implied(spark, sf_dir):
    return expanded_items(spark, sf_dir)


@query("delegate_admin", lambda: with_cte("""
SELECT DISTINCT policy_id, service, principal_kind, principal FROM items
WHERE delegate_admin AND item_kind = 'allow' AND is_enabled
"""))
def q_delegate_admin(spark, sf_dir):
    return pol.delegate_admins(all_items(spark, sf_dir))


# --- GOV-06: {USER} in path patterns and user lists ----------------------

def expand_user_macro(resources: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """(policy_id, user, path, access) for every macro policy and directory user.

    Macro rows are few (policy count), users many: the macro side is
    broadcast after a count check by the caller; the users side streams.
    """
    macro_res = resources.where(F.col("pattern").contains("{USER}")).select("policy_id", "pattern")
    macro_items = (items.where((F.col("principal") == "{USER}") & (F.col("item_kind") == "allow"))
                   .select("policy_id", "access"))
    m = macro_res.join(macro_items, "policy_id")
    return (attach_each(users, m)
            .select("policy_id", "user", F.replace("pattern", F.lit("{USER}"), F.col("user")).alias("path"),
                    "access"))


@query("expand_user_macro", lambda: with_cte(f"""
SELECT r.policy_id, u."user", replace(r.pattern, '{{USER}}', u."user") AS path, i.access
FROM (SELECT DISTINCT "user" FROM ({fx.MEMBERSHIPS_SQL})) u,
     (SELECT policy_id, pattern FROM resources WHERE contains(pattern, '{{USER}}')) r
JOIN (SELECT policy_id, access FROM items WHERE principal = '{{USER}}' AND item_kind = 'allow') i
  ON r.policy_id = i.policy_id
"""))
def q_expand_user_macro(spark, sf_dir):
    users = fx.memberships(spark, sf_dir).select("user").distinct()
    return expand_user_macro(all_resources(spark, sf_dir), legacy_items_only(spark), users)


def legacy_items_only(spark):
    return pol.legacy_items(legacy(spark))


# --- JN-03 group -> role, GOV-21 role grants ------------------------------

# Static role -> (action glob, resource) grants.
ROLE_GRANTS = [
    ("AnalystRole", "s3:List*", "*"), ("AnalystRole", "s3:GetBucketLocation", "*"),
    ("AnalystRole", "s3:Get*", "arn:aws:s3:::lake/orders/*"),
    ("EngineerRole", "s3:List*", "*"), ("EngineerRole", "s3:GetBucketLocation", "*"),
    ("EngineerRole", "s3:*", "arn:aws:s3:::lake/*"),
    ("ScientistRole", "s3:Get*", "arn:aws:s3:::lake/web/*"),
]


def resolve_group_role(members: DataFrame, role_map: DataFrame) -> DataFrame:
    """(user, grp, role): role NULL for groups that map to no role.

    The role mapping is a short document (broadcast); memberships stream.
    """
    roles = role_map.select(F.col("Role").alias("role"), F.explode("Identifiers").alias("grp"))
    return members.join(F.broadcast(roles), "grp", "left").select("user", "grp", "role")


@query("resolve_group_role", lambda: f"""
SELECT m."user", m.grp, r.role FROM ({fx.MEMBERSHIPS_SQL}) m
LEFT JOIN {fx.role_members_sql().replace(' AS t(', ' AS r(')} ON m.grp = r.grp
""")
def q_resolve_group_role(spark, sf_dir):
    return resolve_group_role(fx.memberships(spark, sf_dir), fx.role_map_df(spark))


@query("role_grants", lambda: f"""
SELECT DISTINCT m."user", r.role, g.action, g.resource
FROM ({fx.MEMBERSHIPS_SQL}) m
JOIN {fx.role_members_sql().replace(' AS t(', ' AS r(')} ON m.grp = r.grp
JOIN {fx.values_sql(ROLE_GRANTS, ['role', 'action', 'resource']).replace(' AS t(', ' AS g(')} ON g.role = r.role
""")
def q_role_grants(spark, sf_dir):
    ur = resolve_group_role(fx.memberships(spark, sf_dir), fx.role_map_df(spark)).where("role IS NOT NULL")
    grants = spark.createDataFrame(ROLE_GRANTS, "role string, action string, resource string")
    return ur.join(F.broadcast(grants), "role").select("user", "role", "action", "resource").distinct()


def role_access(reqs: DataFrame, user_roles: DataFrame, statements: DataFrame) -> DataFrame:
    """GOV-21 decided: ``reqs`` (request_id, user, action, resource) + roles (that allow it, sorted) and allowed.

    A statement (role, action glob, resource glob) is a policy of two levels, so distinct (action, resource) find the
    statements through the index of literal prefixes; the roles that allow them are one list per pair, compared in the
    row with the list of roles of the user.
    """
    pats = statements.withColumn("policy_id", F.xxhash64("role", "action", "resource"))
    rows = pats.select("policy_id", "role", F.explode(F.array(
        F.struct(F.lit("action").alias("level"), F.col("action").alias("pattern")),
        F.struct(F.lit("resource").alias("level"), F.col("resource").alias("pattern")))).alias("l"))
    index = pattern_rows(rows.select("policy_id", "role", "l.*", F.lit("roles").alias("service"), F.lit(False).alias("excludes"),
                                     F.lit(False).alias("recursive")), None)
    index = index.groupBy("policy_id", "role").agg(F.collect_set("r").alias("res"))
    asked = cut_lineage(reqs.select("action", "resource").distinct(), name="actions")
    found = match_index(asked, {"action": "action", "resource": "resource"}, index)
    by_pair = cut_lineage(found.groupBy("action", "resource").agg(F.collect_set("role").alias("can")), name="action_roles")
    mine = user_roles.where("role IS NOT NULL").groupBy("user").agg(F.collect_set("role").alias("has"))
    full = sized_join(sized_join(reqs, by_pair, ["action", "resource"], None, "left"), mine, ["user"], None, "left")
    roles = F.array_sort(F.coalesce(F.array_intersect("can", "has"), F.array().cast("array<string>")))
    return full.select("request_id", "user", "action", "resource", F.array_join(roles, ",").alias("roles"),
                       (F.size(roles) > 0).alias("allowed"))


# The storage call that an event of a type stands for.
CALL_OF_EVENT = [("view", "s3:GetObject"), ("click", "s3:ListBucket"), ("purchase", "s3:PutObject"),
                 ("signup", "s3:GetBucketLocation"), ("error", "s3:DeleteObject")]


@query("role_access", lambda: f"""
WITH reqs AS (
  SELECT e.event_id AS request_id, 'u' || CAST(e.user_id AS VARCHAR) AS "user", c.action,
         'arn:aws:s3:::lake/' || CASE WHEN e.event_id % 2 = 0 THEN 'orders/' ELSE 'web/' END || CAST(e.event_id % 97 AS VARCHAR) AS resource
  FROM events e JOIN {fx.values_sql(CALL_OF_EVENT, ['event_type', 'action']).replace(' AS t(', ' AS c(')} USING (event_type)),
can AS (
  SELECT DISTINCT r.request_id, g.role FROM reqs r
  JOIN ({fx.MEMBERSHIPS_SQL}) m ON m."user" = r."user"
  JOIN {fx.role_members_sql().replace(' AS t(', ' AS x(')} ON m.grp = x.grp
  JOIN {fx.values_sql(ROLE_GRANTS, ['role', 'action', 'resource']).replace(' AS t(', ' AS g(')}
    ON g.role = x.role AND r.action GLOB g.action AND r.resource GLOB g.resource)
SELECT r.*, coalesce(c.roles, '') AS roles, c.roles IS NOT NULL AS allowed
FROM reqs r LEFT JOIN (SELECT request_id, string_agg(role, ',' ORDER BY role) AS roles FROM can GROUP BY 1) c USING (request_id)
""")
def q_role_access(spark, sf_dir):
    calls = F.create_map(*[F.lit(x) for pair in CALL_OF_EVENT for x in pair])
    area = F.when(F.col("event_id") % 2 == 0, "orders/").otherwise("web/")
    reqs = scan_parquet(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), fx.user_name(F.col("user_id")).alias("user"),
        calls[F.col("event_type")].alias("action"),
        F.concat(F.lit("arn:aws:s3:::lake/"), area, (F.col("event_id") % 97).cast("string")).alias("resource")).where("action IS NOT NULL")
    return role_access(reqs, resolve_group_role(fx.memberships(spark, sf_dir), fx.role_map_df(spark)),
                       spark.createDataFrame(ROLE_GRANTS, "role string, action string, resource string"))
