"""Access decisions over requests derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators import access
from wardlake.operators.joins import attach_each
from wardlake.operators.matching import match_resources, pattern_hits
from wardlake.plans import fixtures as fx
from wardlake.plans.access_sql import decide_sql, principals_sql
from wardlake.plans.policy_plans import policy_snapshot, resource_bound, service_index, with_cte
from wardlake.plans.registry import query
from wardlake.session import cut_lineage
from wardlake.sources.tables import scan_parquet

LAKE = {"database": "db", "table": "tbl", "column": "col"}
KEY = ["user", "access", "db", "tbl", "col"]
RES = ["db", "tbl", "col"]


def role_members_df(spark: SparkSession) -> DataFrame:
    return fx.role_map_df(spark).select(F.col("Role").alias("role"), F.explode("Identifiers").alias("grp"))


def lake_inputs(spark: SparkSession, sf_dir: str):
    snap = policy_snapshot(spark, sf_dir, "lakehouse")
    items = snap["items_x"].where(F.col("service") == "lakehouse")
    res = snap["resources"].where(F.col("service") == "lakehouse")
    return items, res, snap["level_opts"]


def principals_of(spark: SparkSession, sf_dir: str, users: DataFrame) -> DataFrame:
    return access.user_tags(users.select("user"), fx.memberships(spark, sf_dir), role_members_df(spark))


def decide_keys(spark: SparkSession, sf_dir: str, keys: DataFrame, key_cols=KEY, levels=LAKE, stage: bool = True) -> DataFrame:
    """Decisions of distinct keys of the lakehouse service; the keys are read three times, so they are written first."""
    staged = cut_lineage(keys.select(*key_cols), name="keys") if stage else keys
    return access.decide_by_index(staged, key_cols, levels, who=principals_of(spark, sf_dir, staged), stage=stage,
                                  **service_index(spark, sf_dir, "lakehouse"))


def request_keys(spark, sf_dir):
    reqs = fx.requests(spark, sf_dir)
    return reqs, reqs.select(*KEY).distinct()


def _decided_requests(spark, sf_dir):
    reqs, keys = request_keys(spark, sf_dir)
    dec = decide_keys(spark, sf_dir, keys)
    return access.decide_requests(reqs, KEY, dec)


def cte(body: str, keys_cte: str = "reqs", keys_sql: str | None = None) -> str:
    keys_sql = keys_sql or fx.requests_sql()
    return with_cte(f""",
{keys_cte} AS ({keys_sql}),
{principals_sql(keys_cte)},
{decide_sql(keys_cte)}
{body}""")


@query("decide_access", lambda: cte("""
SELECT r.request_id, r."user", r.access, r.db, r.tbl, r.col, d.decision, d.allowed, d.policy_id
FROM reqs r JOIN decisions_x d USING ("user", access, db, tbl, col)
"""))
def q_decide_access(spark, sf_dir):
    return _decided_requests(spark, sf_dir).select(
        "request_id", "user", "access", "db", "tbl", "col", "decision", "allowed", "policy_id")


def _matched(spark, sf_dir):
    """(keys, resources of live policies, options, bound); the keys are written: the requests are scanned once."""
    _, keys = request_keys(spark, sf_dir)
    items, res, opts = lake_inputs(spark, sf_dir)
    live = res.join(access_heads(items).select("policy_id"), "policy_id", "left_semi")
    return cut_lineage(keys.select(*RES).distinct(), name="resources"), live, opts, resource_bound(spark, sf_dir, "lakehouse")


def access_heads(items: DataFrame) -> DataFrame:
    return items.where((F.col("policy_type") == 0) & F.col("is_enabled")).select("policy_id").distinct()


def _resource_policies(spark, sf_dir):
    res_keys, res, opts, bound = _matched(spark, sf_dir)
    return res_keys, match_resources(res_keys, RES, LAKE, res, opts, "lakehouse", bound)


@query("resource_policy_join", lambda: cte("SELECT db, tbl, col, policy_id FROM matched"))
def q_resource_policy_join(spark, sf_dir):
    return _resource_policies(spark, sf_dir)[1]


@query("match_resource", lambda: cte("SELECT db, tbl, col, policy_id, level FROM lvl WHERE hit AND NOT ex"))
def q_match_resource(spark, sf_dir):
    res_keys, res, opts, bound = _matched(spark, sf_dir)
    hits = pattern_hits(res_keys, RES, LAKE, res, opts, "lakehouse", bound)
    return hits.where(~F.col("excludes")).drop("excludes")


@query("match_excludes", lambda: cte("SELECT DISTINCT db, tbl, col, policy_id FROM lvl WHERE ex AND hit"))
def q_match_excludes(spark, sf_dir):
    res_keys, res, opts, bound = _matched(spark, sf_dir)
    hits = pattern_hits(res_keys, RES, LAKE, res.where("excludes"), opts, "lakehouse", bound)
    return hits.select(*RES, "policy_id").distinct()


@query("unprotected_resources", lambda: cte(
    "SELECT * FROM res_keys k WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.db = k.db AND m.tbl = k.tbl AND m.col = k.col)"))
def q_unprotected(spark, sf_dir):
    res_keys, matched = _resource_policies(spark, sf_dir)
    return res_keys.join(matched, RES, "left_anti")


@query("covered_resources", lambda: cte(
    "SELECT * FROM res_keys k WHERE EXISTS (SELECT 1 FROM matched m WHERE m.db = k.db AND m.tbl = k.tbl AND m.col = k.col)"))
def q_covered(spark, sf_dir):
    res_keys, matched = _resource_policies(spark, sf_dir)
    return res_keys.join(matched, RES, "left_semi")


@query("match_principal", lambda: cte("""
SELECT "user", access, db, tbl, col, policy_id, al AS allow, de AS deny,
       ae AS allow_exception, dx AS deny_exception FROM hits
"""))
def q_match_principal(spark, sf_dir):
    _, keys = request_keys(spark, sf_dir)
    staged = cut_lineage(keys, name="keys")
    got = access.judged_keys(staged, KEY, LAKE, who=principals_of(spark, sf_dir, staged),
                             **service_index(spark, sf_dir, "lakehouse"))
    said = got.select(*KEY, F.explode("judged").alias("s"))
    return (said.where("s.allow OR s.deny OR s.allow_exception OR s.deny_exception")
            .select(*KEY, "s.policy_id", *[f"s.{k}" for k in access.ACCESS_KINDS]))


# The base access types of the lakehouse service.
BASE_ACCESSES = ["select", "update", "create", "drop", "alter", "index", "lock"]


def _matrix_keys_sql() -> str:
    res = fx.values_sql([r[1:] for r in fx.RESOURCES], ["db", "tbl", "col"]).replace(" AS t(", " AS rc(")
    acc = fx.values_sql([(a,) for a in BASE_ACCESSES], ["access"]).replace(" AS t(", " AS ac(")
    return (f"SELECT u.\"user\", ac.access, rc.db, rc.tbl, rc.col FROM "
            f"(SELECT DISTINCT 'u' || CAST(user_id AS VARCHAR) AS \"user\" FROM events) u, {res}, {acc}")


@query("effective_permissions", lambda: cte(
    'SELECT "user", db, tbl, col, access FROM decisions WHERE decision = \'ALLOW\'',
    keys_cte="mkeys", keys_sql=_matrix_keys_sql()))
def q_effective_permissions(spark, sf_dir):
    users = scan_parquet(spark, sf_dir, "events").select(fx.user_name(F.col("user_id")).alias("user")).distinct()
    grid = spark.createDataFrame([(r[1], r[2], r[3], a) for r in fx.RESOURCES for a in BASE_ACCESSES],
                                 "db string, tbl string, col string, access string")  # 43 x 7 fixed rows
    return effective_permissions(users, grid, RES, LAKE, principals_of(spark, sf_dir, users),
                                 **service_index(spark, sf_dir, "lakehouse"))


def effective_permissions(users: DataFrame, grid: DataFrame, res_cols: list[str], level_cols: dict[str, str],
                          who: DataFrame, index: DataFrame, long_items: DataFrame | None, bound: int | None) -> DataFrame:
    """(user, <resource>, access) that are allowed, of the ``users`` (distinct) and the cells of ``grid``.

    From the policies outwards: the principals that an allow item names for a cell are resolved to users, and only
    these (user, cell) pairs are decided. A pair that no item allows is never made.
    """
    lists = cut_lineage(access.access_lists(grid, res_cols, level_cols, index, bound), name="access_lists")
    who = cut_lineage(who, name="who")
    tags = who.select("user", F.explode(F.concat("who", F.array(F.lit(access.EVERYBODY)))).alias("tag"))
    named = lists.select(*res_cols, "access", F.explode(F.array_distinct(F.flatten(F.transform(
        "policies", lambda e: e["allow"])))).alias("tag"))
    pairs = tags.join(named.where(F.col("tag").isNotNull()), "tag").select("user", "access", *res_cols)
    if long_items is not None:
        far = (long_items.where(F.col("item_kind") == "allow")
               .withColumn("tag", F.concat_ws(":", "principal_kind", "principal")).join(tags, "tag")
               .select("user", "policy_id", "access").distinct())
        of = lists.select(*res_cols, "access", F.explode("policies").alias("p")).select(*res_cols, "access", "p.policy_id")
        pairs = pairs.unionByName(far.join(of, ["policy_id", "access"]).select("user", "access", *res_cols))
    keys = pairs.distinct()
    full = access.with_principals(keys.join(lists, [*res_cols, "access"]), who, long_items)
    said = access.verdict(access.judge(F.col("policies")))
    return full.where(said["decision"] == "ALLOW").select("user", *res_cols, "access")


CATALOG_LEVELS = {"catalog": "cat", "schema": "db", "table": "tbl", "column": "col"}
INFO_ROWS = [(c, *r) for c in fx.CATALOGS for r in fx.INFO_SCHEMA_TABLES]


def _info_sql() -> str:
    res = fx.values_sql(INFO_ROWS, ["cat", "db", "tbl", "col"]).replace(" AS t(", " AS rc(")
    return with_cte(f""",
ikeys AS (SELECT u."user", 'select' AS access, rc.cat, rc.db, rc.tbl, rc.col FROM
          (SELECT DISTINCT 'u' || CAST(user_id AS VARCHAR) AS "user" FROM events) u, {res}),
{principals_sql('ikeys')},
{decide_sql('ikeys', levels=list(CATALOG_LEVELS.items()), service='federated')}
SELECT "user", cat, db, tbl, col, decision, allowed FROM decisions_x""")


@query("metadata_visibility", _info_sql)
def q_metadata_visibility(spark, sf_dir):
    """GOV-17: who sees the tables that describe a catalog; resources of four levels."""
    users = scan_parquet(spark, sf_dir, "events").select(fx.user_name(F.col("user_id")).alias("user")).distinct()
    info = spark.createDataFrame(INFO_ROWS, "cat string, db string, tbl string, col string").withColumn("access", F.lit("select"))
    kc = ["user", "access", *CATALOG_LEVELS.values()]
    keys = cut_lineage(attach_each(users, info, bound=len(INFO_ROWS)).select(*kc), name="keys")
    dec = access.decide_by_index(keys, kc, CATALOG_LEVELS, who=principals_of(spark, sf_dir, keys),
                                 **service_index(spark, sf_dir, "federated"))
    return dec.select("user", "cat", "db", "tbl", "col", "decision", "allowed")


@query("audit_summary", lambda: cte("""
SELECT r."user", r.db, r.tbl, r.col, r.access, d.decision,
       strftime(date_trunc('hour', r.ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS n_events, strftime(min(r.ts), '%Y-%m-%d %H:%M:%S') AS first_seen,
       strftime(max(r.ts), '%Y-%m-%d %H:%M:%S') AS last_seen
FROM reqs r JOIN decisions_x d USING ("user", access, db, tbl, col)
GROUP BY ALL
"""))
def q_audit_summary(spark, sf_dir):
    from wardlake.operators.audit import audit_summary
    return audit_summary(_decided_requests(spark, sf_dir), "1 hour")


@query("audit_enabled_filter", lambda: cte("""
SELECT r.request_id, r."user", r.access, r.db, r.tbl, r.col, d.decision, d.policy_id
FROM reqs r JOIN decisions_x d USING ("user", access, db, tbl, col) WHERE d.is_audit_enabled
"""))
def q_audit_enabled(spark, sf_dir):
    from wardlake.operators.audit import audit_rows
    return audit_rows(_decided_requests(spark, sf_dir)).select(
        "request_id", "user", "access", "db", "tbl", "col", "decision", "policy_id")


# UDF names a request may call (request i calls UDFS[i % 4]).
UDFS = ["mask_first4", "mask_hash", "geo_lookup", "MASK_LAST4"]


@query("udf_access", lambda: with_cte(f""",
ureqs AS (
  SELECT e.event_id AS request_id, 'u' || CAST(e.user_id AS VARCHAR) AS "user", 'select' AS access,
         'tpch' AS db, u.udf
  FROM events e JOIN {fx.values_sql([(i, n) for i, n in enumerate(UDFS)], ['i', 'udf']).replace(' AS t(', ' AS u(')}
    ON u.i = e.event_id % {len(UDFS)}
),
{principals_sql('ureqs')},
{decide_sql('ureqs', levels=[('database', 'db'), ('udf', 'udf')])}
SELECT r.request_id, r."user", r.udf, d.decision, d.allowed
FROM ureqs r JOIN decisions_x d USING ("user", access, db, udf)
"""))
def q_udf_access(spark, sf_dir):
    e = scan_parquet(spark, sf_dir, "events").select("event_id", "user_id")
    udfs = spark.createDataFrame(list(enumerate(UDFS)), "i int, udf string")
    reqs = (e.withColumn("i", F.pmod("event_id", F.lit(len(UDFS))).cast("int"))
            .join(F.broadcast(udfs), "i")
            .select(F.col("event_id").alias("request_id"), fx.user_name(F.col("user_id")).alias("user"),
                    F.lit("select").alias("access"), F.lit("tpch").alias("db"), "udf"))
    kc = ["user", "access", "db", "udf"]
    dec = decide_keys(spark, sf_dir, reqs.select(*kc).distinct(), key_cols=kc,
                      levels={"database": "db", "udf": "udf"})
    return access.decide_requests(reqs, kc, dec).select("request_id", "user", "udf", "decision", "allowed")
