"""Authored dimensions and the rules that derive requests/principals from data.

Everything here is either a short fixed table (stated once, as text) or a
Spark derivation from the driver's tables, so the work of every query grows
with ``events``, ``customer``, ``orders`` and ``pages``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.sources.tables import scan_parquet

DATA_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "data")
POLICY_FILE = os.path.join(DATA_DIR, "lakehouse_policies.json")
TAG_POLICY_FILE = os.path.join(DATA_DIR, "tag_policies.json")
PREV_POLICY_FILE = os.path.join(DATA_DIR, "lakehouse_policies_prev.json")
CATALOG_POLICY_FILE = os.path.join(DATA_DIR, "catalog_policies.json")
TAGSET_FILE = os.path.join(DATA_DIR, "tagsets.jsonl")
# The authored policy exports read together as the current store.
POLICY_FILES = [POLICY_FILE, TAG_POLICY_FILE, CATALOG_POLICY_FILE]
LEGACY_FILE = os.path.join(DATA_DIR, "legacy_policies.jsonl")
SERVICEDEF_FILE = os.path.join(DATA_DIR, "servicedefs.jsonl")

# ---------------------------------------------------------------------------
# Fixed values (authored for the driver's tables).
# ---------------------------------------------------------------------------

# Resource catalog: (res_idx, database, table, column). A request made from
# event e addresses resource number e.event_id % 43.
RESOURCES = [
    (0, "tpch", "customer", "c_custkey"), (1, "tpch", "customer", "c_name"),
    (2, "tpch", "customer", "c_nationkey"), (3, "tpch", "customer", "c_acctbal"),
    (4, "tpch", "customer", "c_mktsegment"),
    (5, "tpch", "orders", "o_orderkey"), (6, "tpch", "orders", "o_custkey"),
    (7, "tpch", "orders", "o_orderstatus"), (8, "tpch", "orders", "o_totalprice"),
    (9, "tpch", "orders", "o_orderdate"), (10, "tpch", "orders", "o_orderpriority"),
    (11, "tpch", "lineitem", "l_orderkey"), (12, "tpch", "lineitem", "l_partkey"),
    (13, "tpch", "lineitem", "l_suppkey"), (14, "tpch", "lineitem", "l_quantity"),
    (15, "tpch", "lineitem", "l_extendedprice"), (16, "tpch", "lineitem", "l_discount"),
    (17, "tpch", "lineitem", "l_shipdate"),
    (18, "tpch", "part", "p_partkey"), (19, "tpch", "part", "p_name"), (20, "tpch", "part", "p_brand"),
    (21, "tpch", "part", "p_type"), (22, "tpch", "part", "p_retailprice"),
    (23, "tpch", "supplier", "s_suppkey"), (24, "tpch", "supplier", "s_name"),
    (25, "tpch", "supplier", "s_acctbal"),
    (26, "tpch", "nation", "n_nationkey"), (27, "tpch", "nation", "n_name"),
    (28, "tpch", "region", "r_regionkey"), (29, "tpch", "region", "r_name"),
    (30, "web", "events", "event_id"), (31, "web", "events", "ts"), (32, "web", "events", "user_id"),
    (33, "web", "events", "event_type"), (34, "web", "events", "value"), (35, "web", "events", "props"),
    (36, "web", "documents", "doc_id"), (37, "web", "documents", "text"),
    (38, "web", "documents", "lang"), (39, "web", "documents", "source"),
    (40, "web", "pages", "page_id"), (41, "web", "pages", "url"), (42, "web", "pages", "html"),
]
N_RESOURCES = len(RESOURCES)

# Event type -> requested access type.
ACCESS_OF_EVENT = [
    ("view", "select"), ("click", "update"), ("purchase", "create"),
    ("signup", "alter"), ("error", "drop"),
]

# Group -> role (the role mapping document: Role, IdentifierType=Group, Identifiers).
ROLE_MAPPINGS = [
    ("AnalystRole", "Group", ["building", "furniture"]),
    ("EngineerRole", "Group", ["machinery"]),
    ("ScientistRole", "Group", ["household", "europe"]),
    ("AdminRole", "Group", ["admins"]),
]

# Users that bypass path checks (s3.authorization.skip.users).
SKIP_USERS = ["u0", "hadoop"]

# Catalogs whose metadata is asked for, and the information_schema tables shown to metadata requests.
CATALOGS = ["lake", "warehouse", "scratch"]
INFO_SCHEMA_TABLES = [("information_schema", "tables", "table_name"),
                      ("information_schema", "columns", "column_name"),
                      ("information_schema", "schemata", "schema_name")]


def values_sql(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(lit(x) for x in v) + "]"
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def resources_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RESOURCES, "res_idx int, db string, tbl string, col string")


def access_map_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ACCESS_OF_EVENT, "event_type string, access string")


def role_map_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROLE_MAPPINGS, "Role string, IdentifierType string, Identifiers array<string>")


# ---------------------------------------------------------------------------
# Derivations from the driver's tables.
# ---------------------------------------------------------------------------

def user_name(col):
    return F.concat(F.lit("u"), col.cast("string"))


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, grp): every customer is a user in its segment and region groups."""
    c = scan_parquet(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = scan_parquet(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = scan_parquet(spark, sf_dir, "region").select("r_regionkey", "r_name")
    cr = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
          .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))
    return cr.select(
        user_name(F.col("c_custkey")).alias("user"),
        F.explode(F.array(F.lower("c_mktsegment"),
                          F.lower(F.regexp_replace("r_name", " ", "_")))).alias("grp"),
    )


MEMBERSHIPS_SQL = """
SELECT 'u' || CAST(c.c_custkey AS VARCHAR) AS "user", g.grp
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey,
LATERAL (SELECT unnest([lower(c.c_mktsegment), lower(replace(r.r_name, ' ', '_'))]) AS grp) g
"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access requests from events: (request_id, ts, user, access, db, tbl, col)."""
    e = scan_parquet(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    # Both lookups are fixed-size (43 and 5 rows): broadcast is bounded.
    return (
        e.withColumn("res_idx", F.pmod(F.col("event_id"), F.lit(N_RESOURCES)).cast("int"))
        .join(F.broadcast(resources_df(spark)), "res_idx")
        .join(F.broadcast(access_map_df(spark)), "event_type")
        .select(F.col("event_id").alias("request_id"), "ts", user_name(F.col("user_id")).alias("user"),
                "access", "db", "tbl", "col")
    )


def requests_sql() -> str:
    return f"""
SELECT e.event_id AS request_id, e.ts, 'u' || CAST(e.user_id AS VARCHAR) AS "user",
       am.access, rc.db, rc.tbl, rc.col
FROM events e
JOIN {values_sql(RESOURCES, ['res_idx', 'db', 'tbl', 'col']).replace(' AS t(', ' AS rc(')}
  ON rc.res_idx = e.event_id % {N_RESOURCES}
JOIN {values_sql(ACCESS_OF_EVENT, ['event_type', 'access']).replace(' AS t(', ' AS am(')}
  ON am.event_type = e.event_type
"""


def role_members_sql() -> str:
    rows = [(role, g) for role, _, ids in ROLE_MAPPINGS for g in ids]
    return values_sql(rows, ["role", "grp"])
