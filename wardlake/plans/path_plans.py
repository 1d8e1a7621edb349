"""Object-store path requests: prefix joins, recursive paths, superusers, file rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators import access
from wardlake.operators.matching import match_paths
from wardlake.plans import fixtures as fx
from wardlake.plans.access_plans import principals_of
from wardlake.plans.access_sql import decide_matched_sql, principals_sql
from wardlake.plans.policy_plans import policy_snapshot, resource_bound, service_index, with_cte
from wardlake.plans.registry import query
from wardlake.session import cut_lineage
from wardlake.sources.tables import scan_parquet

URL_PATH = r"^[a-zA-Z]+://[^/?#]*([^?#]*)"


def norm_path(c):
    p = F.regexp_extract(c, URL_PATH, 1)
    p = F.when(p == "", F.lit("/")).otherwise(p)
    return F.regexp_replace(p, "(.)/+$", "$1")


def path_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, user, access, path): order lines and web pages as object paths.

    Written once as a Parquet stage: the matcher reads it in three branches
    (ancestors, exact paths, wildcard paths) and the decision once more.
    """
    return cut_lineage(_path_requests(spark, sf_dir), name="path_requests")


def _path_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = scan_parquet(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = scan_parquet(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("request_id"),
        F.when(F.col("l_linenumber") % 2 == 1, fx.user_name(F.col("o_custkey")))
        .otherwise(fx.user_name(F.col("l_suppkey"))).alias("user"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("write")).otherwise(F.lit("read")).alias("access"),
        F.concat(F.lit("/orders/"), F.year("o_orderdate").cast("string"), F.lit("/"),
                 F.col("o_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string")).alias("path"))
    pages = scan_parquet(spark, sf_dir, "pages").select(
        F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("request_id"),
        fx.user_name(F.pmod("page_id", F.lit(150))).alias("user"), F.lit("read").alias("access"),
        norm_path(F.col("url")).alias("path"))
    # Home folders: the owner reads one, the next user tries to, the owner writes another.
    c = scan_parquet(spark, sf_dir, "customer").select("c_custkey")
    own = fx.user_name(F.col("c_custkey"))
    home, other = F.concat(F.lit("/user/"), own, F.lit("/notes")), F.concat(F.lit("/tmp/"), own)
    homes = c.select(F.col("c_custkey").cast("string").alias("n"), F.explode(F.array(
        F.struct(F.lit("H").alias("k"), own.alias("user"), F.lit("read").alias("access"), home.alias("path")),
        F.struct(F.lit("N").alias("k"), fx.user_name(F.col("c_custkey") + 1).alias("user"), F.lit("read").alias("access"),
                 home.alias("path")),
        F.struct(F.lit("T").alias("k"), own.alias("user"), F.lit("write").alias("access"), other.alias("path")))).alias("r"))
    homes = homes.select(F.concat("r.k", "n").alias("request_id"), "r.user", "r.access", "r.path")
    return lines.unionByName(pages).unionByName(homes)


PATH_REQS_SQL = f"""
SELECT 'L' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS request_id,
       CASE WHEN l.l_linenumber % 2 = 1 THEN 'u' || CAST(o.o_custkey AS VARCHAR)
            ELSE 'u' || CAST(l.l_suppkey AS VARCHAR) END AS "user",
       CASE WHEN l.l_linenumber % 3 = 0 THEN 'write' ELSE 'read' END AS access,
       '/orders/' || CAST(year(o.o_orderdate) AS VARCHAR) || '/' || CAST(o.o_orderkey AS VARCHAR) || '/'
         || CAST(l.l_linenumber AS VARCHAR) AS path
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
UNION ALL
SELECT 'P' || CAST(page_id AS VARCHAR), 'u' || CAST(page_id % 150 AS VARCHAR), 'read',
       regexp_replace(CASE WHEN regexp_extract(url, '{URL_PATH}', 1) = '' THEN '/'
                           ELSE regexp_extract(url, '{URL_PATH}', 1) END, '(.)/+$', '\\1')
FROM pages
UNION ALL
SELECT k || CAST(c_custkey AS VARCHAR), 'u' || CAST(c_custkey + other AS VARCHAR), access, root || 'u' || CAST(c_custkey AS VARCHAR) || leaf
FROM customer, (VALUES ('H', 0, 'read', '/user/', '/notes'), ('N', 1, 'read', '/user/', '/notes'),
                       ('T', 0, 'write', '/tmp/', '')) AS v(k, other, access, root, leaf)
"""


def _path_cte(body: str, enabled_only: bool) -> str:
    en = "AND policy_id IN (SELECT policy_id FROM items WHERE is_enabled)" if enabled_only else ""
    return with_cte(f""",
preqs AS ({PATH_REQS_SQL}),
ppol AS (SELECT DISTINCT policy_id, regexp_replace(pattern, '(.)/+$', '\\1') AS pattern, recursive, excludes
         FROM resources WHERE service = 'objectstore' AND level = 'path' {en}),
umac AS (SELECT DISTINCT p.*, r."user", replace(p.pattern, '{{USER}}', r."user") AS own
         FROM ppol p, (SELECT DISTINCT "user" FROM preqs) r WHERE contains(p.pattern, '{{USER}}')),
panc AS (
  SELECT request_id, path, '/' AS prefix FROM preqs
  UNION
  SELECT request_id, path, '/' || array_to_string(parts[1:k], '/') AS prefix
  FROM (SELECT request_id, path, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM preqs),
       LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS k)
),
phit AS (
  SELECT a.request_id, p.policy_id, p.pattern, p.excludes FROM panc a JOIN ppol p ON a.prefix = p.pattern
  WHERE p.recursive AND NOT (contains(p.pattern, '*') OR contains(p.pattern, '?'))
  UNION
  SELECT r.request_id, p.policy_id, p.pattern, p.excludes FROM preqs r JOIN ppol p ON r.path = p.pattern
  WHERE NOT p.recursive AND NOT (contains(p.pattern, '*') OR contains(p.pattern, '?'))
  UNION
  SELECT r.request_id, p.policy_id, p.pattern, p.excludes FROM preqs r,
    (SELECT * FROM ppol WHERE contains(pattern, '*') OR contains(pattern, '?')) p
  WHERE r.path GLOB p.pattern OR (p.recursive AND r.path GLOB p.pattern || '/*')
  UNION
  SELECT a.request_id, m.policy_id, m.pattern, m.excludes
  FROM panc a JOIN preqs r USING (request_id) JOIN umac m ON m."user" = r."user" AND m.own = a.prefix
  WHERE m.recursive OR a.path = a.prefix
),
pmatch AS (
  SELECT request_id, policy_id, pattern FROM phit WHERE NOT excludes
  UNION ALL
  SELECT r.request_id, x.policy_id, NULL FROM preqs r, (SELECT DISTINCT policy_id FROM ppol WHERE excludes) x
  WHERE NOT EXISTS (SELECT 1 FROM phit h WHERE h.request_id = r.request_id AND h.policy_id = x.policy_id)
)
{body}""")


def objectstore_resources(spark, sf_dir, enabled_only: bool):
    res = policy_snapshot(spark, sf_dir, names=("resources",))["resources"].where(F.col("service") == "objectstore")
    if enabled_only:
        en = policy_snapshot(spark, sf_dir, names=("items_x",))["items_x"].where("is_enabled").select("policy_id").distinct()
        res = res.join(en, "policy_id", "left_semi")
    return res


@query("path_prefix_join", lambda: _path_cte("SELECT DISTINCT request_id, policy_id, pattern FROM pmatch", False))
def q_path_prefix_join(spark, sf_dir):
    reqs = path_requests(spark, sf_dir)
    return match_paths(reqs, ["request_id"], objectstore_resources(spark, sf_dir, False), "objectstore", "user",
                       resource_bound(spark, sf_dir, "objectstore"))


@query("match_recursive_path", lambda: _path_cte("""
SELECT DISTINCT m.request_id, r.path, m.policy_id, m.pattern FROM pmatch m JOIN preqs r USING (request_id)
WHERE r.path <> m.pattern
""", True))
def q_match_recursive_path(spark, sf_dir):
    reqs = path_requests(spark, sf_dir)
    return (match_paths(reqs, ["request_id", "path"], objectstore_resources(spark, sf_dir, True), "objectstore", "user",
                        resource_bound(spark, sf_dir, "objectstore"))
            .where(F.col("path") != F.col("pattern")).select("request_id", "path", "policy_id", "pattern"))


def path_decisions(spark, sf_dir, reqs):
    """GOV-19 + object-store decision by the rule of ``access``; superusers skip it.

    Distinct (path, access) are matched and distinct (user, access, path) decided, whatever the number of requests.
    """
    keys = ["user", "access", "path"]
    staged = cut_lineage(reqs.select(*keys).distinct(), name="keys")
    dec = access.decide_by_index(staged, keys, {"path": "path"}, who=principals_of(spark, sf_dir, staged),
                                 **service_index(spark, sf_dir, "objectstore"))
    skip = F.col("user").isin(fx.SKIP_USERS)
    return (access.decide_requests(reqs, keys, dec.select(*keys, "decision"))
            .select("request_id", "user", "access", "path",
                    F.when(skip, "SUPERUSER").otherwise(F.col("decision")).alias("decision")))


@query("skip_superusers", lambda: _path_cte(f""",
{principals_sql('preqs')},
matched AS (SELECT DISTINCT r.path, r."user", m.policy_id FROM pmatch m JOIN preqs r USING (request_id)),
{decide_matched_sql('preqs', ['path'], 'objectstore')}
SELECT r.request_id, r."user", r.access, r.path,
       CASE WHEN r."user" IN {tuple(fx.SKIP_USERS)} THEN 'SUPERUSER' ELSE d.decision END AS decision
FROM preqs r JOIN decisions d USING ("user", access, path)
""", True))
def q_skip_superusers(spark, sf_dir):
    return path_decisions(spark, sf_dir, path_requests(spark, sf_dir))


# --- GOV-15: ordered file rules ----------------------------------------------

# Ordered rules (user regex, schema regex, table regex, privileges).
FILE_RULES = [
    (0, "u1", "tpch", ".*", ["SELECT", "INSERT", "DELETE", "OWNERSHIP"]),
    (1, "u[0-9]", "web", "events|pages", ["SELECT"]),
    (2, ".*", "tpch", "nation|region", ["SELECT"]),
    (3, "u1[0-9]+", ".*", ".*", ["SELECT", "INSERT"]),
    (4, ".*", "information_schema", ".*", []),
]
PRIV_OF_ACCESS = [("select", "SELECT"), ("update", "UPDATE"), ("create", "INSERT"), ("drop", "DELETE"),
                  ("alter", "OWNERSHIP")]


def file_rules_access(reqs: DataFrame, rules: list[tuple], priv_of: dict[str, str]) -> DataFrame:
    """First rule (lowest number) whose three regexes fully match decides.

    The ordered rules become one first-match expression over the columns of a request: no join and no shuffle, and
    a request is read once.
    """
    full = lambda c, r: F.regexp_like(F.col(c), F.lit(f"^(?:{r})$"))
    win = None
    for no, user, schema, tbl, privileges in sorted(rules):
        fits = full("user", user) & full("db", schema) & full("tbl", tbl)
        said = F.struct(F.lit(no).alias("rule_no"), F.array(*map(F.lit, privileges)).cast("array<string>").alias("privileges"))
        win = F.when(fits, said) if win is None else win.when(fits, said)
    named = F.create_map(*[F.lit(x) for pair in priv_of.items() for x in pair])[F.col("access")]
    none = F.array().cast("array<string>")
    return reqs.withColumn("w", win).select(
        "request_id", "user", "db", "tbl", "access", F.coalesce(F.col("w.rule_no").cast("string"), F.lit("no_rule")).alias("rule"),
        F.array_join(F.coalesce("w.privileges", none), ",").alias("privileges"),
        F.coalesce(F.array_contains(F.coalesce("w.privileges", none), named), F.lit(False)).alias("allowed"))


@query("file_rules_access", lambda: f"""
WITH reqs AS ({fx.requests_sql()}),
rules AS (SELECT * FROM {fx.values_sql(FILE_RULES, ['rule_no', 'r_user', 'r_schema', 'r_table', 'privileges']).replace(' AS t(', ' AS ru(')}),
pm AS (SELECT * FROM {fx.values_sql(PRIV_OF_ACCESS, ['access', 'priv']).replace(' AS t(', ' AS pmx(')}),
win AS (
  SELECT r.request_id, arg_min(ru.rule_no, ru.rule_no) AS rule_no, arg_min(ru.privileges, ru.rule_no) AS privileges
  FROM reqs r JOIN rules ru ON regexp_full_match(r."user", ru.r_user) AND regexp_full_match(r.db, ru.r_schema)
   AND regexp_full_match(r.tbl, ru.r_table)
  GROUP BY r.request_id
)
SELECT r.request_id, r."user", r.db, r.tbl, r.access, coalesce(CAST(w.rule_no AS VARCHAR), 'no_rule') AS rule,
       array_to_string(coalesce(w.privileges, []::VARCHAR[]), ',') AS privileges,
       coalesce(w.rule_no IS NOT NULL AND list_contains(coalesce(w.privileges, []::VARCHAR[]), pm.priv), false) AS allowed
FROM reqs r LEFT JOIN win w USING (request_id) LEFT JOIN pm USING (access)
""")
def q_file_rules_access(spark, sf_dir):
    return file_rules_access(fx.requests(spark, sf_dir), FILE_RULES, dict(PRIV_OF_ACCESS))
