"""Policy-change log: lines composed from ``orders`` by a fixed template."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators import policylog as pl
from wardlake.operators.audit import retention_filter
from wardlake.plans.registry import query
from wardlake.session import cut_lineage, fresh_path
from wardlake.sources.tables import read_order, scan_parquet

# A template piece is a literal or a (spark column, duckdb sql) pair, so the
# same line is composed on both sides from the orders row.


def _spark_cols() -> dict:
    k = F.col("o_orderkey")
    ks = k.cast("string")
    ts = F.timestamp_add("SECOND", F.pmod(k, F.lit(86400)), F.col("o_orderdate"))
    year = F.year("o_orderdate").cast("string")
    objs = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    kind = (F.when(F.col("o_orderstatus") == "F", "update").when(F.col("o_orderstatus") == "O", "create")
            .otherwise("delete"))
    grp = F.concat(F.lit("analyst_"), F.lower(F.regexp_replace(F.substring("o_orderpriority", 3, 100), " ", "_")),
                   F.when(F.pmod(k, F.lit(5)) == 0, F.lit(" partner_companyA")).otherwise(F.lit("")), F.lit(" "))
    w = F.when((F.col("o_orderstatus") == "F") & (F.pmod(k, F.lit(2)) == 0), "true").otherwise("false")
    res = F.when(objs, F.concat(
        F.lit("path={PolicyResource={values={s3://lake/orders/"), year, F.lit("/"), ks,
        F.lit(" s3://lake/archive/"), ks, F.lit(" } isExcludes={false} isRecursive={true} }} "))
    ).otherwise(F.concat(F.lit("database={PolicyResource={values={sales staging } isExcludes={false} "
                               "isRecursive={false} }} table={PolicyResource={values={orders_"), year,
                         F.lit(" } isExcludes={false} isRecursive={false} }} ")))
    return {"ts": F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
            "ms": F.lpad(F.pmod(k, F.lit(1000)).cast("string"), 3, "0"),
            "thread": F.pmod(k, F.lit(16)).cast("string"),
            "level": F.when(F.pmod(k, F.lit(7)) == 0, "INFO ").otherwise("DEBUG"),
            "line": (F.pmod(k, F.lit(50)) + 100).cast("string"),
            "kind": kind, "key": ks, "service": F.when(objs, "objectstore").otherwise("catalog"),
            "res": res, "w": w, "grp": grp}


def _pieces():
    sql_year = "CAST(year(o_orderdate) AS VARCHAR)"
    sql_ts = "o_orderdate + to_seconds(o_orderkey % 86400)"
    sql_kind = "CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'create' ELSE 'delete' END"
    sql_objs = "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
    sql_res = (f"CASE WHEN {sql_objs} THEN 'path={{PolicyResource={{values={{s3://lake/orders/' || {sql_year} || '/' "
               "|| CAST(o_orderkey AS VARCHAR) || ' s3://lake/archive/' || CAST(o_orderkey AS VARCHAR) || "
               "' } isExcludes={false} isRecursive={true} }} ' ELSE 'database={PolicyResource={values={sales staging } "
               "isExcludes={false} isRecursive={false} }} table={PolicyResource={values={orders_' || "
               f"{sql_year} || ' }} isExcludes={{false}} isRecursive={{false}} }}}} ' END")
    sql_grp = ("'analyst_' || lower(replace(substr(o_orderpriority, 3, 100), ' ', '_')) || "
               "CASE WHEN o_orderkey % 5 = 0 THEN ' partner_companyA' ELSE '' END || ' '")
    sql_w = "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END"
    head = [
        ("ts", f"strftime({sql_ts}, '%Y-%m-%d %H:%M:%S')"), ",",
        ("ms", "lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')"),
        " [http-exec-", ("thread", "CAST(o_orderkey % 16 AS VARCHAR)"), "] ",
        ("level", "CASE WHEN o_orderkey % 7 = 0 THEN 'INFO ' ELSE 'DEBUG' END"),
        " com.example.policy.PolicyService (PolicyService.java:",
        ("line", "CAST(o_orderkey % 50 + 100 AS VARCHAR)"), ") - ",
    ]
    call = [
        f"<== {pl.CALL_PREFIX}.", ("kind", sql_kind), "Policy(StorePolicy={id={", ("key", "CAST(o_orderkey AS VARCHAR)"),
        "} guid={ord-", ("key", "CAST(o_orderkey AS VARCHAR)"), "} isEnabled={true} service={",
        ("service", f"CASE WHEN {sql_objs} THEN 'objectstore' ELSE 'catalog' END"),
        "} name={order ", ("key", "CAST(o_orderkey AS VARCHAR)"), "} policyType={0} resources={", ("res", sql_res),
        "} policyItems={PolicyItem={accessTypes={PolicyItemAccess={type={read} isAllowed={true} }"
        "PolicyItemAccess={type={write} isAllowed={", ("w", sql_w), "} }} users={} groups={", ("grp", sql_grp),
        "} conditions={} delegateAdmin={false} }} denyPolicyItems={} allowExceptions={}})",
    ]
    entry = [f"==> {pl.CALL_PREFIX}.", ("kind", sql_kind), "Policy(id={", ("key", "CAST(o_orderkey AS VARCHAR)"), "})"]
    return head, call, entry


def _spark(pieces):
    cols = _spark_cols()
    return F.concat(*[F.lit(p) if isinstance(p, str) else cols[p[0]] for p in pieces])


def _sql(pieces):
    def lit(s):
        return "'" + s.replace("'", "''") + "'"
    return " || ".join(lit(p) if isinstance(p, str) else f"({p[1]})" for p in pieces)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_id, ts_ms, value): for every order, an entry line (``==>``) and
    the policy call line (``<==``) that the subscription filter keeps."""
    head, call, entry = _pieces()
    o = scan_parquet(spark, sf_dir, "orders")
    ts_ms = (F.unix_micros(F.timestamp_add("SECOND", F.pmod("o_orderkey", F.lit(86400)),
                                           F.col("o_orderdate").cast("timestamp"))) / 1000).cast("long")
    calls = o.select((F.col("o_orderkey") * 2).alias("line_id"), ts_ms.alias("ts_ms"), _spark(head + call).alias("value"))
    entries = (o.select((F.col("o_orderkey") * 2 + 1).alias("line_id"), ts_ms.alias("ts_ms"),
                       _spark(head + entry).alias("value")))
    return calls.unionByName(entries)


def lines_sql() -> str:
    head, call, entry = _pieces()
    return f"""
loglines AS (
  SELECT o_orderkey * 2 AS line_id, o_orderkey, {_sql(head + call)} AS value FROM orders
  UNION ALL
  SELECT o_orderkey * 2 + 1, o_orderkey, {_sql(head + entry)} FROM orders
)"""


def landed_log(spark, sf_dir) -> str:
    path = fresh_path(spark, "policy_log")
    log_lines(spark, sf_dir).select("value").write.mode("overwrite").text(path)
    return path


def parsed_log(spark, sf_dir) -> DataFrame:
    """Text -> header fields -> policy fields; ``seq`` orders lines within the read."""
    lines = spark.read.text(landed_log(spark, sf_dir)).select("value", read_order().alias("seq"))
    p = pl.parse_header(lines)
    return pl.extract_policy_fields(p).withColumn("kind", pl.event_kind(F.col("message")))


HEADER_SQL = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \[([^\]]*)\] (\S+) +(\S+) \(([^:)]+):(\d+)\) - (.*)$"


def _cte(body: str) -> str:
    return f"WITH {lines_sql()},\nhdr AS (SELECT line_id, o_orderkey, value, " + ", ".join(
        f"regexp_extract(value, '{HEADER_SQL}', {i}) AS g{i}" for i in range(1, 8)) + f" FROM loglines)\n{body}"


@query("parse_log_header", lambda: _cte("""
SELECT g1 AS log_time, g2 AS thread, g3 AS level, g4 AS logger, g5 AS src_file, CAST(g6 AS INTEGER) AS src_line,
       g7 AS message FROM hdr
"""))
def q_parse_log_header(spark, sf_dir):
    p = pl.parse_header(spark.read.text(landed_log(spark, sf_dir)))
    return p.select(F.date_format("log_ts", "yyyy-MM-dd HH:mm:ss,SSS").alias("log_time"), "thread", "level", "logger",
                    "src_file", "src_line", "message")


@query("filter_contains", lambda: _cte(
    "SELECT line_id % 2 AS is_entry, o_orderkey AS policy_id FROM hdr WHERE contains(g7, 'ServiceREST.updatePolicy')"))
def q_filter_contains(spark, sf_dir):
    p = parsed_log(spark, sf_dir)
    f = p.where(pl.contains_call(F.col("message"), "ServiceREST.updatePolicy"))
    return f.select(F.when(F.col("message").startswith("==>"), 1).otherwise(0).cast("bigint").alias("is_entry"),
                    F.coalesce("policy_id", F.regexp_extract("message", r"id=\{(\d+)\}", 1).cast("long"))
                    .alias("policy_id"))


@query("filter_positional_words", lambda: _cte("""
SELECT o_orderkey AS policy_id, regexp_extract(g7, 'ServiceREST\\.(\\w+)Policy\\(', 1) AS kind FROM hdr
WHERE string_split_regex(value, ' +')[8] = '<=='
"""))
def q_filter_positional(spark, sf_dir):
    p = parsed_log(spark, sf_dir)
    return p.where(pl.positional_filter(F.col("value"))).select("policy_id", "kind")


EXTRACT_SQL = lambda: _cte("""
SELECT o_orderkey AS policy_id, 'ord-' || CAST(o_orderkey AS VARCHAR) AS guid,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'objectstore' ELSE 'catalog' END AS service,
       'order ' || CAST(o_orderkey AS VARCHAR) AS policy_name,
       trim('analyst_' || lower(replace(substr(o_orderpriority, 3, 100), ' ', '_'))
            || CASE WHEN o_orderkey % 5 = 0 THEN ' partner_companyA' ELSE '' END) AS groups,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
            THEN 's3://lake/orders/' || CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR)
                 || ' s3://lake/archive/' || CAST(o_orderkey AS VARCHAR)
            ELSE 'sales staging' END AS first_values,
       'true' AS read_allowed,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS write_allowed,
       CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'create' ELSE 'delete' END AS kind
FROM orders
""")


FIELD_COLS = ["seq", "log_ts", "policy_id", "guid", "service", "policy_name", "groups", "first_values",
              "table_values", "read_allowed", "write_allowed", "kind"]


def _fields(spark, sf_dir):
    """Policy lines with their fields, parsed once into a Parquet stage
    (grants, upserts and documents read it more than once)."""
    p = parsed_log(spark, sf_dir).where(F.col("policy_id").isNotNull()).select(*FIELD_COLS)
    return cut_lineage(p, name="policy_log_fields")


@query("extract_policy_fields", EXTRACT_SQL)
def q_extract_policy_fields(spark, sf_dir):
    f = _fields(spark, sf_dir)
    return f.select("policy_id", "guid", "service", "policy_name", F.trim("groups").alias("groups"),
                    F.trim("first_values").alias("first_values"), "read_allowed", "write_allowed", "kind")


@query("policy_event_kinds", lambda: _cte("""
SELECT regexp_extract(g7, 'ServiceREST\\.(\\w+)Policy\\(', 1) AS kind, count(*) AS n FROM hdr
WHERE string_split_regex(value, ' +')[8] = '<==' GROUP BY 1
"""))
def q_policy_event_kinds(spark, sf_dir):
    p = parsed_log(spark, sf_dir).where(pl.positional_filter(F.col("value")))
    return p.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("retention_filter", lambda: _cte("""
, t AS (SELECT o_orderkey, line_id, strptime(g1, '%Y-%m-%d %H:%M:%S,%g') AS ts FROM hdr)
SELECT line_id % 2 AS is_entry, o_orderkey AS policy_id FROM t
WHERE ts >= (SELECT max(ts) FROM t) - INTERVAL 14 DAYS
""").replace(")\n, t AS", "),\nt AS"))
def q_retention_filter(spark, sf_dir):
    # the newest time needs the header alone; fields are taken from the lines that stay
    lines = spark.read.text(landed_log(spark, sf_dir))
    kept = pl.extract_policy_fields(retention_filter(pl.parse_header(lines), "log_ts", 14))
    return kept.select(F.when(F.col("message").startswith("==>"), 1).otherwise(0).cast("bigint").alias("is_entry"),
                       F.coalesce("policy_id", F.regexp_extract("message", r"id=\{(\d+)\}", 1).cast("long"))
                       .alias("policy_id"))


def title_sql(c: str) -> str:
    return (f"array_to_string([CASE WHEN i = 1 OR NOT regexp_matches(substr({c}, i - 1, 1), '[A-Za-z]') "
            f"THEN upper(substr({c}, i, 1)) ELSE lower(substr({c}, i, 1)) END "
            f"for i in range(1, length({c}) + 1)], '')")


GROUPS_SQL = """
grps AS (
  SELECT o_orderkey, o_orderdate, o_orderstatus, o_orderpriority, unnest(string_split(trim(
    'analyst_' || lower(replace(substr(o_orderpriority, 3, 100), ' ', '_'))
    || CASE WHEN o_orderkey % 5 = 0 THEN ' partner_companyA' ELSE '' END), ' ')) AS grp
  FROM orders
)"""


@query("role_name_from_group", lambda: f"""
WITH {GROUPS_SQL}
SELECT DISTINCT grp, {title_sql('grp')} || 'Role' AS role, {title_sql('grp')} || 'Policy' AS policy_doc FROM grps
""")
def q_role_name(spark, sf_dir):
    f = _fields(spark, sf_dir)
    g = f.select(F.explode(pl.words(F.col("groups"))).alias("grp")).distinct()
    return g.select("grp", pl.role_name(F.col("grp")).alias("role"), pl.policy_doc_name(F.col("grp")).alias("policy_doc"))


def _stmt_sql() -> str:
    return f"""
WITH {GROUPS_SQL},
st AS (
  SELECT {title_sql('grp')} || 'Policy' AS policy_doc, CAST(o_orderkey AS VARCHAR) AS sid, 'Allow' AS effect,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 's3:Get*,s3:List*,s3:Head*,s3:Put*,s3:Delete*'
              ELSE 's3:Get*,s3:List*,s3:Head*' END AS actions,
         'arn:aws:s3:::lake/orders/' || CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR)
           || ',arn:aws:s3:::lake/archive/' || CAST(o_orderkey AS VARCHAR) AS resources,
         o_orderstatus
  FROM grps WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
)"""


def _flat(df):
    return df.select("policy_doc", "sid", "effect", F.array_join("actions", ",").alias("actions"),
                     F.array_join("resources", ",").alias("resources"))


@query("grants_object_store", lambda: _stmt_sql() + " SELECT policy_doc, sid, effect, actions, resources FROM st "
                                                    "WHERE o_orderstatus = 'F'")
def q_grants_object_store(spark, sf_dir):
    return _flat(pl.grants_object_store(_fields(spark, sf_dir)))


@query("grants_catalog_select", lambda: f"""
WITH {GROUPS_SQL}
SELECT o_orderkey AS policy_id, {title_sql('grp')} || 'Role' AS role, unnest(['sales', 'staging']) AS database,
       'orders_' || CAST(year(o_orderdate) AS VARCHAR) AS "table", 'SELECT' AS permission
FROM grps WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus = 'F'
""")
def q_grants_catalog_select(spark, sf_dir):
    return pl.grants_catalog_select(_fields(spark, sf_dir))


def _existing(fields):
    """The stored state before the updates: read-only statements for every
    object-store policy line (any kind)."""
    f = fields.where(F.col("service") == "objectstore").withColumn("kind", F.lit("update")) \
        .withColumn("write_allowed", F.lit("false"))
    return pl.latest_statements(pl.grants_object_store(f))


def _upserted(spark, sf_dir):
    fields = _fields(spark, sf_dir)
    updates = pl.latest_statements(pl.grants_object_store(fields))
    return pl.upsert_grants(_existing(fields), updates)


@query("upsert_grants", lambda: _stmt_sql() + """
SELECT policy_doc, sid, effect, CASE WHEN o_orderstatus = 'F' THEN actions ELSE 's3:Get*,s3:List*,s3:Head*' END AS actions,
       resources FROM st""")
def q_upsert_grants(spark, sf_dir):
    return _flat(_upserted(spark, sf_dir))


def _json_list(c: str) -> str:
    return f"""'["' || replace({c}, ',', '","') || '"]'"""


@query("collect_statements", lambda: _stmt_sql() + f"""
SELECT policy_doc, CAST(0 AS BIGINT) AS doc_no, CAST(count(*) AS INTEGER) AS n_statements,
       string_agg(sid, ',' ORDER BY CAST(sid AS BIGINT)) AS sids,
       '{{"Version":"2012-10-17","Statement":[' || string_agg(
         '{{"Sid":"' || sid || '","Effect":"' || effect || '","Action":' || {_json_list('actions')}
         || ',"Resource":' || {_json_list('resources')} || '}}', ',' ORDER BY CAST(sid AS BIGINT)) || ']}}' AS document
FROM st GROUP BY 1""")
def q_collect_statements(spark, sf_dir):
    return pl.collect_statements(_upserted(spark, sf_dir), None)


@query("decode_log_envelope", lambda: f"WITH {lines_sql()} SELECT CAST(line_id AS VARCHAR) AS event_id, value AS message "
                                      "FROM loglines")
def q_decode_log_envelope(spark, sf_dir):
    path = fresh_path(spark, "log_envelopes")
    pl.encode_envelopes(log_lines(spark, sf_dir)).write.mode("overwrite").parquet(path)
    return pl.decode_envelopes(spark.read.parquet(path)).select("event_id", "message")
