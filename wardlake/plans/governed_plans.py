"""Governed reads of the driver's tables for named readers."""

from __future__ import annotations

from wardlake.operators.governed import governed
from wardlake.plans.access_plans import principals_of
from wardlake.plans.access_sql import principals_sql
from wardlake.plans.policy_plans import service_index, with_cte
from wardlake.plans.registry import query
from wardlake.sources.tables import scan_parquet

# The reader of the registered governed queries: the first customer of the
# BUILDING segment that no allow exception names (users u3 and u13).
READER_SQL = ("(SELECT 'u' || CAST(min(c_custkey) AS VARCHAR) FROM customer "
              "WHERE c_mktsegment = 'BUILDING' AND c_custkey NOT IN (3, 13))")


def reader(spark, sf_dir) -> str:
    from pyspark.sql import functions as F
    c = scan_parquet(spark, sf_dir, "customer")
    row = (c.where((F.col("c_mktsegment") == "BUILDING") & ~F.col("c_custkey").isin(3, 13))
           .agg(F.min("c_custkey")).first())
    return f"u{row[0]}"

ORDERS_COLS = [("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "str"), ("o_totalprice", "num"),
               ("o_orderdate", "time"), ("o_orderpriority", "str")]
CUSTOMER_COLS = [("c_custkey", "num"), ("c_name", "str"), ("c_nationkey", "num"), ("c_acctbal", "num"),
                 ("c_mktsegment", "str")]

# The filter and custom-mask texts of the authored policies, as SQL.
FILTER_SQL = {
    "o_orderstatus = 'F'": "o_orderstatus = 'F'",
    "o_totalprice < 100000": "o_totalprice < 100000",
    "c_mktsegment = 'BUILDING'": "c_mktsegment = 'BUILDING'",
}
CUSTOM_SQL = {"round({col}, -3)": "round({col}, -3)"}
CONDITION_SQL = {"c_name": {"c_acctbal < 5000": "c_acctbal < 5000"}}


def _governed(spark, sf_dir, table, user, **kw):
    who = principals_of(spark, sf_dir, spark.createDataFrame([(user,)], "user string"))
    return governed(scan_parquet(spark, sf_dir, table), user, "tpch", table, who=who,
                    **service_index(spark, sf_dir, "lakehouse"), **kw)


def _resolution_sql(user: str, tbl: str, cols) -> str:
    """CTEs: princ for the user, tl (table-level match), rf (row filter), masks per column."""
    col_vals = " UNION ALL ".join(f"SELECT '{c}' AS col" for c, _ in cols)
    return f""",
one_user AS (SELECT {user} AS "user"),
{principals_sql('one_user')},
lvl_t AS (
  SELECT policy_id, level,
         bool_or(lower(CASE level WHEN 'database' THEN 'tpch' WHEN 'table' THEN '{tbl}' END) GLOB lower(pattern))
           <> bool_or(excludes) AS ok
  FROM resources WHERE service = 'lakehouse' GROUP BY policy_id, level
),
tmatch AS (SELECT policy_id FROM lvl_t GROUP BY policy_id HAVING bool_and(coalesce(ok, false))),
rf AS (
  SELECT i.filter_expr FROM items_x i JOIN princ p ON p.principal_kind = i.principal_kind AND p.principal = i.principal
  WHERE i.service = 'lakehouse' AND i.policy_type = 2 AND i.is_enabled AND i.item_kind = 'row_filter'
    AND i.access = 'select' AND i.policy_id IN (SELECT policy_id FROM tmatch)
  ORDER BY i.policy_id, i.item_no LIMIT 1
),
tcols AS ({col_vals}),
lvl_c AS (
  SELECT c.col, r.policy_id, r.level,
         bool_or(lower(CASE r.level WHEN 'database' THEN 'tpch' WHEN 'table' THEN '{tbl}' WHEN 'column' THEN c.col END)
                 GLOB lower(r.pattern)) <> bool_or(r.excludes) AS ok
  FROM tcols c, resources r WHERE r.service = 'lakehouse' GROUP BY c.col, r.policy_id, r.level
),
cmatch AS (SELECT col, policy_id FROM lvl_c GROUP BY col, policy_id HAVING bool_and(coalesce(ok, false))),
masks AS (
  SELECT col, arg_min(mask_type, policy_id * 1000 + item_no) AS mask_type,
         arg_min(value_expr, policy_id * 1000 + item_no) AS value_expr,
         arg_min(condition_expr, policy_id * 1000 + item_no) AS condition_expr
  FROM (SELECT DISTINCT m.col, i.policy_id, i.item_no, i.mask_type, i.value_expr,
               coalesce(i.condition_expr, '') AS condition_expr
        FROM items_x i JOIN princ p ON p.principal_kind = i.principal_kind AND p.principal = i.principal
        JOIN cmatch m ON m.policy_id = i.policy_id
        WHERE i.service = 'lakehouse' AND i.policy_type = 1 AND i.is_enabled AND i.item_kind = 'mask'
          AND i.access = 'select')
  GROUP BY col
)"""


def _mask_sql(c: str, kind: str) -> str:
    body = _plain_mask_sql(c, kind)
    if c not in CONDITION_SQL:
        return body
    cond = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CONDITION_SQL[c].items())
    return (f"CASE WHEN NOT coalesce(CASE (SELECT condition_expr FROM masks WHERE col = '{c}') {cond} END, true) "
            f"THEN {c} ELSE {body.rsplit(' AS ', 1)[0]} END AS {c}")


def _plain_mask_sql(c: str, kind: str) -> str:
    mt = f"(SELECT mask_type FROM masks WHERE col = '{c}')"
    ve = f"(SELECT value_expr FROM masks WHERE col = '{c}')"
    xx = "regexp_replace({s}, '[A-Za-z0-9]', 'x', 'g')"
    custom = " ".join(f"WHEN {ve} = '{k}' THEN {v.format(col=c)}" for k, v in CUSTOM_SQL.items())
    if kind == "str":
        return f"""CASE {mt}
  WHEN 'MASK_NULL' THEN NULL
  WHEN 'MASK_HASH' THEN sha256({c})
  WHEN 'MASK' THEN regexp_replace(regexp_replace(regexp_replace({c}, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')
  WHEN 'MASK_SHOW_FIRST_4' THEN substr({c}, 1, 4) || {xx.format(s=f'substr({c}, 5)')}
  WHEN 'MASK_SHOW_LAST_4' THEN CASE WHEN length({c}) <= 4 THEN {c}
       ELSE {xx.format(s=f'substr({c}, 1, length({c}) - 4)')} || substr({c}, length({c}) - 3) END
  WHEN 'MASK_NONE' THEN {c}
  WHEN 'MASK_DATE_SHOW_YEAR' THEN NULL
  ELSE {c} END AS {c}"""
    if kind == "time":
        return f"""CASE {mt} WHEN 'MASK_DATE_SHOW_YEAR' THEN CAST(make_date(year({c}), 1, 1) AS TIMESTAMP)
  WHEN 'MASK_NONE' THEN {c}
  WHEN 'MASK_NULL' THEN NULL WHEN 'MASK' THEN NULL WHEN 'MASK_HASH' THEN NULL WHEN 'MASK_SHOW_FIRST_4' THEN NULL
  WHEN 'MASK_SHOW_LAST_4' THEN NULL ELSE {c} END AS {c}"""
    return f"""CASE {mt} WHEN 'MASK_NONE' THEN {c} WHEN 'CUSTOM' THEN CASE {custom} END
  WHEN 'MASK_NULL' THEN NULL WHEN 'MASK' THEN NULL WHEN 'MASK_HASH' THEN NULL WHEN 'MASK_SHOW_FIRST_4' THEN NULL
  WHEN 'MASK_SHOW_LAST_4' THEN NULL WHEN 'MASK_DATE_SHOW_YEAR' THEN NULL ELSE {c} END AS {c}"""


def _where_sql(cols) -> str:
    names = [c for c, _ in cols]
    cases = " ".join(f"WHEN '{k.replace(chr(39), chr(39) * 2)}' THEN {v}" for k, v in FILTER_SQL.items()
                     if any(n in v for n in names))
    return f"WHERE coalesce(CASE (SELECT filter_expr FROM rf) {cases} END, true)"


def _acl_sql(tbl: str) -> str:
    from wardlake.plans.access_sql import decide_sql
    return f""",
acl_keys AS (SELECT u."user", 'select' AS access, 'tpch' AS db, '{tbl}' AS tbl, c.col FROM one_user u, tcols c),
{decide_sql('acl_keys', prefix='a_')}"""


def _governed_sql(user, tbl, cols, do_filter=True, do_mask=True, do_acl=False):
    def one(c, k):
        expr = _mask_sql(c, k) if do_mask else f"{c} AS {c}"
        if not do_acl:
            return expr
        body = expr.rsplit(" AS ", 1)[0]
        return f"CASE WHEN (SELECT allowed FROM a_decisions_x WHERE col = '{c}') THEN {body} END AS {c}"
    sel = ", ".join(one(c, k) for c, k in cols)
    where = _where_sql(cols) if do_filter else ""
    acl = _acl_sql(tbl) if do_acl else ""
    return with_cte(f"""{_resolution_sql(user, tbl, cols)}{acl}
SELECT {sel} FROM {tbl} {where}""")


@query("row_filter", lambda: _governed_sql(READER_SQL, "orders", ORDERS_COLS, do_mask=False))
def q_row_filter(spark, sf_dir):
    return _governed(spark, sf_dir, "orders", reader(spark, sf_dir), masks=False, column_acl=False)


@query("column_mask", lambda: _governed_sql(READER_SQL, "customer", CUSTOMER_COLS, do_filter=False))
def q_column_mask(spark, sf_dir):
    return _governed(spark, sf_dir, "customer", reader(spark, sf_dir), row_filter=False, column_acl=False)


@query("governed_read", lambda: _governed_sql(READER_SQL, "orders", ORDERS_COLS, do_acl=True))
def q_governed_read(spark, sf_dir):
    # Columns the reader may not select come out as NULL, so the registered
    # report keeps one schema whoever the reader is.
    return _governed(spark, sf_dir, "orders", reader(spark, sf_dir), denied="null")


@query("governed_read_customer", lambda: _governed_sql(READER_SQL, "customer", CUSTOMER_COLS, do_acl=True))
def q_governed_read_customer(spark, sf_dir):
    return _governed(spark, sf_dir, "customer", reader(spark, sf_dir), denied="null")
