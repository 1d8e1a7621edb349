"""DuckDB oracle fragments for the policy tables (written independently of
the Spark code: DuckDB reads the same JSON files with declared types and
builds the same normalized rows with ``unnest``)."""

from __future__ import annotations

from wardlake.operators.policies import ORDER_POLICY_OFFSET
from wardlake.plans.fixtures import LEGACY_FILE, POLICY_FILES, SERVICEDEF_FILE

_ACC = 'STRUCT("type" VARCHAR, isAllowed BOOLEAN)[]'
_ITEM = (f'accesses {_ACC}, users VARCHAR[], "groups" VARCHAR[], roles VARCHAR[], '
         'conditions VARCHAR[], delegateAdmin BOOLEAN')
_RES = 'STRUCT("values" VARCHAR[], isExcludes BOOLEAN, isRecursive BOOLEAN)'
POLICY_TYPE = (
    'STRUCT(id BIGINT, guid VARCHAR, service VARCHAR, "name" VARCHAR, policyType INTEGER, '
    'policyPriority INTEGER, description VARCHAR, isAuditEnabled BOOLEAN, isEnabled BOOLEAN, '
    '"version" INTEGER, serviceType VARCHAR, isDenyAllElse BOOLEAN, policyLabels VARCHAR[], '
    f'"resources" MAP(VARCHAR, {_RES}), '
    f'policyItems STRUCT({_ITEM})[], denyPolicyItems STRUCT({_ITEM})[], '
    f'allowExceptions STRUCT({_ITEM})[], denyExceptions STRUCT({_ITEM})[], '
    f'dataMaskPolicyItems STRUCT({_ITEM}, dataMaskInfo STRUCT(dataMaskType VARCHAR, conditionExpr VARCHAR, valueExpr VARCHAR))[], '
    f'rowFilterPolicyItems STRUCT({_ITEM}, rowFilterInfo STRUCT(filterExpr VARCHAR))[])[]'
)
LEGACY_COLS = (
    "{'id': 'BIGINT', 'policyName': 'VARCHAR', 'databases': 'VARCHAR', 'tables': 'VARCHAR', "
    "'columns': 'VARCHAR', 'columnFamilies': 'VARCHAR', 'udfs': 'VARCHAR', 'resourceName': 'VARCHAR', "
    "'repositoryName': 'VARCHAR', 'tableType': 'VARCHAR', 'columnType': 'VARCHAR', "
    "'isEnabled': 'VARCHAR', 'isAuditEnabled': 'VARCHAR', 'isRecursive': 'BOOLEAN', "
    "'permMapList': 'STRUCT(userList VARCHAR[], groupList VARCHAR[], permList VARCHAR[])[]'}"
)
SERVICEDEF_COLS = (
    "{'id': 'INTEGER', 'name': 'VARCHAR', "
    "'resources': 'STRUCT(itemId INTEGER, \"name\" VARCHAR, \"type\" VARCHAR, \"level\" INTEGER, parent VARCHAR, "
    "mandatory BOOLEAN, recursiveSupported BOOLEAN, excludesSupported BOOLEAN, "
    "matcherOptions STRUCT(wildCard BOOLEAN, ignoreCase BOOLEAN))[]', "
    "'accessTypes': 'STRUCT(itemId INTEGER, \"name\" VARCHAR, label VARCHAR, impliedGrants VARCHAR[])[]'}"
)

HEAD = ("p.id AS policy_id, p.service, coalesce(p.policyType, 0) AS policy_type, "
        "coalesce(p.policyPriority, 0) AS priority, coalesce(p.isEnabled, true) AS is_enabled, "
        "coalesce(p.isAuditEnabled, true) AS is_audit_enabled, coalesce(p.isDenyAllElse, false) AS deny_all_else")
HEAD_COLS = "policy_id, service, policy_type, priority, is_enabled, is_audit_enabled, deny_all_else"


def _list(kind: str, col: str, mask: bool = False, rf: bool = False) -> str:
    m = ("it.dataMaskInfo.dataMaskType", "it.dataMaskInfo.conditionExpr", "it.dataMaskInfo.valueExpr") if mask \
        else ("NULL", "NULL", "NULL")
    f = "it.rowFilterInfo.filterExpr" if rf else "NULL"
    return f"""
  SELECT {HEAD_COLS}, '{kind}' AS item_kind, item_no, it.accesses AS accesses, it.users AS users,
         it."groups" AS grps, it.roles AS roles, coalesce(it.delegateAdmin, false) AS delegate_admin,
         CAST({m[0]} AS VARCHAR) AS mask_type, CAST({m[1]} AS VARCHAR) AS condition_expr,
         CAST({m[2]} AS VARCHAR) AS value_expr, CAST({f} AS VARCHAR) AS filter_expr
  FROM (SELECT {HEAD}, unnest(p.{col}) AS it, CAST(generate_subscripts(p.{col}, 1) - 1 AS INTEGER) AS item_no FROM pol_all)"""


def policies_cte() -> str:
    """CTEs: pol_v2 (authored), pol_orders (derived), pol_all, raw_items, items, resources."""
    lists = " UNION ALL ".join([
        _list("allow", "policyItems"), _list("deny", "denyPolicyItems"),
        _list("allow_exception", "allowExceptions"), _list("deny_exception", "denyExceptions"),
        _list("mask", "dataMaskPolicyItems", mask=True), _list("row_filter", "rowFilterPolicyItems", rf=True),
    ])
    return f"""
pol_v2 AS (
  SELECT unnest(policies) AS p FROM read_json({POLICY_FILES!r}, columns={{'policies': '{POLICY_TYPE}'}})
),
pol_orders AS (
  SELECT {{
    'id': o_orderkey + {ORDER_POLICY_OFFSET}, 'service': 'objectstore', 'policyType': 0, 'policyPriority': 0,
    'isAuditEnabled': o_orderpriority IN ('1-URGENT', '2-HIGH'), 'isEnabled': o_orderstatus <> 'P',
    'isDenyAllElse': false,
    'path': '/orders/' || CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR),
    'policyItems': [{{'accesses': CASE WHEN o_orderstatus = 'O'
                        THEN [{{'type': 'read', 'isAllowed': true}}, {{'type': 'write', 'isAllowed': true}}]
                        ELSE [{{'type': 'read', 'isAllowed': true}}] END,
                      'users': ['u' || CAST(o_custkey AS VARCHAR)], 'groups': []::VARCHAR[], 'roles': []::VARCHAR[],
                      'delegateAdmin': o_orderpriority = '1-URGENT'}}],
    'denyPolicyItems': CASE WHEN o_totalprice > 300000
                        THEN [{{'accesses': [{{'type': 'write', 'isAllowed': true}}], 'users': []::VARCHAR[],
                               'groups': ['public'], 'roles': []::VARCHAR[], 'delegateAdmin': false}}]
                        ELSE [] END
  }} AS p FROM orders
),
pol_all AS (
  SELECT {{'id': p.id, 'service': p.service, 'policyType': p.policyType, 'policyPriority': p.policyPriority,
          'isAuditEnabled': p.isAuditEnabled, 'isEnabled': p.isEnabled, 'isDenyAllElse': p.isDenyAllElse,
          'policyItems': p.policyItems, 'denyPolicyItems': p.denyPolicyItems,
          'allowExceptions': p.allowExceptions, 'denyExceptions': p.denyExceptions,
          'dataMaskPolicyItems': p.dataMaskPolicyItems, 'rowFilterPolicyItems': p.rowFilterPolicyItems}} AS p
  FROM pol_v2
),
raw_items_v2 AS ({lists}),
raw_items_orders AS (
  SELECT p.id AS policy_id, p.service, p.policyType AS policy_type, p.policyPriority AS priority,
         p.isEnabled AS is_enabled, p.isAuditEnabled AS is_audit_enabled, p.isDenyAllElse AS deny_all_else,
         k.item_kind, 0 AS item_no, k.it.accesses AS accesses, k.it.users AS users, k.it."groups" AS grps,
         k.it.roles AS roles, k.it.delegateAdmin AS delegate_admin, CAST(NULL AS VARCHAR) AS mask_type,
         CAST(NULL AS VARCHAR) AS condition_expr, CAST(NULL AS VARCHAR) AS value_expr,
         CAST(NULL AS VARCHAR) AS filter_expr
  FROM pol_orders,
  LATERAL (SELECT 'allow' AS item_kind, unnest(p.policyItems) AS it
           UNION ALL SELECT 'deny', unnest(p.denyPolicyItems)) k
),
legacy AS (SELECT * FROM read_json('{LEGACY_FILE}', columns={LEGACY_COLS})),
raw_items_legacy AS (
  SELECT id AS policy_id, repositoryName AS service, 0 AS policy_type, 0 AS priority,
         coalesce(lower(trim(isEnabled)) = 'true', false) AS is_enabled,
         coalesce(lower(trim(isAuditEnabled)) = 'true', false) AS is_audit_enabled,
         false AS deny_all_else, 'allow' AS item_kind, item_no,
         list_transform(coalesce(pm.permList, []::VARCHAR[]), lambda x: {{'type': x, 'isAllowed': true}}) AS accesses,
         pm.userList AS users, pm.groupList AS grps, []::VARCHAR[] AS roles, false AS delegate_admin,
         CAST(NULL AS VARCHAR) AS mask_type, CAST(NULL AS VARCHAR) AS condition_expr,
         CAST(NULL AS VARCHAR) AS value_expr, CAST(NULL AS VARCHAR) AS filter_expr
  FROM (SELECT *, unnest(permMapList) AS pm, CAST(generate_subscripts(permMapList, 1) - 1 AS INTEGER) AS item_no FROM legacy)
),
raw_items_none AS (
  SELECT {HEAD_COLS}, NULL AS item_kind, NULL AS item_no, NULL AS accesses, NULL AS users, NULL AS grps, NULL AS roles,
         NULL AS delegate_admin, NULL AS mask_type, NULL AS condition_expr, NULL AS value_expr, NULL AS filter_expr
  FROM (SELECT {HEAD} FROM pol_all WHERE coalesce(len(p.policyItems), 0) + coalesce(len(p.denyPolicyItems), 0)
          + coalesce(len(p.allowExceptions), 0) + coalesce(len(p.denyExceptions), 0)
          + coalesce(len(p.dataMaskPolicyItems), 0) + coalesce(len(p.rowFilterPolicyItems), 0) = 0
        UNION ALL
        SELECT id, repositoryName, 0, 0, coalesce(lower(trim(isEnabled)) = 'true', false),
               coalesce(lower(trim(isAuditEnabled)) = 'true', false), false
        FROM legacy WHERE coalesce(len(permMapList), 0) = 0)
),
raw_items AS (
  SELECT * FROM raw_items_none UNION ALL SELECT * FROM raw_items_v2 UNION ALL SELECT * FROM raw_items_orders UNION ALL SELECT * FROM raw_items_legacy
),
items AS (
  SELECT {HEAD_COLS}, item_kind, item_no, pr.kind AS principal_kind, pr.name AS principal,
         ac.a."type" AS access, CASE WHEN ac.a IS NOT NULL THEN coalesce(ac.a.isAllowed, true) END AS is_allowed,
         delegate_admin, mask_type, condition_expr, value_expr, filter_expr
  FROM raw_items LEFT JOIN LATERAL (SELECT 'user' AS kind, unnest(users) AS name UNION ALL SELECT 'group', unnest(grps)
           UNION ALL SELECT 'role', unnest(roles)) pr ON true
  LEFT JOIN LATERAL (SELECT unnest(accesses) AS a) ac ON true
),
res_v2 AS (
  SELECT p.id AS policy_id, p.service, e.key AS level, unnest(e.value."values") AS pattern,
         coalesce(e.value.isExcludes, false) AS excludes, coalesce(e.value.isRecursive, false) AS recursive
  FROM (SELECT p, unnest(map_entries(p."resources")) AS e FROM pol_v2)
),
res_orders AS (
  SELECT p.id AS policy_id, 'objectstore' AS service, 'path' AS level, p.path AS pattern,
         false AS excludes, true AS recursive FROM pol_orders
),
res_legacy_raw AS (
  SELECT id AS policy_id, repositoryName AS service, coalesce(isRecursive, false) AS rec, l.level, l.vals, l.ex
  FROM legacy, LATERAL (
    SELECT 'database' AS level, databases AS vals, false AS ex
    UNION ALL SELECT 'table', tables, coalesce(lower(tableType) = 'exclusion', false)
    UNION ALL SELECT 'column-family', columnFamilies, false
    UNION ALL SELECT 'column', columns, coalesce(lower(columnType) = 'exclusion', false)
    UNION ALL SELECT 'udf', udfs, false
    UNION ALL SELECT 'path', resourceName, false) l
),
res_legacy AS (
  SELECT policy_id, service, level, trim(v) AS pattern, ex AS excludes, rec AND level = 'path' AS recursive
  FROM (SELECT *, unnest(string_split(vals, ',')) AS v FROM res_legacy_raw WHERE vals IS NOT NULL)
  WHERE trim(v) <> ''
),
resources AS (SELECT * FROM res_v2 UNION ALL SELECT * FROM res_orders UNION ALL SELECT * FROM res_legacy),
servicedefs AS (SELECT * FROM read_json('{SERVICEDEF_FILE}', columns={SERVICEDEF_COLS})),
grants AS (
  SELECT service, access, unnest(list_distinct(list_concat([access], coalesce(implied, []::VARCHAR[])))) AS granted
  FROM (SELECT service, acct."name" AS access, acct.impliedGrants AS implied
        FROM (SELECT name AS service, unnest(accessTypes) AS acct FROM servicedefs))
),
items_x AS (
  SELECT i.* EXCLUDE (access), coalesce(g.granted, i.access) AS access
  FROM items i LEFT JOIN grants g ON i.service = g.service AND i.access = g.access
),
level_opts AS (
  SELECT name AS service, r."name" AS level, coalesce(r.matcherOptions.ignoreCase, false) AS ignore_case,
         coalesce(r.recursiveSupported, false) AS recursive_supported
  FROM (SELECT name, unnest(resources) AS r FROM servicedefs)
)"""
