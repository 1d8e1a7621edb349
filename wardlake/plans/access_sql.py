"""DuckDB oracle for access decisions: the same rule, written as plain SQL
with GLOB matching per (request level, policy pattern)."""

from __future__ import annotations

from wardlake.plans import fixtures as fx

LAKE_LEVELS = [("database", "db"), ("table", "tbl"), ("column", "col")]


def principals_sql(users_cte: str) -> str:
    return f"""
members AS ({fx.MEMBERSHIPS_SQL}),
role_members AS (SELECT * FROM {fx.role_members_sql()}),
req_users AS (SELECT DISTINCT "user" FROM {users_cte}),
princ AS (
  SELECT DISTINCT * FROM (
    SELECT "user", 'user' AS principal_kind, "user" AS principal FROM req_users
    UNION ALL SELECT "user", 'group', 'public' FROM req_users
    UNION ALL SELECT "user", 'user', '{{USER}}' FROM req_users
    UNION ALL SELECT m."user", 'group', m.grp FROM members m JOIN req_users USING ("user")
    UNION ALL SELECT m."user", 'role', r.role FROM members m JOIN req_users USING ("user")
              JOIN role_members r ON m.grp = r.grp)
)"""


_CTE_NAMES = ["res_keys", "heads", "pres", "req_lv", "lvl", "npl", "matched", "its", "pairs", "hits",
              "per_pol", "agg", "decisions_x", "decisions"]


def decide_sql(keys_cte: str, levels=LAKE_LEVELS, service: str = "lakehouse", prefix: str = "") -> str:
    """CTEs over ``keys_cte(user, access, <level cols>)`` ending in ``decisions``."""
    sql = _decide_sql(keys_cte, levels, service)
    if prefix:
        import re
        sql = re.sub(r"\b(" + "|".join(_CTE_NAMES) + r")\b", lambda m: prefix + m.group(1), sql)
    return sql


def decide_matched_sql(keys_cte: str, rc: list[str], service: str) -> str:
    """The same from given ``matched(<resource columns>, user, policy_id)``."""
    sql = _decide_sql(keys_cte, [("-", c) for c in rc], service)
    on = " AND ".join(f"k.{c} = m.{c}" for c in rc)
    sql = sql.replace(f"JOIN matched m ON {on}", f'JOIN matched m ON {on} AND k."user" = m."user"')
    head = sql[sql.index("heads AS"):sql.index("pres AS")]
    return head + sql[sql.index("its AS"):]


def _decide_sql(keys_cte: str, levels, service: str) -> str:
    rc = [c for _, c in levels]
    rcs = ", ".join(rc)
    kcols = '"user", access, ' + rcs
    req_lv = " UNION ALL ".join(f"SELECT {rcs}, '{lvl}' AS level, CAST({c} AS VARCHAR) AS value FROM res_keys"
                                for lvl, c in levels)
    on_res = " AND ".join(f"l.{c} = m.{c}" for c in rc)
    return f"""
res_keys AS (SELECT DISTINCT {rcs} FROM {keys_cte}),
heads AS (SELECT DISTINCT policy_id, priority, deny_all_else, is_audit_enabled FROM items_x
          WHERE service = '{service}' AND policy_type = 0 AND is_enabled),
pres AS (SELECT r.*, coalesce(o.ignore_case, false) AS ic FROM resources r
         LEFT JOIN level_opts o ON o.service = r.service AND o.level = r.level
         WHERE r.service = '{service}' AND r.policy_id IN (SELECT policy_id FROM heads)),
req_lv AS ({req_lv}),
lvl AS (
  SELECT {', '.join('k.' + c for c in rc)}, p.policy_id, p.level,
         bool_or(CASE WHEN p.ic THEN lower(k.value) GLOB lower(p.pattern) ELSE k.value GLOB p.pattern END) AS hit,
         bool_or(p.excludes) AS ex
  FROM req_lv k JOIN pres p ON k.level = p.level
  GROUP BY ALL
),
npl AS (SELECT policy_id, count(DISTINCT level) AS n FROM pres GROUP BY policy_id),
matched AS (
  SELECT {', '.join('l.' + c for c in rc)}, l.policy_id FROM lvl l JOIN npl USING (policy_id)
  WHERE l.hit <> l.ex GROUP BY {', '.join('l.' + c for c in rc)}, l.policy_id, npl.n HAVING count(*) = npl.n
),
its AS (SELECT DISTINCT policy_id, item_kind, principal_kind, principal, access FROM items_x
        WHERE service = '{service}' AND policy_type = 0 AND is_enabled AND is_allowed
          AND item_kind IN ('allow', 'deny', 'allow_exception', 'deny_exception')),
pairs AS (SELECT DISTINCT k."user", k.access, {', '.join('k.' + c for c in rc)}, m.policy_id
          FROM {keys_cte} k JOIN matched m ON {' AND '.join(f'k.{c} = m.{c}' for c in rc)}),
hits AS (
  SELECT p."user", p.access, {', '.join('p.' + c for c in rc)}, p.policy_id,
         bool_or(i.item_kind = 'allow') AS al, bool_or(i.item_kind = 'deny') AS de,
         bool_or(i.item_kind = 'allow_exception') AS ae, bool_or(i.item_kind = 'deny_exception') AS dx
  FROM pairs p JOIN princ pr ON pr."user" = p."user"
  JOIN its i ON i.policy_id = p.policy_id AND i.principal_kind = pr.principal_kind
            AND i.principal = pr.principal AND i.access = p.access
  GROUP BY ALL
),
per_pol AS (
  SELECT p.*, h.priority, h.is_audit_enabled,
         coalesce(x.al, false) AND NOT coalesce(x.ae, false) AS a,
         (coalesce(x.de, false) AND NOT coalesce(x.dx, false))
           OR (h.deny_all_else AND NOT (coalesce(x.al, false) AND NOT coalesce(x.ae, false))) AS d
  FROM pairs p JOIN heads h USING (policy_id)
  LEFT JOIN hits x USING ({kcols}, policy_id)
),
agg AS (
  SELECT {kcols},
         min(policy_id) FILTER (WHERE priority > 0 AND d) AS ovd,
         min(policy_id) FILTER (WHERE priority > 0 AND a) AS ova,
         min(policy_id) FILTER (WHERE priority <= 0 AND d) AS nd,
         min(policy_id) FILTER (WHERE priority <= 0 AND a) AS na
  FROM per_pol GROUP BY ALL
),
decisions AS (
  SELECT k.*, CASE WHEN ovd IS NOT NULL THEN 'DENY' WHEN ova IS NOT NULL THEN 'ALLOW'
                   WHEN nd IS NOT NULL THEN 'DENY' WHEN na IS NOT NULL THEN 'ALLOW'
                   ELSE 'NOT_DETERMINED' END AS decision,
         coalesce(ovd, ova, nd, na) AS policy_id
  FROM (SELECT DISTINCT {kcols} FROM {keys_cte}) k LEFT JOIN agg USING ({kcols})
),
decisions_x AS (
  SELECT d.*, d.decision = 'ALLOW' AS allowed, h.is_audit_enabled
  FROM decisions d LEFT JOIN (SELECT DISTINCT policy_id, is_audit_enabled FROM heads) h USING (policy_id)
)"""
