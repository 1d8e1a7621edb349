"""Tags, tag policies, policy version diffs, file rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlake.operators import access, tags
from wardlake.operators import policies as pol
from wardlake.operators.matching import match_resources
from wardlake.plans import fixtures as fx
from wardlake.plans.access_plans import KEY, LAKE, RES, lake_inputs, principals_of, request_keys
from wardlake.plans.access_sql import decide_sql, principals_sql
from wardlake.plans.policy_plans import service_index, with_cte
from wardlake.plans.policy_sql import POLICY_TYPE
from wardlake.plans.registry import query
from wardlake.session import cut_lineage
from wardlake.sources.tables import scan_parquet

TAGSET_COLS = (
    "{'op': 'VARCHAR', 'tagVersion': 'INTEGER', 'serviceName': 'VARCHAR', "
    "'tags': 'MAP(VARCHAR, STRUCT(guid VARCHAR, id INTEGER, \"type\" VARCHAR))', "
    "'serviceResources': 'STRUCT(resourceElements MAP(VARCHAR, STRUCT(\"values\" VARCHAR[])), guid VARCHAR, "
    "id INTEGER, serviceName VARCHAR)[]', 'resourceToTagIds': 'MAP(VARCHAR, INTEGER[])'}"
)


def _tag_sql() -> str:
    return f""",
ts_all AS (SELECT * FROM read_json('{fx.TAGSET_FILE}', columns={TAGSET_COLS})),
ts AS (SELECT * FROM ts_all t WHERE tagVersion = (SELECT max(tagVersion) FROM ts_all x WHERE x.serviceName = t.serviceName)),
r2t AS (SELECT serviceName, tagVersion, CAST(e.key AS INTEGER) AS res_id, unnest(e.value) AS tag_id
        FROM (SELECT serviceName, tagVersion, unnest(map_entries(resourceToTagIds)) AS e FROM ts)),
tg AS (SELECT serviceName, tagVersion, e.value.id AS tag_id, e.value."type" AS tag
       FROM (SELECT serviceName, tagVersion, unnest(map_entries(tags)) AS e FROM ts)),
tres AS (SELECT serviceName, tagVersion, r.id AS res_id, el.key AS level, unnest(el.value."values") AS pattern
         FROM (SELECT serviceName, tagVersion, r, unnest(map_entries(r.resourceElements)) AS el
               FROM (SELECT serviceName, tagVersion, unnest(serviceResources) AS r FROM ts))),
bindings AS (SELECT r2t.serviceName AS service, r2t.tagVersion AS version, r2t.res_id, tres.level, tres.pattern, tg.tag
             FROM r2t JOIN tg USING (serviceName, tagVersion, tag_id) JOIN tres USING (serviceName, tagVersion, res_id)),
tag_res AS (SELECT DISTINCT res_id AS policy_id, service, level, pattern FROM bindings),
tkeys AS (SELECT DISTINCT db, tbl, col FROM reqs),
tlv AS (SELECT db, tbl, col, 'database' AS level, db AS value FROM tkeys
        UNION ALL SELECT db, tbl, col, 'table', tbl FROM tkeys UNION ALL SELECT db, tbl, col, 'column', col FROM tkeys),
tl AS (SELECT k.db, k.tbl, k.col, p.policy_id, p.level, bool_or(lower(k.value) GLOB lower(p.pattern)) AS hit
       FROM tlv k JOIN tag_res p ON k.level = p.level WHERE p.service = 'lakehouse' GROUP BY ALL),
tn AS (SELECT policy_id, count(DISTINCT level) AS n FROM tag_res WHERE service = 'lakehouse' GROUP BY policy_id),
tmatched AS (SELECT l.db, l.tbl, l.col, l.policy_id FROM tl l JOIN tn USING (policy_id) WHERE l.hit
             GROUP BY l.db, l.tbl, l.col, l.policy_id, tn.n HAVING count(*) = tn.n),
res_tags AS (SELECT DISTINCT m.db, m.tbl, m.col, b.tag FROM tmatched m
             JOIN (SELECT DISTINCT res_id, tag FROM bindings WHERE service = 'lakehouse') b ON b.res_id = m.policy_id)"""


def _req_cte(body: str) -> str:
    return with_cte(f""",
reqs AS ({fx.requests_sql()}){_tag_sql()}
{body}""")


def resource_tags(spark, sf_dir, res_keys):
    ts = tags.latest_tagsets(tags.read_tagsets(spark, fx.TAGSET_FILE))
    b = tags.tag_bindings(ts).where(F.col("service") == "lakehouse")
    _, _, opts = lake_inputs(spark, sf_dir)
    b = cut_lineage(b, name="bindings")
    m = match_resources(res_keys, RES, LAKE, tags.as_resources(b), opts, "lakehouse", b.count())
    return (m.join(b.select(F.col("res_id").cast("long").alias("policy_id"), "tag").distinct(), "policy_id")
            .select(*RES, "tag").distinct())


@query("tag_resources", lambda: _req_cte("SELECT db, tbl, col, tag FROM res_tags"))
def q_tag_resources(spark, sf_dir):
    _, keys = request_keys(spark, sf_dir)
    return resource_tags(spark, sf_dir, cut_lineage(keys.select(*RES).distinct(), name="resources"))


@query("resource_tag_join", lambda: _req_cte(
    "SELECT r.request_id, r.db, r.tbl, r.col, t.tag FROM reqs r JOIN res_tags t USING (db, tbl, col)"))
def q_resource_tag_join(spark, sf_dir):
    reqs, keys = request_keys(spark, sf_dir)
    rt = resource_tags(spark, sf_dir, cut_lineage(keys.select(*RES).distinct(), name="resources"))
    # one row per resource, so the requests are not multiplied before they leave the join
    lists = cut_lineage(rt.groupBy(*RES).agg(F.collect_set("tag").alias("tags")), name="resource_tags")
    return access.decide_requests(reqs, RES, lists).select("request_id", *RES, F.explode("tags").alias("tag"))


TAG_LEVELS = [("tag", "tag")]


@query("tag_policy_access", lambda: _req_cte(f""",
{principals_sql('reqs')},
{decide_sql('reqs')},
tkeys2 AS (SELECT DISTINCT r."user", r.access, t.tag FROM reqs r JOIN res_tags t USING (db, tbl, col)),
{decide_sql('tkeys2', levels=TAG_LEVELS, service='tags', prefix='t_')},
tag_dec AS (
  SELECT r.request_id, max(CASE WHEN d.decision = 'DENY' THEN 2 WHEN d.decision = 'ALLOW' THEN 1 ELSE 0 END) AS tv
  FROM reqs r JOIN res_tags t USING (db, tbl, col) JOIN t_decisions d ON d."user" = r."user" AND d.access = r.access
   AND d.tag = t.tag GROUP BY r.request_id
)
SELECT r.request_id, d.decision AS resource_decision,
       CASE coalesce(td.tv, 0) WHEN 2 THEN 'DENY' WHEN 1 THEN 'ALLOW' ELSE 'NOT_DETERMINED' END AS tag_decision,
       CASE WHEN coalesce(td.tv, 0) = 2 THEN 'DENY' WHEN d.decision = 'DENY' THEN 'DENY'
            WHEN coalesce(td.tv, 0) = 1 OR d.decision = 'ALLOW' THEN 'ALLOW' ELSE 'NOT_DETERMINED' END AS decision
FROM reqs r JOIN decisions d USING ("user", access, db, tbl, col) LEFT JOIN tag_dec td USING (request_id)
"""))
def q_tag_policy_access(spark, sf_dir):
    """GOV-13: tag policies first (deny wins), then resource policies, both decided in the row of the key."""
    reqs, keys = request_keys(spark, sf_dir)
    keys = cut_lineage(keys, name="keys")
    asked = cut_lineage(keys.select(*RES, "access").distinct(), name="asked")
    own, of_tags = service_index(spark, sf_dir, "lakehouse"), service_index(spark, sf_dir, "tags")
    lists = access.access_lists(asked, RES, LAKE, own["index"], own["bound"])
    tagged = cut_lineage(asked.join(resource_tags(spark, sf_dir, asked.select(*RES).distinct()), RES), name="tagged")
    tag_lists = access.access_lists(tagged.select("tag", "access").distinct(), ["tag"], {"tag": "tag"}, of_tags["index"],
                                    of_tags["bound"]).withColumnRenamed("policies", "said")
    by_tag = tagged.join(tag_lists, ["tag", "access"]).groupBy(*RES, "access").agg(F.collect_list("said").alias("tagged"))
    both = lists.join(by_tag, [*RES, "access"], "full")
    long = [x for x in (own["long_items"], of_tags["long_items"]) if x is not None]
    full = access.with_principals(keys.join(both, [*RES, "access"], "left"), principals_of(spark, sf_dir, keys),
                                  long[0].unionByName(long[-1]) if long else None)
    by = F.transform("tagged", lambda p: access.verdict(access.judge(p))["decision"])
    found = full.withColumn("by_tag", F.coalesce(by, F.array().cast("array<string>"))).withColumn(
        "r", access.verdict(F.coalesce(access.judge(F.col("policies")), F.array()))["decision"])
    tag_decision = (F.when(F.array_contains("by_tag", "DENY"), "DENY").when(F.array_contains("by_tag", "ALLOW"), "ALLOW")
                    .otherwise("NOT_DETERMINED"))
    dec = cut_lineage(found.select(*KEY, F.col("r").alias("resource_decision"), tag_decision.alias("tag_decision")).withColumn(
        "decision", F.when((F.col("tag_decision") == "DENY") | (F.col("resource_decision") == "DENY"), "DENY")
        .when((F.col("tag_decision") == "ALLOW") | (F.col("resource_decision") == "ALLOW"), "ALLOW")
        .otherwise("NOT_DETERMINED")), name="decisions")
    return access.decide_requests(reqs, KEY, dec).select("request_id", "resource_decision", "tag_decision", "decision")


# --- GOV-14: policy version diff -------------------------------------------

_ELEMENT = POLICY_TYPE.removesuffix("[]")


def _order_policies_sql(previous: bool) -> str:
    """Policies of the orders as full documents, written apart from the Spark rule."""
    def item(accesses, users, groups, delegate):
        return (f"{{'accesses': {accesses}, 'users': {users}, 'groups': {groups}, 'roles': []::VARCHAR[], "
                f"'conditions': []::VARCHAR[], 'delegateAdmin': {delegate}}}")
    acc = lambda *names: "[" + ", ".join(f"{{'type': '{n}', 'isAllowed': true}}" for n in names) + "]"
    path = "'/orders/' || CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR)"
    paths, allowed, deny = f"[{path}]", f"CASE WHEN o_orderstatus = 'O' THEN {acc('read', 'write')} ELSE {acc('read')} END", (
        "CASE WHEN o_totalprice > 300000 THEN [" + item(acc("write"), "[]::VARCHAR[]", "['public']", "false") + "] ELSE [] END")
    if previous:
        paths = f"CASE WHEN o_orderpriority = '5-LOW' THEN [{path}, '/tmp/orders/' || CAST(o_orderkey AS VARCHAR)] ELSE [{path}] END"
        allowed, deny = acc("read", "write"), "[]"
    return f"""SELECT CAST({{'id': o_orderkey + 1000000, 'guid': 'ord-' || CAST(o_orderkey AS VARCHAR), 'service': 'objectstore',
  'name': 'order ' || CAST(o_orderkey AS VARCHAR), 'policyType': 0, 'policyPriority': 0, 'description': '',
  'isAuditEnabled': o_orderpriority IN ('1-URGENT', '2-HIGH'), 'isEnabled': o_orderstatus <> 'P', 'version': {1 if previous else 2},
  'serviceType': 'objectstore', 'isDenyAllElse': false, 'policyLabels': []::VARCHAR[],
  'resources': MAP {{'path': {{'values': {paths}, 'isExcludes': false, 'isRecursive': true}}}},
  'policyItems': [{item(allowed, "['u' || CAST(o_custkey AS VARCHAR)]", "[]::VARCHAR[]", "o_orderpriority = '1-URGENT'")}],
  'denyPolicyItems': {deny}, 'allowExceptions': [], 'denyExceptions': [], 'dataMaskPolicyItems': [],
  'rowFilterPolicyItems': []}} AS {_ELEMENT}) AS p FROM orders"""


def _facts_sql(src: str) -> str:
    heads = " UNION ALL ".join(f"SELECT p.guid, '{c}', CAST(p.\"{c}\" AS VARCHAR), false FROM {src}" for c in pol.HEADER_FIELDS)

    def items(kind, col):
        told = {"mask": ", it.dataMaskInfo.dataMaskType, it.dataMaskInfo.valueExpr, it.dataMaskInfo.conditionExpr",
                "row_filter": ", it.rowFilterInfo.filterExpr"}.get(kind, "")
        rows = f"(SELECT p.guid AS guid, unnest(p.{col}) AS it FROM {src})"
        pr = """LATERAL (SELECT 'user:' || unnest(it.users) AS who UNION ALL SELECT 'group:' || unnest(it."groups")
                         UNION ALL SELECT 'role:' || unnest(it.roles)) pr"""
        return f"""
  SELECT guid, '{kind}', concat_ws(' ', who, CASE WHEN coalesce(a.isAllowed, true) THEN a."type" ELSE 'not ' || a."type" END{told}), true
  FROM {rows} x, {pr}, LATERAL (SELECT unnest(it.accesses) AS a) ac
  UNION ALL SELECT guid, '{kind}.delegateAdmin', who, true FROM {rows} x, {pr} WHERE it.delegateAdmin AND len(it.accesses) > 0
  UNION ALL SELECT guid, '{kind}.conditions', unnest(it.conditions), true FROM {rows} x"""
    return f"""SELECT DISTINCT * FROM (
  SELECT NULL::VARCHAR AS guid, NULL::VARCHAR AS path, NULL::VARCHAR AS value, NULL::BOOLEAN AS many WHERE false
  UNION ALL {heads}
  UNION ALL SELECT p.guid, 'policyLabels', unnest(p.policyLabels), true FROM {src}
  UNION ALL SELECT guid, 'resources.' || e.key || '.values', unnest(e.value."values"), true
    FROM (SELECT p.guid AS guid, unnest(map_entries(p."resources")) AS e FROM {src})
  UNION ALL SELECT guid, 'resources.' || e.key || '.isExcludes', CAST(coalesce(e.value.isExcludes, false) AS VARCHAR), false
    FROM (SELECT p.guid AS guid, unnest(map_entries(p."resources")) AS e FROM {src})
  UNION ALL SELECT guid, 'resources.' || e.key || '.isRecursive', CAST(coalesce(e.value.isRecursive, false) AS VARCHAR), false
    FROM (SELECT p.guid AS guid, unnest(map_entries(p."resources")) AS e FROM {src})
  UNION ALL {" UNION ALL ".join(items(k, c) for k, c in pol.ITEM_LISTS)}) WHERE value IS NOT NULL"""


@query("policy_version_diff", lambda: f"""
WITH prev AS (SELECT unnest(policies) AS p FROM read_json('{fx.PREV_POLICY_FILE}', columns={{'policies': '{POLICY_TYPE}'}})
              UNION ALL {_order_policies_sql(True)}),
cur AS (SELECT unnest(policies) AS p FROM read_json('{fx.POLICY_FILE}', columns={{'policies': '{POLICY_TYPE}'}})
        UNION ALL {_order_policies_sql(False)}),
pf AS ({_facts_sql('prev')}), cf AS ({_facts_sql('cur')}),
differ AS (
  SELECT coalesce(a.guid, b.guid) AS guid, coalesce(a.path, b.path) AS path, a.value AS previous_value, b.value AS current_value
  FROM pf a FULL JOIN cf b ON a.guid = b.guid AND a.path = b.path AND (CASE WHEN a.many THEN a.value ELSE '' END) = (CASE WHEN b.many THEN b.value ELSE '' END)
  WHERE a.value IS DISTINCT FROM b.value)
SELECT d.*, CASE WHEN d.guid NOT IN (SELECT p.guid FROM prev) THEN 'new_policy'
                 WHEN d.guid NOT IN (SELECT p.guid FROM cur) THEN 'dropped_policy' ELSE 'changed' END AS policy_change
FROM differ d
""")
def q_policy_version_diff(spark, sf_dir):
    orders = scan_parquet(spark, sf_dir, "orders")
    previous = pol.read_export(spark, fx.PREV_POLICY_FILE).unionByName(pol.order_policies(orders, previous=True))
    current = pol.read_export(spark, fx.POLICY_FILE).unionByName(pol.order_policies(orders))
    return pol.policy_version_diff(previous, current)
