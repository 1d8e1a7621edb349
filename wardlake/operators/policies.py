"""Policies as data: explicit schemas, readers and the normalized tables.

Two normalized tables come out of any mix of v2 exports and v1 REST shapes:

* ``policy_resources(policy_id, service, level, pattern, excludes, recursive)``
* ``policy_items(policy_id, service, policy_type, priority, is_enabled,
  is_audit_enabled, deny_all_else, item_kind, item_no, principal_kind,
  principal, access, is_allowed, delegate_admin, mask_type, condition_expr,
  value_expr, filter_expr)``

``item_kind`` is one of allow, deny, allow_exception, deny_exception, mask,
row_filter. Everything is ``explode``/``transform`` on columns: no policy is
ever handled one at a time on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.operators.joins import once

# The field names of the policy documents, as they are stored.
ACCESS = T.StructType([T.StructField("type", T.StringType()), T.StructField("isAllowed", T.BooleanType())])
_ITEM_FIELDS = [
    T.StructField("accesses", T.ArrayType(ACCESS)),
    T.StructField("users", T.ArrayType(T.StringType())),
    T.StructField("groups", T.ArrayType(T.StringType())),
    T.StructField("roles", T.ArrayType(T.StringType())),
    T.StructField("conditions", T.ArrayType(T.StringType())),
    T.StructField("delegateAdmin", T.BooleanType()),
]
ITEM = T.StructType(_ITEM_FIELDS)
MASK_INFO = T.StructType([T.StructField("dataMaskType", T.StringType()),
                          T.StructField("conditionExpr", T.StringType()),
                          T.StructField("valueExpr", T.StringType())])
MASK_ITEM = T.StructType(_ITEM_FIELDS + [T.StructField("dataMaskInfo", MASK_INFO)])
FILTER_ITEM = T.StructType(_ITEM_FIELDS + [T.StructField(
    "rowFilterInfo", T.StructType([T.StructField("filterExpr", T.StringType())]))])
RESOURCE = T.StructType([T.StructField("values", T.ArrayType(T.StringType())),
                         T.StructField("isExcludes", T.BooleanType()),
                         T.StructField("isRecursive", T.BooleanType())])
POLICY = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("guid", T.StringType()),
    T.StructField("service", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("policyType", T.IntegerType()), T.StructField("policyPriority", T.IntegerType()),
    T.StructField("description", T.StringType()), T.StructField("isAuditEnabled", T.BooleanType()),
    T.StructField("isEnabled", T.BooleanType()), T.StructField("version", T.IntegerType()),
    T.StructField("serviceType", T.StringType()), T.StructField("isDenyAllElse", T.BooleanType()),
    T.StructField("policyLabels", T.ArrayType(T.StringType())),
    T.StructField("resources", T.MapType(T.StringType(), RESOURCE)),
    T.StructField("policyItems", T.ArrayType(ITEM)),
    T.StructField("denyPolicyItems", T.ArrayType(ITEM)),
    T.StructField("allowExceptions", T.ArrayType(ITEM)),
    T.StructField("denyExceptions", T.ArrayType(ITEM)),
    T.StructField("dataMaskPolicyItems", T.ArrayType(MASK_ITEM)),
    T.StructField("rowFilterPolicyItems", T.ArrayType(FILTER_ITEM)),
])
EXPORT = T.StructType([T.StructField("policies", T.ArrayType(POLICY))])

PERM_MAP = T.StructType([T.StructField("userList", T.ArrayType(T.StringType())),
                         T.StructField("groupList", T.ArrayType(T.StringType())),
                         T.StructField("permList", T.ArrayType(T.StringType()))])
# v1 REST shapes (table ACL, path, column family) share one reader schema.
# ``isEnabled`` is read as a string: some files hold "true", others true.
LEGACY = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("policyName", T.StringType()),
    T.StructField("databases", T.StringType()), T.StructField("tables", T.StringType()),
    T.StructField("columns", T.StringType()), T.StructField("columnFamilies", T.StringType()),
    T.StructField("udfs", T.StringType()), T.StructField("resourceName", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("repositoryName", T.StringType()),
    T.StructField("repositoryType", T.StringType()), T.StructField("tableType", T.StringType()),
    T.StructField("columnType", T.StringType()), T.StructField("isEnabled", T.StringType()),
    T.StructField("isAuditEnabled", T.StringType()), T.StructField("isRecursive", T.BooleanType()),
    T.StructField("permMapList", T.ArrayType(PERM_MAP)),
])

SERVICEDEF = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("resources", T.ArrayType(T.StructType([
        T.StructField("itemId", T.IntegerType()), T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()), T.StructField("level", T.IntegerType()),
        T.StructField("parent", T.StringType()), T.StructField("mandatory", T.BooleanType()),
        T.StructField("recursiveSupported", T.BooleanType()),
        T.StructField("excludesSupported", T.BooleanType()),
        T.StructField("matcherOptions", T.StructType([
            T.StructField("wildCard", T.BooleanType()), T.StructField("ignoreCase", T.BooleanType())])),
    ]))),
    T.StructField("accessTypes", T.ArrayType(T.StructType([
        T.StructField("itemId", T.IntegerType()), T.StructField("name", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("impliedGrants", T.ArrayType(T.StringType())),
    ]))),
])


# ---------------------------------------------------------------------------
# Readers (SRC-07)
# ---------------------------------------------------------------------------

def read_export(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Policy export documents ``{"policies": [...]}`` -> one row per policy.

    A single pretty-printed export is read with ``multiLine`` (one document
    per file); a large store is kept as JSON Lines (one export per line),
    which splits across tasks. A malformed document raises: a lost policy
    could be a lost deny.
    """
    docs = spark.read.schema(EXPORT).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    return docs.select(F.explode("policies").alias("p")).select("p.*")


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEGACY).option("mode", "FAILFAST").json(path)


def read_servicedefs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERVICEDEF).option("mode", "FAILFAST").json(path)


# ---------------------------------------------------------------------------
# GOV-01 normalize
# ---------------------------------------------------------------------------

def _null_s():
    return F.lit(None).cast("string")


def _unify(kind: str, it: Column, idx: Column, mask: bool = False, rf: bool = False) -> Column:
    return F.struct(
        F.lit(kind).alias("item_kind"), idx.alias("item_no"),
        it["accesses"].alias("accesses"), it["users"].alias("users"), it["groups"].alias("groups"),
        it["roles"].alias("roles"), F.coalesce(it["delegateAdmin"], F.lit(False)).alias("delegate_admin"),
        (it["dataMaskInfo"]["dataMaskType"] if mask else _null_s()).alias("mask_type"),
        (it["dataMaskInfo"]["conditionExpr"] if mask else _null_s()).alias("condition_expr"),
        (it["dataMaskInfo"]["valueExpr"] if mask else _null_s()).alias("value_expr"),
        (it["rowFilterInfo"]["filterExpr"] if rf else _null_s()).alias("filter_expr"),
    )


def _binder(kind: str, m: bool, r: bool):
    def fn(it, i):
        return _unify(kind, it, i, m, r)
    return fn


def _items_array(p: DataFrame) -> Column:
    parts = []
    for kind, col, m, r in (("allow", "policyItems", False, False), ("deny", "denyPolicyItems", False, False),
                            ("allow_exception", "allowExceptions", False, False),
                            ("deny_exception", "denyExceptions", False, False),
                            ("mask", "dataMaskPolicyItems", True, False),
                            ("row_filter", "rowFilterPolicyItems", False, True)):
        parts.append(F.transform(F.coalesce(F.col(col), F.array()), _binder(kind, m, r)))
    return F.concat(*parts)


def _principals(users: Column, groups: Column, roles: Column) -> Column:
    def tag(arr, kind):
        return F.transform(F.coalesce(arr, F.array().cast("array<string>")),
                           lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("name")))
    return F.concat(tag(users, "user"), tag(groups, "group"), tag(roles, "role"))


HEADER_COLS = ["policy_id", "service", "policy_type", "priority", "is_enabled", "is_audit_enabled",
               "deny_all_else"]


def _v2_header(p: DataFrame) -> list[Column]:
    return [F.col("id").alias("policy_id"), F.col("service"),
            F.coalesce("policyType", F.lit(0)).alias("policy_type"),
            F.coalesce("policyPriority", F.lit(0)).alias("priority"),
            F.coalesce("isEnabled", F.lit(True)).alias("is_enabled"),
            F.coalesce("isAuditEnabled", F.lit(True)).alias("is_audit_enabled"),
            F.coalesce("isDenyAllElse", F.lit(False)).alias("deny_all_else")]


def _flatten_items(df: DataFrame) -> DataFrame:
    """(header..., it) -> one row per (item, principal, access).

    A policy without items, and an item without principals or accesses, keeps one row with NULL in their columns:
    its header still decides (``deny_all_else``).
    """
    return (
        df.select(*HEADER_COLS, F.explode_outer("_items").alias("it"))
        .select(*HEADER_COLS, "it.item_kind", "it.item_no", "it.delegate_admin", "it.mask_type",
                "it.condition_expr", "it.value_expr", "it.filter_expr",
                F.explode_outer(_principals(F.col("it.users"), F.col("it.groups"), F.col("it.roles"))).alias("pr"),
                F.col("it.accesses").alias("accesses"))
        .select(*HEADER_COLS, "item_kind", "item_no", F.col("pr.kind").alias("principal_kind"),
                F.col("pr.name").alias("principal"), F.explode_outer("accesses").alias("acc"),
                "delegate_admin", "mask_type", "condition_expr", "value_expr", "filter_expr")
        .select(*HEADER_COLS, "item_kind", "item_no", "principal_kind", "principal",
                F.col("acc.type").alias("access"), F.when(F.col("acc").isNotNull(), F.coalesce("acc.isAllowed", F.lit(True))).alias("is_allowed"),
                "delegate_admin", "mask_type", "condition_expr", "value_expr", "filter_expr")
    )


def v2_items(policies: DataFrame) -> DataFrame:
    return _flatten_items(policies.select(*_v2_header(policies), _items_array(policies).alias("_items")))


def v2_resources(policies: DataFrame) -> DataFrame:
    return (
        policies.select(F.col("id").alias("policy_id"), "service", F.explode("resources").alias("level", "r"))
        .select("policy_id", "service", "level", F.explode("r.values").alias("pattern"),
                F.coalesce("r.isExcludes", F.lit(False)).alias("excludes"),
                F.coalesce("r.isRecursive", F.lit(False)).alias("recursive"))
    )


def _split_list(c: str) -> Column:
    return F.filter(F.transform(F.split(F.col(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def legacy_resources(legacy: DataFrame) -> DataFrame:
    """v1 table / path / column-family shapes -> policy_resources rows."""
    levels = F.array(
        F.struct(F.lit("database").alias("level"), _split_list("databases").alias("vals"), F.lit(False).alias("ex")),
        F.struct(F.lit("table").alias("level"), _split_list("tables").alias("vals"),
                 (F.lower("tableType") == "exclusion").alias("ex")),
        F.struct(F.lit("column-family").alias("level"), _split_list("columnFamilies").alias("vals"), F.lit(False).alias("ex")),
        F.struct(F.lit("column").alias("level"), _split_list("columns").alias("vals"),
                 (F.lower("columnType") == "exclusion").alias("ex")),
        F.struct(F.lit("udf").alias("level"), _split_list("udfs").alias("vals"), F.lit(False).alias("ex")),
        F.struct(F.lit("path").alias("level"), _split_list("resourceName").alias("vals"), F.lit(False).alias("ex")),
    )
    return (
        legacy.select(F.col("id").alias("policy_id"), F.col("repositoryName").alias("service"),
                      F.coalesce("isRecursive", F.lit(False)).alias("rec"), F.explode(levels).alias("l"))
        .where(F.size("l.vals") > 0)
        .select("policy_id", "service", F.col("l.level").alias("level"), F.explode("l.vals").alias("pattern"),
                F.coalesce("l.ex", F.lit(False)).alias("excludes"), "rec")
        .select("policy_id", "service", "level", "pattern", "excludes",
                (F.col("rec") & (F.col("level") == "path")).alias("recursive"))
    )


def legacy_items(legacy: DataFrame) -> DataFrame:
    """permMapList[userList, groupList, permList] -> allow items."""
    items = F.transform(F.coalesce("permMapList", F.array()), lambda pm, i: F.struct(
        F.lit("allow").alias("item_kind"), i.alias("item_no"),
        F.transform(F.coalesce(pm["permList"], F.array().cast("array<string>")),
                    lambda a: F.struct(a.alias("type"), F.lit(True).alias("isAllowed"))).alias("accesses"),
        pm["userList"].alias("users"), pm["groupList"].alias("groups"),
        F.array().cast("array<string>").alias("roles"), F.lit(False).alias("delegate_admin"),
        _null_s().alias("mask_type"), _null_s().alias("condition_expr"), _null_s().alias("value_expr"),
        _null_s().alias("filter_expr")))
    head = [F.col("id").alias("policy_id"), F.col("repositoryName").alias("service"),
            F.lit(0).alias("policy_type"), F.lit(0).alias("priority"),
            F.coalesce(F.lower(F.trim("isEnabled")) == "true", F.lit(False)).alias("is_enabled"),
            F.coalesce(F.lower(F.trim("isAuditEnabled")) == "true", F.lit(False)).alias("is_audit_enabled"),
            F.lit(False).alias("deny_all_else")]
    return _flatten_items(legacy.select(*head, items.alias("_items")))


# ---------------------------------------------------------------------------
# GOV-02 implied grants, GOV-20 delegate admin
# ---------------------------------------------------------------------------

def implied_grants(servicedefs: DataFrame) -> DataFrame:
    """(service, access, granted): every access grants itself plus its implied list."""
    at = servicedefs.select(F.col("name").alias("service"), F.explode("accessTypes").alias("a"))
    return at.select("service", F.col("a.name").alias("access"),
                     F.explode(F.array_union(F.array(F.col("a.name")),
                                             F.coalesce("a.impliedGrants", F.array().cast("array<string>"))))
                     .alias("granted"))


def expand_implied(items: DataFrame, grants: DataFrame) -> DataFrame:
    """Replace ``access`` by every access it grants (``all`` -> select, ...).

    ``grants`` is bounded by the service definitions (a few dozen rows):
    broadcast. Accesses unknown to the definition are kept as they are.
    """
    g = F.broadcast(grants.withColumnRenamed("access", "_a").withColumnRenamed("service", "_s"))
    j = items.join(g, (items.service == g._s) & (items.access == g._a), "left")
    return j.withColumn("access", F.coalesce("granted", "access")).drop("_a", "_s", "granted")


def delegate_admins(items: DataFrame) -> DataFrame:
    return (items.where("delegate_admin AND item_kind = 'allow' AND is_enabled AND principal IS NOT NULL")
            .select("policy_id", "service", "principal_kind", "principal").distinct())


# ---------------------------------------------------------------------------
# GOV-14 structural diff
# ---------------------------------------------------------------------------

# The header fields of a policy document, and its lists of items.
HEADER_FIELDS = ["id", "service", "name", "policyType", "policyPriority", "description", "isAuditEnabled", "isEnabled",
                 "version", "serviceType", "isDenyAllElse"]
ITEM_LISTS = [("allow", "policyItems"), ("deny", "denyPolicyItems"), ("allow_exception", "allowExceptions"),
              ("deny_exception", "denyExceptions"), ("mask", "dataMaskPolicyItems"), ("row_filter", "rowFilterPolicyItems")]


FACT = "struct<path:string,value:string,many:boolean>"


def _fact_list(p: DataFrame) -> Column:
    """Everything a policy document says, as an array of facts (path, value, many), without repeats."""
    def fact(path, value, many):
        path = path if isinstance(path, Column) else F.lit(path)
        return F.struct(path.alias("path"), value.cast("string").alias("value"), F.lit(many).alias("many"))

    none = F.array().cast(f"array<{FACT}>")
    heads = F.array(*[fact(c, F.col(c), False) for c in HEADER_FIELDS])
    labels = F.transform("policyLabels", lambda x: fact("policyLabels", x, True))
    levels = F.flatten(F.transform(F.map_entries("resources"), lambda e: F.concat(
        F.coalesce(F.transform(e["value"]["values"], lambda v: fact(F.concat(F.lit("resources."), e["key"], F.lit(".values")), v, True)), none),
        F.array(fact(F.concat(F.lit("resources."), e["key"], F.lit(".isExcludes")), F.coalesce(e["value"]["isExcludes"], F.lit(False)), False),
                fact(F.concat(F.lit("resources."), e["key"], F.lit(".isRecursive")), F.coalesce(e["value"]["isRecursive"], F.lit(False)), False)))))
    lists = [F.flatten(F.transform(F.col(c), _item_facts(kind, fact))) for kind, c in ITEM_LISTS]
    said = F.concat(*[F.coalesce(x, none) for x in [heads, labels, levels, *lists]])
    return F.filter(said, lambda f: f["value"].isNotNull())


def _item_facts(kind, fact):
    """The conditions of an item and, for each principal, its accesses with what goes with them, and delegation."""
    def of(it):
        told = {"mask": [it["dataMaskInfo"][c] for c in ("dataMaskType", "valueExpr", "conditionExpr")],
                "row_filter": [it["rowFilterInfo"]["filterExpr"]]} if kind in ("mask", "row_filter") else {}
        accesses = F.filter(F.coalesce(it["accesses"], F.array().cast(T.ArrayType(ACCESS))), lambda a: a["type"].isNotNull())

        def says(who):
            def grant(a):
                allowed = F.coalesce(a["isAllowed"], F.lit(True))
                text = F.when(allowed, a["type"]).otherwise(F.concat(F.lit("not "), a["type"]))
                return fact(kind, F.concat_ws(" ", who, text, *told.get(kind, [])), True)
            delegated = F.when(F.coalesce(it["delegateAdmin"], F.lit(False)) & (F.size(accesses) > 0), who)
            return F.concat(F.transform(accesses, grant), F.array(fact(f"{kind}.delegateAdmin", delegated, True)))

        named = F.filter(_principals(it["users"], it["groups"], it["roles"]), lambda p: p["name"].isNotNull())
        conditions = F.transform(F.coalesce(it["conditions"], F.array().cast("array<string>")),
                                 lambda x: fact(f"{kind}.conditions", x, True))
        return F.concat(conditions, F.flatten(F.transform(named, lambda p: says(F.concat_ws(":", p["kind"], p["name"])))))
    return of


def policy_facts(policies: DataFrame) -> DataFrame:
    """(guid, path, value, many): everything a policy document says, one short row each.

    A header field or a flag of a resource level has one value; labels, patterns, grants, masks, filters and
    conditions are sets (``many``). Fields that are absent give no row.
    """
    return policies.select("guid", F.explode(_fact_list(policies)).alias("f")).select("guid", "f.*").distinct()


def _key(f: Column) -> Column:
    """A fact as text that no other fact shares: lists of texts are compared by hash, lists of structs pair by pair."""
    return F.concat(F.length(f["path"]).cast("string"), F.lit(":"), f["path"], f["value"])


def policy_version_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(guid, path, previous_value, current_value, policy_change): where two exports of a store differ.

    The facts of a policy stay one list, and both exports meet in one shuffle by guid, where the lists are compared in
    the row: a field that changed is one row with both values, a member of a set that came or went is a row with one.
    policy_change tells whether the whole policy is new, dropped or changed.
    """
    def told(df, name):
        return df.where("guid IS NOT NULL").select("guid", _fact_list(df).alias(name))
    both = told(previous, "was").unionByName(told(current, "is"), allowMissingColumns=True)
    met = both.groupBy("guid").agg(F.collect_list("was").alias("was"), F.collect_list("is").alias("is"))
    change = F.when(F.size("was") == 0, "new_policy").when(F.size("is") == 0, "dropped_policy").otherwise("changed")
    # one document on each side has one value for a field, so what both say makes no row; several may say two
    single = (F.size("was") <= 1) & (F.size("is") <= 1)
    flat = once(met.select("guid", change.alias("policy_change"), single.alias("single"), "was", "is"), "said", F.struct(
        F.flatten("was").alias("was"), F.flatten("is").alias("is")))
    keyed = once(flat.select("guid", "policy_change", "single", "said.*"), "keys", F.struct(
        F.transform("was", _key).alias("was"), F.transform("is", _key).alias("is")))
    apart = once(keyed, "only", F.struct(F.array_except("keys.was", "keys.is").alias("was"), F.array_except("keys.is", "keys.was").alias("is")))

    def left(s):
        mine = F.filter(F.arrays_zip(F.col(s).alias("f"), F.col(f"keys.{s}").alias("k")), lambda x: F.array_contains(f"only.{s}", x["k"]))
        return F.array_distinct(F.when(F.col("single") & (F.size(f"only.{s}") == 0), F.array().cast(f"array<{FACT}>"))
                                .when(F.col("single"), F.transform(mine, lambda x: x["f"])).otherwise(F.col(s))).alias(s)
    some = once(apart, "left", F.struct(left("was"), left("is"))).select("guid", "policy_change", "left.*")
    rows = some.withColumn("f", F.explode(_differences(F.col("was"), F.col("is"))))
    return rows.select("guid", "f.path", "f.previous_value", "f.current_value", "policy_change")


def _differences(was: Column, now: Column) -> Column:
    """(path, previous_value, current_value) of the facts that do not meet, or meet with another value."""
    def row(path, a, b):
        return F.struct(path.alias("path"), a.alias("previous_value"), b.alias("current_value"))

    def meets(f, g):
        return (f["path"] == g["path"]) & (f["many"] == g["many"]) & (~f["many"] | (f["value"] == g["value"]))
    null = F.lit(None).cast("string")
    changed = F.flatten(F.transform(was, lambda f: F.transform(
        F.filter(now, lambda g: meets(f, g) & (f["value"] != g["value"])), lambda g: row(f["path"], f["value"], g["value"]))))
    gone = F.transform(F.filter(was, lambda f: ~F.exists(now, lambda g: meets(f, g))), lambda f: row(f["path"], f["value"], null))
    come = F.transform(F.filter(now, lambda g: ~F.exists(was, lambda f: meets(f, g))), lambda g: row(g["path"], null, g["value"]))
    return F.concat(changed, gone, come)


def ignore_case_levels(servicedefs: DataFrame) -> DataFrame:
    """(service, level, ignore_case, recursive_supported) from the matcher options."""
    return (servicedefs.select(F.col("name").alias("service"), F.explode("resources").alias("r"))
            .select("service", F.col("r.name").alias("level"),
                    F.coalesce("r.matcherOptions.ignoreCase", F.lit(False)).alias("ignore_case"),
                    F.coalesce("r.recursiveSupported", F.lit(False)).alias("recursive_supported")))


# ---------------------------------------------------------------------------
# Derived policy store: one object-store policy per order (scales with data)
# ---------------------------------------------------------------------------

ORDER_POLICY_OFFSET = 1_000_000


def order_policies(orders: DataFrame, previous: bool = False) -> DataFrame:
    """A policy per order, in the v2 shape (see README for the rule).

    ``previous=True`` gives the earlier export of the same store: read and
    write for every owner, no deny items, version 1, a second path for some.
    """
    acc = lambda t: F.struct(F.lit(t).alias("type"), F.lit(True).alias("isAllowed"))
    accesses = F.when(F.col("o_orderstatus") == "O", F.array(acc("read"), acc("write"))).otherwise(F.array(acc("read")))
    if previous:
        accesses = F.array(acc("read"), acc("write"))
    empty = F.array().cast("array<string>")
    allow = F.array(F.struct(accesses.alias("accesses"),
                             F.array(F.concat(F.lit("u"), F.col("o_custkey").cast("string"))).alias("users"),
                             empty.alias("groups"), empty.alias("roles"), empty.alias("conditions"),
                             (F.col("o_orderpriority") == "1-URGENT").alias("delegateAdmin")))
    deny = F.when(F.col("o_totalprice") > 300000, F.array(F.struct(
        F.array(acc("write")).alias("accesses"), empty.alias("users"), F.array(F.lit("public")).alias("groups"),
        empty.alias("roles"), empty.alias("conditions"), F.lit(False).alias("delegateAdmin")))
    ).otherwise(F.array().cast(T.ArrayType(ITEM)))
    if previous:
        deny = F.array().cast(T.ArrayType(ITEM))
    path = F.concat(F.lit("/orders/"), F.year("o_orderdate").cast("string"), F.lit("/"),
                    F.col("o_orderkey").cast("string"))
    # the earlier export also covered a scratch folder of low orders
    scratch = F.concat(F.lit("/tmp/orders/"), F.col("o_orderkey").cast("string"))
    paths = F.when(F.lit(previous) & (F.col("o_orderpriority") == "5-LOW"), F.array(path, scratch)).otherwise(F.array(path))
    res = F.create_map(F.lit("path"), F.struct(paths.alias("values"), F.lit(False).alias("isExcludes"),
                                               F.lit(True).alias("isRecursive")))
    none_items = F.array().cast(T.ArrayType(ITEM))
    return orders.select(
        (F.col("o_orderkey") + F.lit(ORDER_POLICY_OFFSET)).alias("id"),
        F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("guid"),
        F.lit("objectstore").alias("service"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.lit(0).alias("policyType"), F.lit(0).alias("policyPriority"), F.lit("").alias("description"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("isAuditEnabled"),
        (F.col("o_orderstatus") != "P").alias("isEnabled"), F.lit(1 if previous else 2).alias("version"),
        F.lit("objectstore").alias("serviceType"), F.lit(False).alias("isDenyAllElse"),
        empty.alias("policyLabels"), res.alias("resources"), allow.alias("policyItems"),
        deny.alias("denyPolicyItems"), none_items.alias("allowExceptions"), none_items.alias("denyExceptions"),
        F.array().cast(T.ArrayType(MASK_ITEM)).alias("dataMaskPolicyItems"),
        F.array().cast(T.ArrayType(FILTER_ITEM)).alias("rowFilterPolicyItems"),
    )
