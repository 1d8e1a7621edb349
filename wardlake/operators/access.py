"""Access decisions (GOV-07, GOV-08, GOV-16...): lists of policies per resource, decided inside the row.

Decision rule (frozen in tests/test_decide_truth_table.py):

* only enabled access policies (type 0) whose resources fit take part;
* in a policy, an allow item fits when the principal (user, one of the user's groups, ``public``, or a role of those
  groups) and the access fit, unless an allow exception fits too; deny items and deny exceptions the same;
* ``isDenyAllElse``: a fitting policy that does not allow, denies;
* override policies (priority > 0) are decided first: deny, then allow; then normal policies: deny beats allow;
  nothing fits -> NOT_DETERMINED, which is not an allow.

``policy_index`` turns the normalized tables into one row per policy with its patterns and items. The distinct
(resource, access) of the requests meet it once (``access_lists``), which gives each of them the short list of
policies that may decide it, with the principals they name. A key (user, access, resource) then takes the list of its
resource and the principals of its user by two joins and is decided in the row: there is no further join or
aggregate, and nothing is as large as keys x policies x items.

Lists of principals longer than ``LONG_LIST`` stay out of the rows: they are joined with the users instead, and a
key learns which of those lists hold its user (``long_lists``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.operators.joins import sized_join
from wardlake.operators.matching import USER_MACRO, covers_for, match_index, pattern_rows
from wardlake.session import cut_lineage

ACCESS_KINDS = ["allow", "deny", "allow_exception", "deny_exception"]
LONG_LIST = 512
_DETAILS = ["mask_type", "value_expr", "condition_expr", "filter_expr"]


def user_tags(users: DataFrame, members: DataFrame, role_members: DataFrame) -> DataFrame:
    """(user, who): what each user is, as tags ``kind:name``: itself, the group ``public``, its groups and their roles.

    One list per user, as long as its memberships; the roles of a group are joined as one list per group.
    """
    def tagged(kind, names):
        return F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda x: F.concat(F.lit(f"{kind}:"), x))
    u = users.select("user").distinct()
    roles = role_members.groupBy("grp").agg(F.collect_set("role").alias("roles"))
    m = (members.join(roles, "grp", "left").join(u, "user", "left_semi").groupBy("user")
         .agg(F.collect_set("grp").alias("grps"), F.flatten(F.collect_set("roles")).alias("roles")))
    own = F.array(F.concat(F.lit("user:"), F.col("user")), F.lit("group:public"))
    return u.join(m, "user", "left").select("user", F.array_distinct(F.concat(
        F.when(F.col("user").isNull(), F.array(F.lit("group:public"))).otherwise(own),
        tagged("group", F.col("grps")), tagged("role", F.col("roles")))).alias("who"))


def principals(users: DataFrame, members: DataFrame, role_members: DataFrame) -> DataFrame:
    """(user, principal_kind, principal) for each user: self, public, groups, roles."""
    return user_tags(users, members, role_members).select("user", F.explode("who").alias("t")).select(
        "user", F.substring_index("t", ":", 1).alias("principal_kind"), F.expr("substr(t, locate(':', t) + 1)").alias("principal"))


def _tag(kind: str = "principal_kind", name: str = "principal") -> Column:
    return F.concat_ws(":", kind, name)


EVERYBODY = f"user:{USER_MACRO}"


def long_lists(items: DataFrame) -> DataFrame:
    """(service, policy_id, access, item_kind) of more than LONG_LIST principals: counted in the tasks first."""
    return (items.where(F.col("principal").isNotNull() & F.col("item_kind").isin(ACCESS_KINDS)).groupBy("service", "policy_id", "access", "item_kind").count()
            .where(F.col("count") > LONG_LIST).drop("count"))


def policy_index(items: DataFrame, resources: DataFrame, level_opts: DataFrame | None, long: DataFrame) -> DataFrame:
    """One row per enabled policy that has resources.

    service, policy_id, policy_type, priority, deny_all_else, is_audit_enabled, res (see ``matching.pattern_rows``),
    its: array of (kind, access, principal tag, item_no, mask and filter texts); principal is NULL for a long list.
    """
    one = ["service", "policy_id"]
    details = [F.col(c) if c in items.columns else F.lit(None).cast("string").alias(c) for c in _DETAILS]
    counted = F.col("item_kind").isin(ACCESS_KINDS)
    live = items.where("is_enabled").join(long.withColumn("_long", F.lit(True)),
                                          [*one, "access", "item_kind"], "left")
    it = F.when(F.col("is_allowed") & F.col("principal").isNotNull() & F.col("access").isNotNull(), F.struct(
        F.col("item_kind").alias("kind"), "access", F.when(F.col("_long").isNull(), _tag()).alias("principal"),
        F.when(~counted, F.col("item_no")).alias("item_no"), *details))
    head = F.struct("policy_type", "priority", "deny_all_else", "is_audit_enabled")
    rows = live.select(*one, head.alias("head"), it.alias("it")).unionByName(
        pattern_rows(resources, level_opts).select(*one, "r"), allowMissingColumns=True)
    got = rows.groupBy(*one).agg(F.max("head").alias("head"), F.collect_set("r").alias("res"), F.collect_set("it").alias("its"))
    return got.where(F.col("head").isNotNull() & (F.size("res") > 0)).select(*one, "head.*", "res", "its")


def _entries(asked: DataFrame, level_cols: dict[str, str], index: DataFrame, bound: int | None) -> DataFrame:
    """``asked`` (with access) once per policy that may decide it: ``entry`` holds the principals that it names."""
    pols = index.where(F.col("policy_type") == 0).drop("policy_type", "service")
    met = match_index(asked, level_cols, pols, bound)
    of = lambda k: F.transform(F.filter("_its", lambda x: x["kind"] == k), lambda x: x["principal"])
    macro = "only" in met.columns  # only paths hold the user's macro
    extra = ["only", "unless"] if macro else []
    entry = F.struct("policy_id", "priority", "deny_all_else", "is_audit_enabled",
                     *[of(k).alias(k) for k in ACCESS_KINDS], *extra)
    got = met.withColumn("_its", F.filter("its", lambda x: x["access"] == F.col("access")))
    return got.where((F.size("_its") > 0) | F.col("deny_all_else")).select(*asked.columns, entry.alias("entry"))


def access_lists(asked: DataFrame, res_cols: list[str], level_cols: dict[str, str], index: DataFrame,
                 bound: int | None = None) -> DataFrame:
    """(resource..., access, policies): the policies that may decide the access, each with the principals it names."""
    return (_entries(asked.select(*res_cols, "access"), level_cols, index, bound).groupBy(*res_cols, "access")
            .agg(F.collect_list("entry").alias("policies")))


def path_lists(keys: DataFrame, key_cols: list[str], path_col: str, index: DataFrame, bound: int | None = None) -> DataFrame:
    """``key_cols`` of the distinct ``keys`` with ``policies``, as in ``access_lists``.

    Paths are about as many as keys, so every key asks for itself; a key without policies has an empty list. It takes
    one shuffle, where lists by path would take a distinct of the paths and a join back to the keys besides.
    """
    own = keys.select(*key_cols)
    found = _entries(own, {"path": path_col}, index, bound)
    return found.unionByName(own, allowMissingColumns=True).groupBy(*key_cols).agg(F.collect_list("entry").alias("policies"))


def judge(policies: Column, path: Column | None = None) -> Column:
    """What each policy of the list says of the key: (policy_id, is_audit_enabled, over, a, d and the four item hits).

    ``who`` are the user's tags, ``held`` the long lists that hold the user.
    """
    def say(e):
        def hit(k):
            here = F.coalesce(F.arrays_overlap(F.filter(e[k], lambda x: x.isNotNull()), F.col("who")), F.lit(False))
            long = F.coalesce(F.exists("held", lambda x: (x["policy_id"] == e["policy_id"]) & (x["item_kind"] == k)),
                              F.lit(False))
            return here | long
        return F.struct(e["policy_id"].alias("policy_id"), e["is_audit_enabled"].alias("is_audit_enabled"),
                        (e["priority"] > 0).alias("over"), e["deny_all_else"].alias("else_deny"),
                        *[hit(k).alias(k) for k in ACCESS_KINDS])

    if path is not None:
        policies = F.filter(policies, lambda e: (e["only"].isNull() | covers_for(e["only"], path, F.col("user")))
                            & (e["unless"].isNull() | ~covers_for(e["unless"], path, F.col("user"))))
    said = F.transform(policies, say)

    def allows(s):
        return s["allow"] & ~s["allow_exception"]

    return F.transform(said, lambda s: s.withField("a", allows(s)).withField(
        "d", (s["deny"] & ~s["deny_exception"]) | (s["else_deny"] & ~allows(s))))


def verdict(judged: Column) -> Column:
    """(decision, policy_id, is_audit_enabled) from what the policies say."""
    def first(over, side):
        return F.array_min(F.transform(F.filter(judged, lambda s: (s["over"] == over) & s[side]), lambda s: F.struct(
            s["policy_id"].alias("policy_id"), s["is_audit_enabled"].alias("is_audit_enabled"))))
    sides = [(first(True, "d"), "DENY"), (first(True, "a"), "ALLOW"), (first(False, "d"), "DENY"), (first(False, "a"), "ALLOW")]
    said = F.coalesce(*[F.when(w.isNotNull(), F.lit(name)) for w, name in sides], F.lit("NOT_DETERMINED"))
    win = F.coalesce(*[w for w, _ in sides])
    return F.struct(said.alias("decision"), win["policy_id"].alias("policy_id"), win["is_audit_enabled"].alias("is_audit_enabled"))


def with_principals(keys: DataFrame, who: DataFrame, long_items: DataFrame | None) -> DataFrame:
    """``keys`` with ``who`` (from ``user_tags``) and ``held``. Everybody is the macro for the requesting user."""
    out = keys.join(who, "user", "left").withColumn("who", F.concat(
        F.coalesce("who", F.array().cast("array<string>")), F.array(F.lit(EVERYBODY))))
    if long_items is None:
        return out.withColumn("held", F.lit(None).cast("array<struct<policy_id:bigint,item_kind:string>>"))
    lists = long_items.select("policy_id", "item_kind", "access", _tag().alias("tag")).distinct()
    held = (lists.join(who.select("user", F.explode("who").alias("tag")), "tag").groupBy("user", "access")
            .agg(F.collect_set(F.struct(F.col("policy_id").cast("long").alias("policy_id"), "item_kind")).alias("held")))
    return out.join(held, ["user", "access"], "left")


def judged_keys(keys: DataFrame, key_cols: list[str], level_cols: dict[str, str], index: DataFrame, who: DataFrame,
                long_items: DataFrame | None = None, bound: int | None = None) -> DataFrame:
    """``key_cols`` of the distinct ``keys`` with ``judged`` (empty where no policy fits)."""
    res_cols = list(level_cols.values())
    path = F.col(res_cols[0]) if list(level_cols) == ["path"] else None
    if path is not None:
        listed = path_lists(keys, key_cols, res_cols[0], index, bound)
    else:
        lists = access_lists(keys.select(*res_cols, "access").distinct(), res_cols, level_cols, index, bound)
        listed = keys.select(*key_cols).join(lists, [*res_cols, "access"], "left")
    full = with_principals(listed, who, long_items)
    return full.withColumn("judged", F.coalesce(judge(F.col("policies"), path), F.array())).select(*key_cols, "judged")


def long_items_of(items: DataFrame, long: DataFrame) -> DataFrame | None:
    """The items of the long lists that decide; None where there are none (one look at ``long``)."""
    if long.limit(1).count() == 0:
        return None
    return items.where((F.col("policy_type") == 0) & F.col("is_enabled") & F.col("is_allowed")
                       & F.col("item_kind").isin(ACCESS_KINDS)).join(
        long, ["service", "policy_id", "access", "item_kind"], "left_semi")


def decide_by_index(keys: DataFrame, key_cols: list[str], level_cols: dict[str, str], index: DataFrame,
                    who: DataFrame, long_items: DataFrame | None = None, bound: int | None = None,
                    stage: bool = True) -> DataFrame:
    """``key_cols`` + decision, allowed, policy_id, is_audit_enabled, one row per row of ``keys``.

    ``stage``: the decisions are written once, because they are joined back to many more requests.
    """
    got = judged_keys(keys, key_cols, level_cols, index, who, long_items, bound)
    out = got.withColumn("v", verdict(F.col("judged"))).select(
        *key_cols, "v.decision", (F.col("v.decision") == "ALLOW").alias("allowed"), "v.policy_id", "v.is_audit_enabled")
    return cut_lineage(out, name="decisions") if stage else out


def decide(keys: DataFrame, key_cols: list[str], level_cols: dict[str, str], items: DataFrame, resources: DataFrame,
           level_opts: DataFrame, who: DataFrame, service: str) -> DataFrame:
    """keys(user, access, <levels>) -> keys + decision..., from the normalized tables of one service."""
    mine = items.where(F.col("service") == service)
    long = cut_lineage(long_lists(mine), name="long_lists")
    index = policy_index(mine, resources.where(F.col("service") == service), level_opts, long)
    staged = cut_lineage(keys.select(*key_cols).distinct(), name="keys")
    return decide_by_index(staged, key_cols, level_cols, index, who, long_items_of(mine, long))


def decide_requests(requests: DataFrame, key_cols: list[str], decisions: DataFrame) -> DataFrame:
    """Join decided keys back to every request row.

    ``decisions`` is a written table of short rows, one for each distinct key: broadcast when its files are under the
    session's threshold, else a shuffle join in which AQE splits the keys that many requests repeat.
    """
    return sized_join(requests, decisions, key_cols, None)
