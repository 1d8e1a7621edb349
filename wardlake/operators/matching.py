"""Resource matching: requested resources x policy patterns, through an index of literal prefixes.

A policy is one row (``resource_index``) with all its patterns. It is posted under the literal text before the first
wildcard of the patterns of one level, the level where this text is longest; a path is cut at a slash. A request asks
for all prefixes of its values (a path: its ancestors), so an equi join on (level, prefix) finds the candidates, and
only these are tested as a whole, inside the row: every level of the policy must fit. A policy whose patterns begin
with a wildcard, or that only excludes, is posted under the empty prefix, which every request asks for.

Matching runs on distinct resources. The index is broadcast below a checked number of rows; else it is joined by
shuffle and AQE splits the partitions of prefixes that many resources share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions.globs import glob_to_regex, has_wildcard
from wardlake.operators.joins import INDEX_ROW_LIMIT, once, sized_join, spread_join
from wardlake.session import cut_lineage

#: The macro for the requesting user in paths and principals, as policies write it.
USER_MACRO = "{USER}"
PATH = "path"
SHALLOW = 2  # slashes of a prefix that most requests may share


def pattern_rows(resources: DataFrame, level_opts: DataFrame | None) -> DataFrame:
    """``resources`` with ``r``: all that a test of the pattern needs.

    r: level, pattern, excludes, recursive, ignore_case, wild, macro, re (regex of a pattern with wildcards or the
    macro, which stays in it as text), prefix (lower case, except of a path), strength (its length; a whole literal
    counts more).
    """
    if level_opts is None:
        rows = resources.withColumn("ignore_case", F.lit(False))
    else:
        opts = level_opts.select("service", "level", "ignore_case")  # as many rows as the service definitions have
        rows = resources.join(F.broadcast(opts), ["service", "level"], "left").withColumn(
            "ignore_case", F.coalesce("ignore_case", F.lit(False)))
    is_path = F.col("level") == PATH
    rows = rows.withColumn("pattern", F.when(is_path, F.regexp_replace("pattern", "(.)/+$", "$1")).otherwise(F.col("pattern")))
    wild, macro = has_wildcard(F.col("pattern")), is_path & F.col("pattern").contains(USER_MACRO)
    rx = glob_to_regex(F.col("pattern"), F.col("ignore_case"))
    deep = F.concat(F.regexp_replace(rx, r"\$$", ""), F.lit("(/.*)?$"))
    head = F.regexp_extract("pattern", r"^(.*?)(?:\*|\?|\{USER\}|$)", 1)
    folder = F.regexp_replace(head, "/[^/]*$", "")
    prefix = F.when(~is_path, F.lower(F.regexp_extract("pattern", r"^([^*?]*)", 1))).when(wild | macro, F.when(
        folder == "", F.lit("/")).otherwise(folder)).otherwise(F.col("pattern"))
    return rows.withColumn("r", F.struct(
        "level", "pattern", "excludes", "recursive", "ignore_case", wild.alias("wild"), macro.alias("macro"),
        F.when(wild | macro, F.when(is_path & F.col("recursive"), deep).otherwise(rx)).alias("re"), prefix.alias("prefix"),
        F.when(wild | macro, F.length(prefix)).otherwise(F.length("pattern") + 1000).alias("strength")))


def resource_index(resources: DataFrame, level_opts: DataFrame | None, service: str) -> DataFrame:
    """(policy_id, res): one row per policy of ``service``. A policy's patterns came in one document."""
    rows = pattern_rows(resources.where(F.col("service") == service), level_opts)
    return rows.groupBy("policy_id").agg(F.collect_set("r").alias("res"))


def postings(index: DataFrame, levels: list[str]) -> DataFrame:
    """``index`` once per (level, prefix) under which a policy is found; ``prefixes`` lists all of its own.

    A policy with a level that the requests lack can never fit and is left out.
    """
    able = index.where(F.forall("res", lambda r: r["level"].isin(levels)))
    pos = F.filter("res", lambda r: ~r["excludes"])
    names = F.array_distinct(F.transform(pos, lambda r: r["level"]))
    best = F.array_max(F.transform(names, lambda n: F.struct(F.array_min(F.transform(
        F.filter("_pos", lambda r: r["level"] == n), lambda r: r["strength"])).alias("s"), n.alias("n"))))
    own = F.array_distinct(F.transform(F.filter("_pos", lambda r: r["level"] == F.col("level")), lambda r: r["prefix"]))
    root = F.lit("/" if levels == [PATH] else "")
    return (able.withColumn("_pos", pos).withColumn("level", F.coalesce(best["n"], F.lit("")))
            .withColumn("prefixes", F.when(F.size("_pos") > 0, own).otherwise(F.array(root))).drop("_pos")
            .withColumn("prefix", F.explode("prefixes")))


def value_map(level_cols: dict[str, str]) -> Column:
    return F.create_map(*[x for lvl, c in level_cols.items() for x in (F.lit(lvl), F.col(c).cast("string"))])


def fits_value(r: Column, v: Column) -> Column:
    return (F.when(r["wild"], F.regexp_like(v, r["re"])).when(r["ignore_case"], F.lower(v) == F.lower(r["pattern"]))
            .otherwise(v == r["pattern"]))


def all_levels_fit(res: Column, values: Column) -> Column:
    """Every level lists values and fits when any does, inverted where the level excludes."""
    levels = F.array_distinct(F.transform(res, lambda r: F.struct(r["level"].alias("level"), r["excludes"].alias("excludes"))))
    return F.forall(levels, lambda lv: values[lv["level"]].isNotNull() & (F.exists(
        res, lambda r: (r["level"] == lv["level"]) & (r["excludes"] == lv["excludes"])
        & fits_value(r, values[lv["level"]])) != lv["excludes"]))


def _anchors(level_cols: dict[str, str]) -> Column:
    """(level, prefix) for every prefix of every value, and the empty one of a request as a whole."""
    def of(level, c):
        v = F.lower(F.col(c).cast("string"))
        return F.when(v.isNotNull(), F.transform(F.sequence(F.lit(0), F.length(v)), lambda k: F.struct(
            F.lit(level).alias("level"), F.substr(v, F.lit(1), k).alias("prefix"))))
    whole = F.array(F.struct(F.lit("").alias("level"), F.lit("").alias("prefix")))
    none = F.array().cast("array<struct<level:string,prefix:string>>")
    return F.concat(whole, *[F.coalesce(of(lvl, c), none) for lvl, c in level_cols.items()])


def match_index(keys: DataFrame, level_cols: dict[str, str], index: DataFrame, bound: int | None = None) -> DataFrame:
    """Rows of ``keys`` x ``index`` whose levels all fit, each once.

    ``bound``: a known upper bound of the policies. For path resources see ``match_path_index``.
    """
    if list(level_cols) == [PATH]:
        return match_path_index(keys, level_cols[PATH], index, bound)
    posted = postings(index, list(level_cols))
    asked = keys.withColumn("_a", F.explode(_anchors(level_cols))).select(*keys.columns, "_a.level", "_a.prefix")
    met = sized_join(asked, posted, ["level", "prefix"], bound)
    values = value_map(level_cols)
    # a policy is met under each of its prefixes that the value has: the first of them counts
    first = F.array_min(F.filter("prefixes", lambda p: F.startswith(
        F.coalesce(F.lower(values[F.col("level")]), F.lit("")), p)))
    return met.where((F.col("prefix") == first) & all_levels_fit(F.col("res"), values)).select(
        *keys.columns, *index.columns)


def match_resources(keys: DataFrame, key_cols: list[str], level_cols: dict[str, str], resources: DataFrame,
                    level_opts: DataFrame, service: str, bound: int | None = None) -> DataFrame:
    """(key..., policy_id): every level of the policy fits the request.

    A policy without some level of the request covers all of that level; a policy level the request does not have
    never fits. ``bound``: a known upper bound of the resource rows.
    """
    index = resource_index(resources, level_opts, service)
    return match_index(keys.select(*key_cols), level_cols, index, bound).select(*key_cols, "policy_id")


def pattern_hits(keys: DataFrame, key_cols: list[str], level_cols: dict[str, str], resources: DataFrame,
                 level_opts: DataFrame, service: str, bound: int | None = None) -> DataFrame:
    """GOV-03 / GOV-04: (key..., policy_id, level, excludes): some pattern of that level fits the value."""
    pats = pattern_rows(resources.where(F.col("service") == service), level_opts).select(
        "policy_id", "level", "excludes", F.col("r.prefix").alias("prefix"), "r")
    asked = keys.select(*key_cols, F.explode(_anchors(level_cols)).alias("_a"), value_map(level_cols).alias("_v")).select(
        *key_cols, "_a.level", "_a.prefix", F.col("_v")[F.col("_a.level")].alias("value"))
    met = sized_join(asked, pats, ["level", "prefix"], bound)
    return met.where(fits_value(F.col("r"), F.col("value"))).select(*key_cols, "policy_id", "level", "excludes").distinct()


# ---------------------------------------------------------------------------
# JN-06 / GOV-05 / GOV-06: path under a recursive, wildcard or user's path
# ---------------------------------------------------------------------------

def _whole_path(path_col: str) -> Column:
    """The path with one slash in front, none behind and none doubled."""
    p = F.col(path_col)
    p = F.when(p.contains("//"), F.regexp_replace(p, "/{2,}", "/")).otherwise(p)
    return F.concat(F.lit("/"), F.btrim(p, F.lit("/")))


def path_ancestors(path_col: str = "path"):
    """'/a/b/c' -> ['/', '/a', '/a/b', '/a/b/c'] (the path and each parent)."""
    p = _whole_path(path_col)
    n = slashes(p)
    up = F.transform(F.sequence(F.lit(1), n), lambda k: F.call_function("substring_index", p, F.lit("/"), k + 1))
    return F.when(p == "/", F.array(F.lit("/"))).otherwise(F.concat(F.array(F.lit("/")), up))


def slashes(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("/")))


def ask_ancestors(keys: DataFrame, path_col: str, depths: list[int]) -> DataFrame:
    """``keys`` once per ancestor of the path (``prefix``) that has one of ``depths`` slashes; 0 stands for the root."""
    keys = keys.where(F.col(path_col).isNotNull())
    if not depths:
        return keys.withColumn("prefix", F.lit("/")).where("false")
    whole = keys.withColumn("_p", _whole_path(path_col)).withColumn("_n", F.when(F.col("_p") == "/", 0).otherwise(slashes(F.col("_p"))))
    up = [F.lit("/") if d == 0 else F.when(F.col("_n") >= d, F.substring_index("_p", "/", d + 1)) for d in depths]
    return whole.withColumn("prefix", F.explode(F.array(*up))).where("prefix IS NOT NULL").drop("_p", "_n")


def _quoted(user: Column) -> Column:
    return F.replace(user, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))


def covers(r: Column, path: Column) -> Column:
    """The pattern covers the path, for some user where it holds the macro."""
    some_user = F.when(r["macro"], F.replace(r["re"], F.lit(USER_MACRO), F.lit("\\E.+\\Q"))).otherwise(r["re"])
    near = r["ignore_case"] | F.startswith(path, r["prefix"])  # a regex is compiled for each path that it meets
    return F.when(r["re"].isNotNull(), near & F.regexp_like(path, some_user)).otherwise(covers_literal(r, path))


def covers_literal(r: Column, path: Column) -> Column:
    return (path == r["pattern"]) | (r["recursive"] & (
        (r["pattern"] == "/") | F.startswith(path, F.concat(r["pattern"], F.lit("/")))))


def covers_for(templates: Column, path: Column, user: Column) -> Column:
    """Any of the regexes with the macro covers the path when the macro is ``user``."""
    return F.exists(templates, lambda t: F.regexp_like(path, F.replace(t, F.lit(USER_MACRO), _quoted(user))))


def match_path_index(keys: DataFrame, path_col: str, index: DataFrame, bound: int | None = None) -> DataFrame:
    """Rows of ``keys`` x ``index`` that fit, with ``hit`` (the patterns that cover the path), ``only`` and ``unless``.

    ``only``: NULL, or regexes with the macro, one of which must cover the path for the requesting user. ``unless``:
    NULL, or such regexes of an excluding policy, none of which may. A policy that excludes paths fits those that
    none of its paths covers; it is posted at the root, which is an ancestor of every path.
    """
    depth = F.when(F.col("prefix") == "/", 0).otherwise(slashes(F.col("prefix")))
    one = F.element_at("res", 1)
    sole = (F.size("res") == 1) & ~one["excludes"] & one["re"].isNull()  # one literal path: tested without a look into lists
    posted = postings(index, [PATH]).where(F.startswith("prefix", F.lit("/"))).withColumn("depth", depth).withColumn(
        "excluding", F.exists("res", lambda r: r["excludes"])).withColumn(
        "sole", F.when(sole, F.struct(one["pattern"].alias("pattern"), one["recursive"].alias("recursive"), one["re"].alias("re"))))
    posted = cut_lineage(posted, name="postings")
    # one short row for each depth at which policies are posted: no path asks for an ancestor of another depth
    sizes = {r["depth"]: r["count"] for r in posted.groupBy("depth").count().collect()}
    # '/', '/en': few in any store but over most requests, so they are joined apart from the many deep ones, in place or spread
    shallow, deep = (sorted(d for d in sizes if (d <= SHALLOW) == few) for few in (True, False))
    top, low = posted.where(F.col("depth") <= SHALLOW).drop("depth"), posted.where(F.col("depth") > SHALLOW).drop("depth")
    asked = ask_ancestors(keys, path_col, shallow)
    few = sum(sizes[d] for d in shallow) <= INDEX_ROW_LIMIT
    met = asked.join(F.broadcast(top), "prefix") if few else spread_join(asked, top, ["prefix"])
    if deep:
        # sorted by a number: texts that begin alike ('/orders/') take a whole comparison for each step of a sort
        hashed = [df.withColumn("_hash", F.xxhash64("prefix")) for df in (ask_ancestors(keys, path_col, deep), low)]
        met = met.unionByName(sized_join(*hashed, ["_hash", "prefix"], bound).drop("_hash"))
    path = F.col(path_col)
    under = lambda p: (p == "/") | (p == path) | F.startswith(path, F.concat(p, F.lit("/")))
    first = F.when(F.size("prefixes") == 1, under(F.col("prefix"))).otherwise(
        F.col("prefix") == F.array_min(F.filter("prefixes", under)))
    sole = F.col("sole")
    hit = F.when(sole.isNull(), F.filter("res", lambda r: covers(r, path))).when(covers_literal(sole, path), F.col("res"))
    seen = once(met.where(first), "hit", F.coalesce(hit, F.array()))
    plain = F.exists("hit", lambda r: ~r["macro"])
    templates = F.transform("hit", lambda r: r["re"])
    excluding = F.col("excluding")
    kept = seen.where(F.when(excluding, ~plain).otherwise(F.size("hit") > 0))
    return kept.select(*keys.columns, *index.columns, "hit", "excluding",
                       F.when(~excluding & ~plain, templates).alias("only"),
                       F.when(excluding & (F.size("hit") > 0), templates).alias("unless"))


def match_paths(reqs: DataFrame, key_cols: list[str], resources: DataFrame, service: str, user_col: str | None = None,
                bound: int | None = None) -> DataFrame:
    """(key..., policy_id, pattern): request path fits a path policy; an excluding policy has a NULL pattern.

    Each request asks for the ancestors of its path and is tested in the row, so it meets the policies once and is not
    joined back. ``user_col`` names the requesting user, whom the macro in a path stands for; without it a path with the
    macro fits no request.
    """
    index = resource_index(resources, None, service)
    rows = reqs.select(*dict.fromkeys([*key_cols, PATH]), (F.col(user_col) if user_col else F.lit(None).cast("string")).alias("_user"))
    found = match_index(rows, {PATH: PATH}, index, bound)
    one = found.select(*rows.columns, F.struct("policy_id", "excluding", "hit", "unless").alias("f"))
    mine = lambda r: ~r["macro"] | F.coalesce(covers_for(F.array(r["re"]), F.col("path"), F.col("_user")), F.lit(False))
    none = F.array(F.lit(None).cast("string"))
    kept = one.where(~F.col("f.excluding") | F.col("f.unless").isNull()
                     | ~F.coalesce(covers_for(F.col("f.unless"), F.col("path"), F.col("_user")), F.lit(False)))
    patterns = F.when(F.col("f.excluding"), none).otherwise(F.transform(F.filter("f.hit", mine), lambda r: r["pattern"]))
    return kept.select(*key_cols, F.col("f.policy_id").alias("policy_id"), F.explode(patterns).alias("pattern")).distinct()
