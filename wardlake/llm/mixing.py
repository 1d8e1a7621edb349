"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Each document of a source is to be taken ``target / source_size`` times on
average. The whole part is taken outright; the fractions are rounded in pairs:
of two documents, words move at random from the one's fraction to the other's
until one fraction is 0 or 1, with chances that keep each one's mean. The words
of a pair stay the same, so a source's taken words miss its target by less than
one document. The pairs form a reduction tree: rows are dealt to groups of about
``GROUP`` by a hash, a group leaves at most one unfinished document, and these
meet in the next, ``GROUP`` times smaller level, until each source has one left.
All randomness comes from hashes of (seed, level, ids): reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlake.llm.common import salted_lookup, stage, text_of

GROUP = 64
LARGEST = 3
WORD = r"[^\x20\x09-\x0D]+"


def chance(*cols) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def targets(sources: DataFrame, largest: int = LARGEST) -> DataFrame:
    """Adds rank, weight and target to the table of sources (source, source_size): one short row for each source.

    Sources in code point order, null last, weigh 1, 2, 3, repeating, and share all words; a target stops at
    ``largest`` times its source's size and the excess is shared anew by weight until none is above. In order
    of size / weight the sources that stop come first, so one running sum finds the final share of a weight.
    """
    ranked = sources.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weighed = ranked.withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("double")).withColumn(
        "cap", F.col("source_size") * F.lit(float(largest)))
    up = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = up.rowsBetween(W.unboundedPreceding, -1), up.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    shared = weighed.withColumn("share", left / F.sum("weight").over(after))
    final = F.min(F.when(F.col("share") * F.col("weight") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("weight")).alias("o"), "rank", "share"))).over(everything)["share"]
    return shared.withColumn("target", F.least("cap", F.col("weight") * final)).select(
        "source", "source_size", "n", "rank", "weight", "target")


def _settle(acc: Column, x: Column, level: int, seed: int) -> Column:
    """One pair: the left-over document of ``acc`` and the next one."""
    i, j = acc["rest"], x
    a, b = i["size"] * (1 - i["p"]), j["size"] * j["p"]  # room in i, words in j
    c, d = j["size"] * (1 - j["p"]), i["size"] * i["p"]  # room in j, words in i
    to_i, to_j = F.least(a, b), F.least(c, d)
    move_to_i = chance(F.lit(seed), F.lit(level), i["h"], j["h"]) < F.coalesce(to_j / (to_i + to_j), F.lit(0.0))
    i_up, j_up = i["p"] + to_i / i["size"], j["p"] + to_j / j["size"]
    i_down, j_down = i["p"] - to_j / i["size"], j["p"] - to_i / j["size"]
    bound = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    part = lambda r, p: F.struct(r["h"].alias("h"), r["doc_id"].alias("doc_id"), r["size"].alias("size"),
                                 r["base"].alias("base"), bound(p).alias("p"))
    end = lambda r, n: F.struct(r["doc_id"].alias("doc_id"), r["size"].alias("size"),
                                (r["base"] + F.lit(n)).cast("long").alias("copies"))
    full_i, full_j = a <= b, c <= d
    rest = (F.when(move_to_i & full_i, part(j, j_down)).when(move_to_i, part(i, i_up))
            .when(full_j, part(i, i_down)).otherwise(part(j, j_up)))
    done = (F.when(move_to_i & full_i, end(i, 1)).when(move_to_i, end(j, 0))
            .when(full_j, end(j, 1)).otherwise(end(i, 0)))
    return F.when(i.isNull(), F.struct(x.alias("rest"), acc["done"].alias("done"))).otherwise(
        F.struct(rest.alias("rest"), F.concat(acc["done"], F.array(done)).alias("done")))


def _level(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """Settle every group: its finished documents and what is left of it."""
    one = F.struct("h", "doc_id", "size", "base", "p")
    got = rows.groupBy("rank", "source_size", "target", "groups", "at").agg(F.sort_array(F.collect_list(one)).alias("rows"))
    kind = got.schema["rows"].dataType.elementType.simpleString()
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    start = F.struct(F.lit(None).cast(kind).alias("rest"),
                     F.array().cast(f"array<struct<doc_id:{id_kind},size:bigint,copies:bigint>>").alias("done"))
    return stage(got.select("rank", "source_size", "target", "groups", "at", F.aggregate(
        "rows", start, lambda acc, x: _settle(acc, x, level, seed)).alias("r")).select(
        "rank", "source_size", "target", "groups", "at", "r.rest", "r.done"), f"mix-level{level}")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        largest: int = LARGEST, seed: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, copies.

    size is the number of words (null text: 0), target the words wanted from the document's source (null is a
    source of its own), copies how often the document is taken, from 0 to ``largest``. Documents without words
    are taken 0 times. Rows that repeat an id count as documents of their own; those that also agree in source and size
    are told apart by a number, so a group of the tree stays small however often a row is repeated. An empty table
    gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"))
    # rows alike in all of this are counted first and numbered when they part again, so each has a hash of its own
    sized = stage(rows.withColumn("named", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
                  .groupBy("doc_id", "named", "source", "size").agg(F.count("*").alias("alike")), "mix-sizes")
    sums = sized.groupBy("named", "source").agg(F.sum(F.col("size") * F.col("alike")).alias("source_size"),
                                                F.sum("alike").alias("n"))
    plan = stage(targets(sums.withColumn("source", F.when(F.col("named"), F.col("source"))), largest), "mix-targets")
    known = plan.withColumn("named", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
    mean = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(largest))))
    full = salted_lookup(sized, known, ["named", "source"], "inner").withColumn("mean", F.coalesce(mean, F.lit(0.0))).withColumn(
        "nth", F.explode(F.sequence(F.lit(1).cast("long"), "alike")))
    split = full.withColumn("base", F.floor("mean").cast("long")).withColumn("p", F.col("mean") - F.floor("mean"))
    whole = (F.col("p") <= 0) | (F.col("size") == 0)
    columns = ["doc_id", "size", "source_size", "target", "copies"]
    out = split.filter(whole).withColumn("copies", F.when(F.col("size") > 0, F.col("base")).otherwise(
        F.lit(0).cast("long"))).select(columns)
    groups = F.ceil(F.col("n") / F.lit(float(GROUP))).cast("long")
    rest = split.filter(~whole).withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size", "nth")).withColumn(
        "groups", groups).withColumn("at", F.pmod("h", "groups")).select(
        "rank", "source_size", "target", "groups", "at", "h", "doc_id", "size", "base", "p")
    most, level = plan.agg(F.max(groups)).first()[0], 0  # one number
    while most is not None:
        got = _level(rest, level, seed)
        out = out.unionByName(got.select("source_size", "target", F.inline("done")).select(columns))
        left = got.filter("rest IS NOT NULL").select("rank", "source_size", "target", "groups", "at", "rest.*")
        last = left.filter("groups <= 1")
        out = out.unionByName(last.withColumn("copies", F.col("base") + (
            chance(F.lit(seed), F.lit(-1), "h") < F.col("p")).cast("long")).select(columns))
        level += 1
        if most <= 1:
            break
        most = -(-most // GROUP)
        rest = left.filter("groups > 1").withColumn(
            "at", F.expr(f"at div {GROUP}")).withColumn("groups", F.ceil(F.col("groups") / F.lit(float(GROUP))).cast("long"))
    return out


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, columns as they were, whatever their names.

    Rows that repeat id, text and source share their copies, and the first of them stands for all; nulls and rows
    without words are treated as in ``mix``; an empty table gives no rows.
    """
    mix_id = F.struct(F.xxhash64(F.col(id_col)), F.xxhash64(text_of(text_col)), F.xxhash64(F.col(source_col))).alias("mix_id")
    plain = docs.select(mix_id, F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    taken = mix(plain, "mix_id", "text", "source").groupBy("doc_id").agg(F.sum("copies").alias("copies"))
    # a row travels as one column, so its own column names can clash with none of these
    joined = docs.select(F.struct("*").alias("row"), mix_id).join(taken.withColumnRenamed("doc_id", "mix_id"), "mix_id")
    first = F.row_number().over(W.partitionBy("mix_id").orderBy("mix_id"))
    return joined.withColumn("nth", first).filter("nth = 1 AND copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
