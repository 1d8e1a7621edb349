"""Merkle manifest of a table by butterfly exchange.

Every row is a leaf; the leaves of a source form a tree of fanout 16, and the roots of the sources form one more.
A block is an aligned run of 16^3 leaves of one source and is what exchanges: it hashes its own leaves
first. Then aligned groups of up to 16 subtrees swap roots, round by round. A block of a subtree of 16^r blocks
meets, in round r, the blocks of the same place (lane) in the other subtrees of its group; all of them hash the
same ancestor, so after the last round every block holds the path from its root to the top and nothing has to be
handed down. A last subtree with fewer blocks sends each of them to several lanes. The rounds go on over the
sources in the same way, a source being a subtree of as many blocks as it has.

What a round moves is one short row per block and at most 16 per lane. A third of all rows in one source is many
blocks, dealt by (source, block).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlake.llm.common import salted_lookup, stage

FANOUT = 16
LEVELS = 3  # of a tree within one block
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def part(value: Column) -> Column:
    """A value as it is hashed: its bytes in UTF-8, a colon, the value; ``-`` for null."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows``, written, with ``index``: their place in ``order`` over the whole table, from 0.

    Tasks hold ranges of the order; the place is the one in the task plus the rows of the tasks before it.
    """
    laid = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "at", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("task", F.shiftright("at", 33))
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    # one row of two numbers for each task that wrote, so its size follows the tasks, not the rows
    bases = laid.groupBy("task").agg(F.count("*").alias("n"), F.min("at").alias("low")).select(
        "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("base"))
    return laid.join(F.broadcast(bases), "task").withColumn("index", F.col("at") + F.col("base")).drop("task", "at", "base")


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes: list[str], least: int) -> list[list[str]]:
    """The levels over ``nodes`` up to one node, and at least ``least`` of them."""
    levels = [nodes]
    while len(levels[-1]) > 1 or len(levels) <= least:
        below = levels[-1]
        levels.append([_h("".join(below[k:k + FANOUT])) for k in range(0, len(below), FANOUT)])
    return levels


def _by_block(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """(rank, block), rows: the rows of one block at a time, from batches sorted by (rank, block)."""
    key, rows = None, []
    for b in batches:
        for k, row in zip(zip(b.column("rank").to_pylist(), b.column("block").to_pylist()),
                          zip(*(b.column(c).to_pylist() for c in columns))):
            if k != key:
                if rows:
                    yield key, rows
                key, rows = k, []
            rows.append(row)
    if rows:
        yield key, rows


def _block_roots(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (rank, block), rows in _by_block(batches, ["leaf", "blocks"]):
            blocks = rows[0][1]
            root = tree([r[0] for r in rows], levels if blocks > 1 else 0)[-1][0]
            yield pa.RecordBatch.from_pylist([{"rank": rank, "block": block, "blocks": blocks, "root": root}])
    return run


def exchange(units: DataFrame, level: str) -> DataFrame:
    """One round. ``units`` have group and member (of the subtree in its group), low and m (place in the subtree,
    blocks of it), lanes (of the group), root, path; root becomes that of the group and path grows by one level."""
    sent = units.withColumn("lane", F.explode(F.sequence("low", F.col("lanes") - 1, "m")))
    kept = [c for c in units.columns if c not in ("group", "member", "low", "m", "lanes", "root", "path")]
    own = F.when(F.col("lane") == F.col("low"), F.struct(*kept, "path"))
    met = sent.groupBy("group", "lane").agg(F.sort_array(F.collect_list(F.struct("member", "root", own.alias("own")))).alias("met"))
    text = F.concat_ws("", F.transform("met", lambda x: x["root"]))
    side = lambda ahead: F.concat_ws("", F.transform(
        F.filter("met", lambda x: x["member"] < F.col("x.member") if ahead else x["member"] > F.col("x.member")),
        lambda x: x["root"]))
    got = met.select("met", F.sha2(text, 256).alias("root"), F.explode("met").alias("x")).filter("x.own IS NOT NULL")
    step = F.array(F.struct(side(True).alias("before"), side(False).alias("after")))
    return stage(got.select(*[F.col(f"x.own.{c}").alias(c) for c in kept], "root",
                            F.concat("x.own.path", step).alias("path")), f"merkle-{level}")


def _within_sources(units: DataFrame) -> DataFrame:
    """Rounds until every block holds the root of its source."""
    most, size = units.agg(F.max("blocks")).first()[0] or 0, 1  # one number
    while size < most:
        whole, n = F.lit(size).cast("long"), F.lit(size * FANOUT).cast("long")
        low, start = F.col("block") % whole, F.expr(f"block div {size * FANOUT}")
        shaped = units.filter(F.col("blocks") > size).select(
            "*", F.struct("rank", start.alias("run")).alias("group"), F.expr(f"(block div {size}) % {FANOUT}").alias("member"),
            low.alias("low"), F.least(whole, F.col("blocks") - F.col("block") + low).alias("m"),
            F.least(whole, F.col("blocks") - start * n).alias("lanes"))
        done = exchange(shaped, f"blocks{size}")
        units = done.unionByName(units.filter(F.col("blocks") <= size))
        size *= FANOUT
    return units


def _over_sources(units: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """Rounds over the roots of the sources; ``low`` counts blocks through all sources of a subtree."""
    place = sources.select("rank", F.col("rank").alias("node"), F.lit(0).cast("long").alias("low"), F.col("blocks").alias("m"))
    level = 0
    while count > 1:
        nodes = place.groupBy("node").agg(F.first("m").alias("m"))  # equal in all sources of a node
        lists = nodes.groupBy(F.expr(f"node div {FANOUT}").alias("group")).agg(
            F.sort_array(F.collect_list(F.struct((F.col("node") % FANOUT).alias("member"), "m"))).alias("ms"))
        of_group = place.withColumn("group", F.expr(f"node div {FANOUT}")).withColumn("member", F.col("node") % FANOUT)
        shape = stage(salted_lookup(of_group, lists, ["group"], "inner").withColumn(
            "lanes", F.array_max(F.transform("ms", lambda x: x["m"]))), f"merkle-shape{level}")
        here = salted_lookup(units, shape.select("rank", "group", "member", F.col("low").alias("first"), "m", "lanes"),
                             ["rank"], "inner")
        units = exchange(here.withColumn("low", F.col("first") + F.col("block")).drop("first"), f"sources{level}")
        total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x["m"])
        ahead = F.filter("ms", lambda x: x["member"] < F.col("member"))
        place = shape.select("rank", F.col("group").alias("node"), (F.col("low") + total(ahead)).alias("low"),
                             total(F.col("ms")).alias("m"))
        count, level = -(-count // FANOUT), level + 1
    return units


def _proofs(kind: pa.DataType, least: int):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    types = [kind, *[pa.string()] * 5, pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_rank, _block), rows in _by_block(batches, ["pos", "doc_id", "leaf", "changed", "blocks", "subroot", "root", "path"]):
            # the block's own row comes first, its leaves follow in order
            (_, _, _, _, blocks, subroot, root, path), leaves = rows[0], rows[1:]
            levels = tree([r[2] for r in leaves], least if blocks > 1 else 0)
            upper = "".join(s["before"] + s["after"] for s in path)
            tops: dict[str, str] = {}
            out: list[list] = [[] for _ in names]
            for k, (_pos, doc_id, leaf, changed, *_) in enumerate(leaves):
                sides, at = [], k
                for nodes in levels[:-1]:
                    run_start = at - at % FANOUT
                    sides.append(("".join(nodes[run_start:at]), "".join(nodes[at + 1:run_start + FANOUT])))
                    at //= FANOUT
                h = changed or leaf
                for before, after in sides:
                    h = _h(before + h + after)
                if h not in tops:
                    top = h
                    for s in path:
                        top = _h(s["before"] + top + s["after"])
                    tops = {**tops, h: top} if len(tops) < 2 else {h: top}
                folded = tops[h]
                proof = _h("".join(a + b for a, b in sides) + upper)
                for c, v in zip(out, (doc_id, leaf, subroot, root, proof, folded, folded == root)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
    return run


def manifest(docs: DataFrame, id_col: str = "doc_id", fields: tuple = ("doc_id", "source", "lang", "n_chars", "text"),
             source_col: str = "source", text_col: str = "text", tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of ``fields``, null being a mark of its own. Leaves of a source go by id (null first), then
    by digest; sources by their bytes, null first and another source than the empty one. proof_sha256 digests the
    siblings from the leaf to the root. folded_root is computed from the siblings and the leaf of the row as it is
    where ``tampered`` (a condition on ``docs``) lower-cases A-Z of the text: verified tells whether it is the root.
    Rows that repeat are leaves of their own; an empty table gives no rows; other columns are not read. A block has up
    to 16^``levels`` leaves.
    """
    block = FANOUT ** levels

    def leaf_of(text: Column) -> Column:
        return F.sha2(F.concat(*[part(text if f == text_col else F.col(f)) for f in fields]), 256)

    own = leaf_of(F.col(text_col))
    flag = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    changed = F.when(flag, leaf_of(F.translate(F.col(text_col), UPPER, LOWER)))
    leaves = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               own.alias("leaf"), changed.alias("changed")).withColumn(
        "row", F.monotonically_increasing_id()), "merkle-leaves")
    key = [F.col("source").isNotNull().alias("named"), F.coalesce("source", F.lit("")).alias("source")]
    rows = numbered(leaves.select(*key, "doc_id", "leaf", "changed", "row"), [
        F.col("named"), F.col("source"), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("row")], "merkle-rows")
    found = rows.groupBy("named", "source").agg(F.min("index").alias("first"), F.count("*").alias("n"))
    sources = stage(numbered(found, [F.col("named"), F.col("source")], "merkle-sources").select(
        "named", "source", "first", F.col("index").alias("rank"),
        F.expr(f"(n + {block - 1}) div {block}").alias("blocks")), "merkle-ranks")
    placed = salted_lookup(rows, sources, ["named", "source"], "inner").withColumn(
        "pos", F.col("index") - F.col("first")).withColumn("block", F.expr(f"pos div {block}"))
    kind = "array<struct<before:string,after:string>>"
    roots = placed.select("rank", "block", "pos", "leaf", "blocks").repartition("rank", "block").sortWithinPartitions(
        "rank", "block", "pos").mapInArrow(_block_roots(levels), "rank long, block long, blocks long, root string")
    units = _within_sources(stage(roots.withColumn("path", F.array().cast(kind)), "merkle-blocks"))
    units = _over_sources(units.withColumn("subroot", F.col("root")), sources.select("rank", "blocks"), sources.count())
    id_type = leaves.schema["doc_id"].dataType
    none = F.lit(None)
    heads = units.select("rank", "block", F.lit(-1).cast("long").alias("pos"), none.cast(id_type).alias("doc_id"),
                         none.cast("string").alias("leaf"), none.cast("string").alias("changed"), "blocks", "subroot",
                         "root", "path")
    all_rows = heads.unionByName(placed.select(
        "rank", "block", "pos", "doc_id", "leaf", "changed", "blocks", none.cast("string").alias("subroot"),
        none.cast("string").alias("root"), none.cast(kind).alias("path")))
    from pyspark.sql.pandas.types import to_arrow_type
    out = (f"doc_id {id_type.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
           "folded_root string, verified boolean")
    return all_rows.repartition("rank", "block").sortWithinPartitions("rank", "block", "pos").mapInArrow(
        _proofs(to_arrow_type(id_type), levels), out)


def tampered_ids(id_col: str = "doc_id", every: int = 5) -> Column:
    """Rows whose CRC-32 of the decimal id ``every`` divides; a null id is not among them."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0


_CRC = ("xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT), lambda a, b: "
        "list_reduce([xor(a, b)] || range(8), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)")
_LEAF = " || ".join(f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')"
                    for f in ("doc_id", "source", "lang", "n_chars"))
_TEXT = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"

SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, leaf, start, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM (SELECT doc_id, source, sha256({_LEAF} || {_TEXT.format('text')}) AS leaf,
               CASE WHEN {_CRC.format('doc_id::VARCHAR')} % 5 = 0
                    THEN sha256({_LEAF} || {_TEXT.format("translate(text, '" + UPPER + "', '" + LOWER + "')")})
                    ELSE sha256({_LEAF} || {_TEXT.format('text')}) END AS start FROM documents)
), low AS (
  SELECT source, 0 AS lv, pos AS i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, lv + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM low WHERE n > 1
  GROUP BY source, lv, i // 16, n
), subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank FROM low WHERE n = 1
), high AS (
  SELECT 0 AS lv, rank AS i, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lv + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM high WHERE n > 1 GROUP BY lv, i // 16, n
), runs AS (
  SELECT source, lv, i // 16 AS run, list(h ORDER BY i) AS hs FROM low WHERE n > 1 GROUP BY ALL
), high_runs AS (
  SELECT lv, i // 16 AS run, list(h ORDER BY i) AS hs FROM high WHERE n > 1 GROUP BY ALL
), depth AS (SELECT source, max(lv) AS d FROM low GROUP BY source
), steps AS (
  SELECT l.source, l.pos, r.lv AS lv, r.hs AS hs, (l.pos // (16 ** r.lv)::BIGINT) % 16 AS m
  FROM leaves l JOIN runs r ON r.source IS NOT DISTINCT FROM l.source AND r.run = l.pos // (16 ** (r.lv + 1))::BIGINT
  UNION ALL
  SELECT l.source, l.pos, d.d + r.lv, r.hs, (s.rank // (16 ** r.lv)::BIGINT) % 16
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  JOIN depth d ON d.source IS NOT DISTINCT FROM l.source
  JOIN high_runs r ON r.run = s.rank // (16 ** (r.lv + 1))::BIGINT
), sides AS (
  SELECT source, pos, lv, array_to_string(hs[:m], '') AS before, array_to_string(hs[m + 2:], '') AS after FROM steps
), fold AS (
  SELECT source, pos, 0 AS lv, start AS h FROM leaves
  UNION ALL
  SELECT f.source, f.pos, f.lv + 1, sha256(s.before || f.h || s.after)
  FROM fold f JOIN sides s ON s.source IS NOT DISTINCT FROM f.source AND s.pos = f.pos AND s.lv = f.lv
), ends AS (
  SELECT source, pos, arg_max(h, lv) AS folded FROM fold GROUP BY source, pos
), proofs AS (
  SELECT source, pos, sha256(string_agg(before || after, '' ORDER BY lv)) AS proof FROM sides GROUP BY source, pos
)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, e.folded AS folded_root,
       e.folded = t.h AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN ends e ON e.source IS NOT DISTINCT FROM l.source AND e.pos = l.pos
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.pos = l.pos
CROSS JOIN (SELECT h FROM high WHERE n = 1) t
"""
