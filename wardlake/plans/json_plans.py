"""JSON column functions over ``events.props`` and ``conversations.text``."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlake.functions import jsoncols as jc
from wardlake.plans.registry import query
from wardlake.sources.tables import scan_parquet


@query("json_parse_strict", """
SELECT 'events' AS src, event_id AS id, json_valid(props) AS valid,
       CASE WHEN json_valid(props) THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events
UNION ALL
SELECT 'conversations', conv_id * 1000 + turn, json_valid(text),
       CASE WHEN json_valid(text) THEN TRY_CAST(json_extract(text, '$.k') AS BIGINT) END FROM conversations
""")
def q_json_parse_strict(spark, sf_dir):
    e = scan_parquet(spark, sf_dir, "events").select(F.lit("events").alias("src"), F.col("event_id").alias("id"),
                                                     F.col("props").alias("doc"))
    c = scan_parquet(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("text").alias("doc"))
    v = e.unionByName(c).withColumn("j", jc.parse_strict(F.col("doc")))
    return v.select("src", "id", F.col("j").isNotNull().alias("valid"),
                    F.try_variant_get("j", "$.k", "bigint").alias("k"))


def order_documents(spark, sf_dir):
    """(order_key, doc): an order with its lines as nested JSON, keys in no order; one document per order."""
    li = scan_parquet(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_suppkey").alias("from"), F.col("l_partkey").alias("part"),
                    F.col("l_quantity").cast("int").alias("amount"))
    lines = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    o = scan_parquet(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    late = F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.col("o_orderpriority"))
    doc = F.struct(F.struct(F.col("o_orderstatus").alias("status"), late.alias("late"), F.struct(
        F.col("o_custkey").alias("key"), F.array().cast("array<string>").alias("aliases")).alias("buyer")).alias("order"),
        (F.col("o_orderstatus") == "O").alias("is_open"), F.coalesce("lines", F.array().cast(
            lines.schema["lines"].dataType)).alias("lines"))
    return o.join(lines, "o_orderkey", "left").select(F.col("o_orderkey").alias("order_key"), F.to_json(
        doc, {"ignoreNullFields": "false"}).alias("doc"))


_ORDER_DOCS = """
SELECT o.o_orderkey AS order_key, to_json({'is_open': o_orderstatus = 'O', 'lines': coalesce(l.lines, []), 'order': {
         'buyer': {'aliases': []::VARCHAR[], 'key': o_custkey},
         'late': CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END, 'status': o_orderstatus}})::VARCHAR AS doc
FROM orders o LEFT JOIN (
  SELECT l_orderkey, list({'amount': CAST(l_quantity AS INTEGER), 'from': l_suppkey, 'n': l_linenumber, 'part': l_partkey}
                          ORDER BY l_linenumber, l_suppkey, l_partkey, CAST(l_quantity AS INTEGER)) AS lines FROM lineitem GROUP BY 1) l
  ON l.l_orderkey = o.o_orderkey
"""


@query("json_canonical", f"""
SELECT 'events' AS src, event_id AS id,
       regexp_replace(to_json({{'event_id': event_id, 'event_type': event_type, 'k': CAST(json_extract(props, '$.k') AS BIGINT),
                 'user_id': user_id, 'value': value}})::VARCHAR, '\\.0}}$', '}}') AS doc FROM events
UNION ALL SELECT 'orders', order_key, doc FROM ({_ORDER_DOCS})
""")
def q_json_canonical(spark, sf_dir):
    e = scan_parquet(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    events = e.select(F.lit("events").alias("src"), F.col("event_id").alias("id"),
                      jc.canonical(["value", "user_id", "k", "event_type", "event_id"]).alias("doc"))
    return events.unionByName(order_documents(spark, sf_dir).select(
        F.lit("orders").alias("src"), F.col("order_key").alias("id"), jc.canonical_text(F.col("doc")).alias("doc")))


@query("json_nonfinite", """
SELECT event_id, CASE WHEN value > 40 THEN 'Infinity'::DOUBLE WHEN value < 1 THEN 'NaN'::DOUBLE
                      WHEN value < 2 THEN '-Infinity'::DOUBLE ELSE value END AS v FROM events
""")
def q_json_nonfinite(spark, sf_dir):
    e = scan_parquet(spark, sf_dir, "events")
    tok = (F.when(F.col("value") > 40, "Infinity").when(F.col("value") < 1, "NaN")
           .when(F.col("value") < 2, "-Infinity").otherwise(F.col("value").cast("string")))
    doc = F.concat(F.lit('{"v": '), tok, F.lit("}"))
    return e.select("event_id", jc.parse_nonfinite(doc, "v double")["v"].alias("v"))


@query("json_flatten", f"""
SELECT src, id, fullkey AS path, CASE WHEN type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'number' WHEN type = 'VARCHAR' THEN 'string'
         ELSE lower(type) END AS type, CASE WHEN type NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN atom ->> '$' END AS value
FROM (SELECT 'events' AS src, event_id AS id, j.* FROM events e, json_tree(e.props) j
      UNION ALL SELECT 'orders', order_key, j.* FROM ({_ORDER_DOCS}) o, json_tree(o.doc) j)
WHERE type NOT IN ('OBJECT', 'ARRAY') OR CAST(value AS VARCHAR) IN ('[]', '{{}}')
""")
def q_json_flatten(spark, sf_dir):
    e = scan_parquet(spark, sf_dir, "events").select(F.lit("events").alias("src"), F.col("event_id").alias("id"),
                                                     F.col("props").alias("doc"))
    docs = order_documents(spark, sf_dir).select(F.lit("orders").alias("src"), F.col("order_key").alias("id"), "doc")
    return jc.flatten(e.unionByName(docs), ["src", "id"], "doc")
