"""W1/W2 batch queries: landing, rollups, projections, limits, keyed copies."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators import retail
from wardlake.plans.registry import query
from wardlake.session import fresh_path
from wardlake.sources import sinks, tables
from wardlake.sources.tables import impressions, scan_parquet


def _tag(sf_dir: str) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", sf_dir.strip("/"))[-40:]


def _sales(spark: SparkSession, sf_dir: str):
    return retail.sales_by_sku(tables.staging_orders(spark, sf_dir), tables.staging_products(spark, sf_dir))


SALES_SQL = """
SELECT CAST(sum(CAST(l.l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS total_sales,
       CAST(l.l_partkey AS VARCHAR) AS sku, p.p_type AS product_category
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON CAST(l.l_partkey AS VARCHAR) = CAST(p.p_partkey AS VARCHAR)
GROUP BY CAST(l.l_partkey AS VARCHAR), p.p_type
"""

CATEGORY_SQL = f"""
SELECT product_category, CAST(sum(CAST(total_sales AS DECIMAL(38,2))) AS DOUBLE) AS total_sales
FROM ({SALES_SQL}) s GROUP BY product_category ORDER BY total_sales DESC
"""


@query("sales_by_sku_category", SALES_SQL)
def q_sales_by_sku(spark, sf_dir):
    return _sales(spark, sf_dir)


@query("sales_by_category", CATEGORY_SQL)
def q_sales_by_category(spark, sf_dir):
    return retail.sales_by_category(_sales(spark, sf_dir))


@query("order_desc", SALES_SQL + " ORDER BY total_sales DESC, sku")
def q_order_desc(spark, sf_dir):
    # SRT-01: a full sort (range-partitioned shuffle, then per-task sort).
    return _sales(spark, sf_dir).orderBy(F.desc("total_sales"), "sku")


@query("join_orders_products", """
SELECT CAST(o.o_custkey AS VARCHAR) AS customer_id, strftime(o.o_orderdate, '%Y-%m-%d') AS order_date,
       l.l_extendedprice AS price, CAST(l.l_partkey AS VARCHAR) AS sku,
       p.p_type AS product_category, p.p_brand AS company
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
""")
def q_join_orders_products(spark, sf_dir):
    # The reference's bare "orders join products where orders.sku = products.sku":
    # Catalyst turns the filtered cross product into an equi join.
    tables.staging_orders(spark, sf_dir).createOrReplaceTempView("wl_orders")
    tables.staging_products(spark, sf_dir).createOrReplaceTempView("wl_products")
    return spark.sql(
        "SELECT orders.customer_id, orders.order_date, orders.price, orders.sku, "
        "products.product_category, products.company "
        "FROM wl_orders orders JOIN wl_products products WHERE orders.sku = products.sku"
    )


@query("scan_parquet", "SELECT * FROM orders")
def q_scan_parquet(spark, sf_dir):
    return scan_parquet(spark, sf_dir, "orders")


PRODUCTS_SQL = """
SELECT p_brand AS company, p_name AS link, p_retailprice AS price, p_type AS product_category,
       CAST(NULL AS VARCHAR) AS release_date, CAST(p_partkey AS VARCHAR) AS sku FROM part
"""


@query("scan_table", PRODUCTS_SQL)
def q_scan_table(spark, sf_dir):
    # A table of the catalog with its declared columns, scanned by name.
    ddl = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_retailprice DOUBLE"
    return tables.products_of(tables.external_table(
        spark, f"cat_part_{_tag(sf_dir)}", ddl, tables.table_path(sf_dir, "part")))


@query("external_table", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def q_external_table(spark, sf_dir):
    ddl = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
           "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
    return tables.external_table(
        spark, f"ext_orders_{_tag(sf_dir)}", ddl, tables.table_path(sf_dir, "orders"))


ORDER_LINES_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS customer_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       l_extendedprice AS price, CAST(l_partkey AS VARCHAR) AS sku
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
CUSTOMERS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_mktsegment AS segment, n_name AS state, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
DEMOGRAPHICS_SQL = """
SELECT n_nationkey::BIGINT AS geoid, n_name AS state, count(*)::INTEGER AS population,
       (count(*) FILTER (c_acctbal > 0))::INTEGER AS households,
       CAST(sum(CAST(c_acctbal AS DECIMAL(38,2))) AS DOUBLE) AS household_income
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
"""


def _declared(spark, sf_dir, name: str, rows) -> DataFrame:
    """``rows`` landed as Parquet files, declared as an external table of the staging database and scanned by name."""
    tables.create_database(spark, "staging", "retail staging", {"creator": "wardlake"})
    path = fresh_path(spark, name)
    rows.write.parquet(path)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return tables.external_table(spark, f"staging.{name}_{_tag(sf_dir)}", ddl, path)


@query("external_orders", ORDER_LINES_SQL)
def q_external_orders(spark, sf_dir):
    return _declared(spark, sf_dir, "orders", tables.staging_orders(spark, sf_dir))


@query("external_products", PRODUCTS_SQL)
def q_external_products(spark, sf_dir):
    return _declared(spark, sf_dir, "products", tables.staging_products(spark, sf_dir))


@query("external_customers", CUSTOMERS_SQL)
def q_external_customers(spark, sf_dir):
    return _declared(spark, sf_dir, "customers", tables.staging_customers(spark, sf_dir))


@query("external_demographics", DEMOGRAPHICS_SQL)
def q_external_demographics(spark, sf_dir):
    return _declared(spark, sf_dir, "demographics", tables.staging_demographics(spark, sf_dir))


IMPRESSION_COLS_SQL = """
strftime(ts, '%Y-%m-%d %H:%M:%S') AS request_begin_time,
json_extract_string(props, '$.k') AS ad_id,
CAST(event_id AS VARCHAR) AS impression_id,
event_type AS page,
CAST(NULL AS VARCHAR) AS user_agent,
CAST(user_id AS VARCHAR) AS user_cookie,
CAST(NULL AS VARCHAR) AS ip_address,
event_type = 'click' AS clicked
"""


def _land_impressions(spark, sf_dir):
    """Land impressions partitioned by day/hour and declare the table."""
    path = fresh_path(spark, "impressions")
    imp = impressions(spark, sf_dir)
    # One shuffle on (day, hour, small salt): each task writes whole
    # partitions (few files per directory); the salt splits a hot hour
    # over several writers instead of one.
    salt = F.pmod(F.xxhash64("impression_id"), F.lit(4))
    (imp.repartition("day", "hour", salt).write.mode("overwrite")
        .option("maxRecordsPerFile", 5_000_000).partitionBy("day", "hour").parquet(path))
    name = f"tblimpressions_{_tag(sf_dir)}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} (request_begin_time STRING, ad_id STRING, impression_id STRING, "
        "page STRING, user_agent STRING, user_cookie STRING, ip_address STRING, clicked BOOLEAN, "
        f"day STRING, hour STRING) USING parquet PARTITIONED BY (day, hour) LOCATION '{path}'"
    )
    # SRC-05: partitions written outside the catalog are discovered here.
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


@query("partitioned_scan", f"""
SELECT {IMPRESSION_COLS_SQL}, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour
FROM events WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-08' AND '2024-01-14'
""")
def q_partitioned_scan(spark, sf_dir):
    name = _land_impressions(spark, sf_dir)
    # The predicate is on partition columns only: pruned at planning time.
    return spark.table(name).where("day BETWEEN '2024-01-08' AND '2024-01-14'")


@query("recover_partitions", """
SELECT DISTINCT 'day=' || strftime(ts, '%Y-%m-%d') || '/hour=' || strftime(ts, '%H') AS partition FROM events
""")
def q_recover_partitions(spark, sf_dir):
    name = _land_impressions(spark, sf_dir)
    return spark.sql(f"SHOW PARTITIONS {name}")


TSV_SCHEMA = "request_begin_time STRING, ad_id STRING, impression_id STRING, page STRING, " \
             "user_agent STRING, ip_address STRING, clicked BOOLEAN, user_cookie STRING"


def _land_per_user(spark, sf_dir):
    path = fresh_path(spark, "per_user")
    df = impressions(spark, sf_dir).drop("day", "hour")
    sinks.land_per_owner(df, "user_cookie", path, fmt="csv")
    return path


@query("per_user_landing", """
SELECT CAST(user_id AS VARCHAR) AS user_cookie, count(*) AS n_rows FROM events GROUP BY user_id
""")
def q_per_user_landing(spark, sf_dir):
    # The owner's type comes from the declared schema.
    path = _land_per_user(spark, sf_dir)
    back = spark.read.option("sep", "\t").schema(TSV_SCHEMA).csv(path)
    return back.groupBy("user_cookie").agg(F.count(F.lit(1)).alias("n_rows"))


@query("scan_tsv", f"SELECT {IMPRESSION_COLS_SQL} FROM events")
def q_scan_tsv(spark, sf_dir):
    path = _land_per_user(spark, sf_dir)
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(TSV_SCHEMA)
    back = tables.scan_tsv(spark, path, schema)
    return back.select("request_begin_time", "ad_id", "impression_id", "page", "user_agent",
                       "user_cookie", "ip_address", "clicked")


@query("save_table_overwrite", SALES_SQL)
def q_save_table_overwrite(spark, sf_dir):
    tables.create_database(spark, "processed", "Rolled-up sales", {"team": "dataengineer"})
    name = f"processed.sales_{_tag(sf_dir)}"
    path = fresh_path(spark, "processed_sales")
    sinks.save_table_overwrite(_sales(spark, sf_dir), name, path)
    # A second overwrite of the same table replaces, never appends.
    sinks.save_table_overwrite(_sales(spark, sf_dir), name, path)
    return spark.table(name)


@query("ctas_rollup", CATEGORY_SQL)
def q_ctas_rollup(spark, sf_dir):
    tag = _tag(sf_dir)
    src = f"sales_src_{tag}"
    _sales(spark, sf_dir).createOrReplaceTempView(src)
    return sinks.ctas_rollup(
        spark, f"sales_breakup_{tag}", fresh_path(spark, "sales_breakup"),
        f"SELECT product_category, CAST(sum(CAST(total_sales AS DECIMAL(38,2))) AS DOUBLE) AS total_sales "
        f"FROM {src} GROUP BY product_category",
    )


@query("project_columns", """
SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS order_date, l.l_extendedprice AS price,
       CAST(l.l_partkey AS VARCHAR) AS sku
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def q_project_columns(spark, sf_dir):
    return tables.staging_orders(spark, sf_dir).select("order_date", "price", "sku")


@query("project_star", """
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS name, c.c_mktsegment AS segment,
       n.n_name AS state, r.r_name AS region
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_project_star(spark, sf_dir):
    return tables.staging_customers(spark, sf_dir).select("*")


KEYED_SQL = f"""
SELECT ad_id, request_begin_time, impression_id, page, user_agent, user_cookie, ip_address, clicked FROM (
  SELECT {IMPRESSION_COLS_SQL}, ts, event_id FROM events)
QUALIFY row_number() OVER (PARTITION BY ad_id ORDER BY request_begin_time DESC, event_id DESC) = 1
"""


def _keyed(spark, sf_dir):
    imp = impressions(spark, sf_dir).drop("day", "hour")
    keyed = imp.select("ad_id", *[c for c in imp.columns if c != "ad_id"])  # PRJ-03
    return sinks.keep_latest_per_key(
        keyed.withColumn("_id", F.col("impression_id").cast("bigint")), "ad_id",
        ["request_begin_time", "_id"]).drop("_id")


@query("insert_overwrite_keyed", KEYED_SQL)
def q_insert_overwrite_keyed(spark, sf_dir):
    path = fresh_path(spark, "keyed_impressions")
    _keyed(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("reorder_key_first", f"""
SELECT ad_id, request_begin_time, impression_id, page, user_agent, user_cookie, ip_address, clicked
FROM (SELECT {IMPRESSION_COLS_SQL} FROM events)
""")
def q_reorder_key_first(spark, sf_dir):
    imp = impressions(spark, sf_dir).drop("day", "hour")
    return imp.select("ad_id", *[c for c in imp.columns if c != "ad_id"])


@query("column_family_map", f"""
SELECT ad_id AS rowkey, request_begin_time AS "analyst1:request_begin_time",
       impression_id AS "analyst1:impression_id", page AS "analyst1:page",
       user_agent AS "analyst1:user_agent", user_cookie AS "analyst1:user_cookie",
       ip_address AS "analyst1:ip_address", clicked AS "analyst1:clicked"
FROM ({KEYED_SQL})
""")
def q_column_family_map(spark, sf_dir):
    fam = sinks.to_column_families(_keyed(spark, sf_dir), "ad_id", "analyst1")
    quals = fam.schema["analyst1"].dataType.fieldNames()
    return fam.select("rowkey", *[F.col(f"analyst1.{q}").alias(f"analyst1:{q}") for q in quals])


@query("filter_equality", f"SELECT {IMPRESSION_COLS_SQL} FROM events WHERE event_type = 'click'")
def q_filter_equality(spark, sf_dir):
    # FLT-01: the predicate is data (a policy's filterExpr), parsed by Spark.
    expr = "page = 'click'"
    return impressions(spark, sf_dir).drop("day", "hour").where(F.expr(expr))


@query("limit_n", PRODUCTS_SQL + " ORDER BY sku LIMIT 10")
def q_limit_n(spark, sf_dir):
    return retail.limit_n(tables.staging_products(spark, sf_dir), 10, ["sku"])


@query("top_k", SALES_SQL + " ORDER BY total_sales DESC, sku LIMIT 10")
def q_top_k(spark, sf_dir):
    return retail.top_k(_sales(spark, sf_dir), 10, "total_sales", ["sku"])


# Lookups for LIM-04 (label, glob over "<priority>/<status>").
LOOKUPS = [
    ("urgent-open", "1-URGENT/O"),
    ("high-any", "2-HIGH/*"),
    ("any-finished", "*/F"),
    ("any-pending", "?-*/P"),
    ("none", "9-*"),
]


def _lookup_values_sql() -> str:
    rows = ", ".join(f"('{a}', '{b}')" for a, b in LOOKUPS)
    return f"(VALUES {rows}) AS r(label, pattern)"


@query("latest_matching", lambda: f"""
WITH items AS (SELECT o_orderkey, o_orderpriority || '/' || o_orderstatus AS name, o_orderdate FROM orders)
SELECT r.label, i.o_orderkey, i.name, i.o_orderdate
FROM items i JOIN {_lookup_values_sql()} ON i.name GLOB r.pattern
QUALIFY row_number() OVER (PARTITION BY r.label ORDER BY i.o_orderdate DESC, i.name DESC, i.o_orderkey DESC) = 1
""")
def q_latest_matching(spark, sf_dir):
    items = scan_parquet(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("name"), "o_orderdate")
    reqs = spark.createDataFrame(LOOKUPS, "label string, glob string")
    return retail.latest_matching(items, reqs, "name", ["o_orderdate", "name", "o_orderkey"], bound=len(LOOKUPS))
