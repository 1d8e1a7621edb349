"""Reading the lake: Parquet directories, catalog tables, external tables.

The retail jobs work on four staging tables (orders, products, customers,
impressions). Here they are *views* over the driver's TPC-H-like Parquet files,
so every column pick and predicate still reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def scan_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC-01: a Parquet directory (schema from the footer)."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_order(batch: int = 0):
    """Place of a row in read order: (batch, file, start of the split, row in the task), of a frame with ``_metadata``.

    Tasks take files in any order, so a row number alone is not read order: it counts only within one split of a file.
    """
    return F.struct(F.lit(batch).cast("long").alias("batch"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))


# --- staging views in the shape of the retail tables --------------------

def staging_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders(customer_id, order_date, price, sku): one row per order line."""
    li = scan_parquet(spark, sf_dir, "lineitem")
    o = scan_parquet(spark, sf_dir, "orders")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        .select(
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_partkey").cast("string").alias("sku"),
        )
    )


def staging_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """products(company, link, price, product_category, release_date, sku)."""
    return products_of(scan_parquet(spark, sf_dir, "part"))


def products_of(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_brand").alias("company"),
        F.col("p_name").alias("link"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("product_category"),
        F.lit(None).cast("string").alias("release_date"),
        F.col("p_partkey").cast("string").alias("sku"),
    )


def staging_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers(customer_id, name, segment, state, region)."""
    c = scan_parquet(spark, sf_dir, "customer")
    n = scan_parquet(spark, sf_dir, "nation")
    r = scan_parquet(spark, sf_dir, "region")
    # nation/region are fixed-size dimensions (25/5 rows): broadcast is bounded.
    return (
        c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
        .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("region"),
        )
    )


def staging_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """demographics(geoid, state, population, households, household_income): customers of a nation as its people.

    Households are customers with a positive balance; incomes are summed as decimals, so their order changes no cent.
    """
    counted = scan_parquet(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).cast("int").alias("population"),
        F.count(F.when(F.col("c_acctbal") > 0, 1)).cast("int").alias("households"),
        F.sum(F.col("c_acctbal").cast("decimal(38,2)")).cast("double").alias("household_income"))
    n = scan_parquet(spark, sf_dir, "nation")  # 25 rows
    return counted.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_nationkey").cast("long").alias("geoid"), F.col("n_name").alias("state"), "population", "households",
        "household_income")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad-impression table derived from ``events``.

    request_begin_time <- ts, ad_id <- props.k, impression_id <- event_id,
    page <- event_type, user_cookie <- user_id, clicked <- event_type='click',
    partitions day/hour from ts.
    """
    e = scan_parquet(spark, sf_dir, "events")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("request_begin_time"),
        F.get_json_object("props", "$.k").alias("ad_id"),
        F.col("event_id").cast("string").alias("impression_id"),
        F.col("event_type").alias("page"),
        F.lit(None).cast("string").alias("user_agent"),
        F.col("user_id").cast("string").alias("user_cookie"),
        F.lit(None).cast("string").alias("ip_address"),
        (F.col("event_type") == "click").alias("clicked"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "HH").alias("hour"),
    )


def create_database(spark: SparkSession, name: str, comment: str, props: dict[str, str]) -> None:
    """SNK-04: database with a comment and properties."""
    kv = ", ".join(f"'{k}'='{v}'" for k, v in props.items())
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}' WITH DBPROPERTIES ({kv})"
    )


def external_table(spark: SparkSession, name: str, ddl: str, location: str) -> DataFrame:
    """SRC-03: declare a typed, unmanaged Parquet table at a location.

    The declared schema is used as is (no inference); columns missing in the
    files read as NULL, as for any external table.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{location}'")
    return spark.table(name)


def scan_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-06: tab-separated files with a declared schema (no inference)."""
    return (
        spark.read.option("sep", "\t").option("header", "false").option("mode", "PERMISSIVE")
        .schema(schema).csv(path)
    )


def jdbc_options(props_text: str, table: str, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int = 64) -> dict[str, str]:
    """SRC-09: connector properties (key=value lines) -> Spark JDBC options.

    A partitioned read splits ``partition_column`` into ``num_partitions``
    ranges so no single task pulls the whole remote table.
    """
    kv = {}
    for line in props_text.splitlines():
        line = line.strip()
        if not line or line.startswith("#") or "=" not in line:
            continue
        k, v = line.split("=", 1)
        kv[k.strip()] = v.strip()
    opts = {"dbtable": table}
    for src, dst in (("connection-url", "url"), ("connection-user", "user"),
                     ("connection-password", "password"), ("url", "url"),
                     ("user", "user"), ("password", "password"), ("driver", "driver")):
        if src in kv:
            opts[dst] = kv[src]
    if partition_column:
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    opts.setdefault("fetchsize", "10000")
    return opts


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
