"""Tag sets (GOV-12) and their binding to resources (JN-05).

A tag set document carries tag definitions, tags, service resources and the
resource -> tag-id map, with a version; ``op: replace`` means the newest
version of a service replaces the older ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAGSET = T.StructType([
    T.StructField("op", T.StringType()), T.StructField("tagVersion", T.IntegerType()),
    T.StructField("serviceName", T.StringType()),
    T.StructField("tagDefinitions", T.MapType(T.StringType(), T.StructType([
        T.StructField("name", T.StringType()), T.StructField("guid", T.StringType()),
        T.StructField("id", T.IntegerType())]))),
    T.StructField("tags", T.MapType(T.StringType(), T.StructType([
        T.StructField("guid", T.StringType()), T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("id", T.IntegerType()), T.StructField("type", T.StringType())]))),
    T.StructField("serviceResources", T.ArrayType(T.StructType([
        T.StructField("resourceElements", T.MapType(T.StringType(), T.StructType([
            T.StructField("values", T.ArrayType(T.StringType()))]))),
        T.StructField("guid", T.StringType()), T.StructField("id", T.IntegerType()),
        T.StructField("serviceName", T.StringType())]))),
    T.StructField("resourceToTagIds", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
])


def read_tagsets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TAGSET).option("mode", "FAILFAST").json(path)


def latest_tagsets(ts: DataFrame) -> DataFrame:
    """``op: replace``: keep only the greatest version per service."""
    newest = ts.groupBy("serviceName").agg(F.max("tagVersion").alias("tagVersion"))
    return ts.join(newest, ["serviceName", "tagVersion"], "left_semi")


def tag_bindings(ts: DataFrame) -> DataFrame:
    """(service, version, res_id, level, pattern, tag) for every tagged resource."""
    r2t = (ts.select("serviceName", "tagVersion", F.explode("resourceToTagIds").alias("res_id", "tag_ids"))
           .select("serviceName", "tagVersion", F.col("res_id").cast("int").alias("res_id"),
                   F.explode("tag_ids").alias("tag_id")))
    tags = (ts.select("serviceName", "tagVersion", F.explode("tags").alias("k", "t"))
            .select("serviceName", "tagVersion", F.col("t.id").alias("tag_id"), F.col("t.type").alias("tag")))
    res = (ts.select("serviceName", "tagVersion", F.explode("serviceResources").alias("r"))
           .select("serviceName", "tagVersion", F.col("r.id").alias("res_id"),
                   F.explode("r.resourceElements").alias("level", "el"))
           .select("serviceName", "tagVersion", "res_id", "level", F.explode("el.values").alias("pattern")))
    keys = ["serviceName", "tagVersion"]
    return (r2t.join(tags, [*keys, "tag_id"]).join(res, [*keys, "res_id"])
            .select(F.col("serviceName").alias("service"), F.col("tagVersion").alias("version"),
                    "res_id", "level", "pattern", "tag"))


def as_resources(bindings: DataFrame) -> DataFrame:
    """Tag bindings in the policy-resource shape (res_id as the 'policy')."""
    return bindings.select(F.col("res_id").cast("long").alias("policy_id"), "service", "level", "pattern",
                           F.lit(False).alias("excludes"), F.lit(False).alias("recursive")).distinct()
