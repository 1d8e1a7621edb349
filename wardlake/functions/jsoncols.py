"""JSON held in columns: strict parse with quarantine, canonical text,
non-finite numbers, and a walk of nested documents (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.session import cut_lineage


def parse_strict(c: Column) -> Column:
    """A VARIANT, or NULL when the text is not exactly one JSON value.

    The parser stops after the first complete value, so the text is parsed inside an object and inside an array
    too: text after the value, such as ``["x"]]`` or ``1, 2``, breaks one of them.
    """
    member = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    element = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return F.when(member.isNotNull() & element.isNotNull(), F.try_parse_json(c))


def quarantine(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``_json``, bad rows) split on one parse."""
    parsed = df.withColumn("_json", parse_strict(F.col(col)))
    return parsed.where(F.col("_json").isNotNull()), parsed.where(F.col("_json").isNull()).drop("_json")


def canonical_text(c: Column) -> Column:
    """The JSON text with the keys of every object sorted, at any depth, NULL members kept, numbers without
    trailing zeros and white space gone; NULL for what is not one JSON value. A VARIANT holds the fields of an object by name."""
    return F.to_json(parse_strict(c))


def canonical(cols: list[str]) -> Column:
    """JSON text of the named columns, canonical at any depth."""
    return canonical_text(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))


def parse_nonfinite(c: Column, schema: str) -> Column:
    """NaN / Infinity / -Infinity accepted as numbers."""
    return F.from_json(c, schema, {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE"})


def flatten(docs: DataFrame, id_cols: list[str], col: str) -> DataFrame:
    """(id..., path, type, value) for every scalar, NULL or empty container of JSON documents, at any depth.

    path: ``$.a[0].b``; type: string, number, boolean, null, object or array (the last two only when empty); value:
    its text, NULL for null and empty containers. Containers are opened level by level on all documents at once, until
    no level holds one, so there are as many rounds as the deepest document has levels. Texts that are not one JSON
    value give no rows.
    """
    spark = docs.sparkSession
    front = docs.select(*id_cols, F.lit("$").alias("path"), parse_strict(F.col(col)).alias("v")).where("v IS NOT NULL")
    leaves = None
    while True:
        kind = F.col("_schema")
        typed = cut_lineage(front.withColumn("_schema", F.schema_of_variant("v")).withColumn("kind", F.when(kind.startswith("OBJECT"), "object").when(
            kind.startswith("ARRAY"), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(
            kind == "VOID", "null").otherwise("number")).withColumn("opened", F.col("kind").isin("object", "array") & ~(
                (kind == "OBJECT<>") | ((kind == "ARRAY<VOID>") & (F.to_json("v") == "[]")))).drop("_schema"), name="json_level")
        opened = F.col("opened")
        here = typed.where(~opened).select(*id_cols, "path", F.col("kind").alias("type"), F.when(
            F.col("kind").isin("string", "number", "boolean"), F.variant_get("v", "$", "string")).alias("value"))
        leaves = here if leaves is None else leaves.unionByName(here)
        boxes = typed.where(opened)
        if boxes.limit(1).count() == 0:
            return leaves
        step = F.when(F.col("kind") == "object", F.concat(F.lit("."), F.col("key"))).otherwise(
            F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        front = boxes.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
            *id_cols, F.concat("path", step).alias("path"), F.col("value").alias("v"))
