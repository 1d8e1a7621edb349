"""Directory entries (LDIF) as a text source and the operators over them.

Records are blank-line separated; the reader splits on the record separator
so one record is one row, and every step after that is column functions,
explodes and aggregates. Group membership is kept as one modify record per
(group, member), never as one record holding a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.sources.tables import read_order


def read_ldif(spark: SparkSession, path: str, record_sep: str = "\n\n") -> DataFrame:
    """SRC-08: one row per record with ``seq``, its place in read order (see ``split_records``).

    The reader splits a file at ``record_sep``; for large exports with CRLF lines pass ``"\\r\\n\\r\\n"``, else such a
    file is one row until it is split here.
    """
    return split_records(spark.read.option("lineSep", record_sep).text(path).select("value", "_metadata"))


def split_records(raw: DataFrame, batch: int = 0) -> DataFrame:
    """(record, seq) of ``raw(value, _metadata)``: blank lines, with either line end, part records.

    ``seq`` is the read order of the row and the place of the record in it.
    """
    rows = raw.select(read_order(batch).alias("at"), "value")
    return (rows.select("at", F.posexplode(F.split("value", "(\r?\n){2,}")).alias("pos", "text"))
            .where(F.trim("text", F.lit(" \r\n")) != "")
            .select(F.regexp_replace("text", "^[\r\n]+|[ \r\n]+$", "").alias("record"),
                    F.struct("at", "pos").alias("seq")))


def _value(line):
    """``attr: text``, ``attr:: base64`` or ``attr:`` (an empty value)."""
    text = F.regexp_extract(line, r"^[^:]*::? *(.*)$", 1)
    return F.when(line.rlike("^[^:]*::"), F.try_to_binary(text, F.lit("base64")).cast("string")).otherwise(text)


def _once(c, fn):
    """``fn`` of ``c``, worked out once: a column named inside a lambda is worked out again for each element."""
    return F.get(F.transform(F.array(c), fn), F.lit(0))


def _kv(lines):
    return F.transform(
        F.filter(lines, lambda x: (x != "") & (x != "-") & ~x.startswith("#")),
        lambda x: F.struct(F.lower(F.substring_index(x, ":", 1)).alias("k"), _value(x).alias("v")))


def _attributes(kv):
    """map<key, array<value>> of the lines of a record."""
    def of(kv, keys):
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(
            F.filter(kv, lambda x: x["k"] == k), lambda x: x["v"])))
    return _once(kv, lambda kv: _once(F.array_distinct(F.transform(kv, lambda x: x["k"])), lambda keys: of(kv, keys)))


OPS = ["add", "replace", "delete"]


def _operations(text):
    """The operations of a modify record in order: each is ``<op>: <attr>`` and the values after it, up to a ``-`` line."""
    def one(chunk, i):
        def of(kv, attr):
            vals = F.transform(F.filter(kv, lambda x: x["k"] == attr), lambda x: x["v"])
            return F.struct(i.alias("no"), F.get(kv, F.lit(0))["k"].alias("op"), attr.alias("attr"), vals.alias("vals"))
        return _once(F.filter(_kv(F.split(chunk, "\r?\n")), lambda x: ~x["k"].isin("dn", "changetype")),
                     lambda kv: _once(F.lower(F.trim(F.get(kv, F.lit(0))["v"])), lambda attr: of(kv, attr)))
    return F.filter(F.transform(F.split(text, r"\r?\n-[ \t]*(?=\r?\n|$)"), one), lambda x: x["op"].isin(OPS))


def parse_entries(records: DataFrame) -> DataFrame:
    """DIR-01: (seq, dn, changetype, op, op_attr, ops, attributes map<key, array<value>>).

    A line that begins with a space continues the one before. A record without ``changetype`` is a content record and
    counts as an add. ``ops`` holds every operation of a modify record; ``op`` and ``op_attr`` are the first one's.
    """
    text = F.regexp_replace("record", "\r?\n ", "")
    df = records.select("seq", text.alias("text"))
    df = df.select("seq", "text", _attributes(_kv(F.split("text", "\r?\n"))).alias("attributes"))
    kind = F.coalesce(F.lower(F.trim(F.get(F.col("attributes")["changetype"], F.lit(0)))), F.lit("add"))
    df = df.withColumn("changetype", kind)
    df = df.withColumn("ops", F.when(F.col("changetype") == "modify", _operations(F.col("text"))))
    first = F.get("ops", F.lit(0))
    return df.select("seq", F.get(F.col("attributes")["dn"], F.lit(0)).alias("dn"), "changetype",
                     first["op"].alias("op"), first["attr"].alias("op_attr"), "ops", "attributes")


def dn_first_rdn(dn):
    """DIR-03: value of the leading CN= of a DN."""
    return F.regexp_extract(dn, r"(?i)^CN=([^,]+)", 1)


def under_base(dn, base: str):
    return F.lower(dn).endswith(base.lower())


def _salted_left(big: DataFrame, small: DataFrame, on: list[str], salts: int) -> DataFrame:
    """``big`` carries ``_salt``; the small side is copied once per salt."""
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.join(copies, [*on, "_salt"], "left")


def changes_of(entries: DataFrame) -> DataFrame:
    """(dn, attr, value, kind, at): what the records say, with the place of the record and of its operation.

    kind: ``put`` and ``cut`` of a value, ``reset`` of an attribute (NULL value), ``gone`` of an entry (NULL attr and
    value). Of each only the latest is kept, combined before the shuffle; the records are read once. Renames (``modrdn``, ``moddn``) are not
    supported and raise.
    """
    known = F.col("changetype").isin("add", "modify", "delete")
    entries = entries.withColumn("changetype", F.when(known, F.col("changetype")).otherwise(
        F.raise_error(F.concat(F.lit("changetype not supported: "), F.col("changetype"))).cast("string")))
    no_op, none = F.lit(-1).cast("int"), F.lit(None).cast("string")

    def said(attr, value, kind, no):
        return F.struct(attr.alias("attr"), value.alias("value"), kind.alias("kind"), no.alias("no"))

    def of(s):
        cuts = s["op"] == "delete"
        values = F.transform(s["vals"], lambda v: said(s["attr"], v, F.when(cuts, "cut").otherwise("put"), s["no"]))
        reset = F.array(said(s["attr"], none, F.lit("reset"), s["no"]))
        return F.concat(values, F.when((s["op"] == "replace") | (cuts & (F.size(s["vals"]) == 0)), reset)
                        .otherwise(F.slice(reset, 1, 0)))

    kept = F.filter(F.map_entries("attributes"), lambda e: ~e["key"].isin("dn", "changetype"))
    base = F.transform(kept, lambda e: F.struct(no_op.alias("no"), F.lit("add").alias("op"), e["key"].alias("attr"),
                                                e["value"].alias("vals")))
    steps = F.when(F.col("changetype") == "add", base).otherwise(F.col("ops"))
    gone = F.array(said(none, none, F.lit("gone"), no_op))
    rows = F.when(F.col("changetype") == "delete", gone).otherwise(F.flatten(F.transform(steps, of)))
    return (entries.select("dn", "seq", F.explode(rows).alias("s"))
            .select("dn", "s.attr", "s.value", "s.kind", F.struct("seq", "s.no").alias("at"))
            .groupBy("dn", "attr", "value", "kind").agg(F.max("at").alias("at")))


def settle(changes: DataFrame) -> DataFrame:
    """The values that stand, as puts: rows of ``changes_of`` that say the same to whatever comes after them.

    A value stands when its last put is later than the last cut of it, reset of its attribute and end of its entry.
    Changes that all come later need only these rows, so a stream keeps them in place of all it has read. The rare
    resets join the values salted, so the members of one big group spread over the cores.
    """
    salts = max(2, changes.sparkSession.sparkContext.defaultParallelism)
    at = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("at")))
    values = (changes.where(F.col("kind").isin("put", "cut")).groupBy("dn", "attr", "value")
              .agg(at("put").alias("put"), at("cut").alias("cut"))
              .where(F.col("put").isNotNull() & (F.col("cut").isNull() | (F.col("put") > F.col("cut"))))
              .withColumn("_salt", F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int")))
    resets = changes.where(F.col("kind") == "reset").groupBy("dn", "attr").agg(F.max("at").alias("reset"))
    gone = changes.where(F.col("kind") == "gone").groupBy("dn").agg(F.max("at").alias("gone"))
    # A replace resets its attribute and puts at the same step, so >= keeps its own values.
    return (_salted_left(_salted_left(values, resets, ["dn", "attr"], salts), gone, ["dn"], salts)
            .where((F.col("reset").isNull() | (F.col("put") >= F.col("reset")))
                   & (F.col("gone").isNull() | (F.col("put") > F.col("gone"))))
            .select("dn", "attr", "value", F.lit("put").alias("kind"), F.col("put").alias("at")))


def apply_changes(entries: DataFrame) -> DataFrame:
    """DIR-02: (dn, attr, value) after all records, in the order of ``seq`` and of the operations in a record.

    Add records and ``add:`` put values, ``replace:`` puts its values in place of all earlier ones, ``delete:`` with
    values takes those away and without values the whole attribute, ``changetype: delete`` the whole entry.
    """
    return settle(changes_of(entries)).select("dn", "attr", "value")
