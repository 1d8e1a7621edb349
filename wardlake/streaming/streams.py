"""Structured Streaming jobs (STR-01..05).

Every job reads a file source, runs the same column operators as the batch
code, and writes through ``foreachBatch`` into a directory per batch id, so
a re-run of a batch after a failure overwrites its own output (idempotent
on ``batchId``). Checkpoints and outputs live under the shared folder.
Production triggers are processing-time (30 s for tag files); tests and the
registered queries use ``availableNow`` so a run drains the input and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators import directory as d
from wardlake.operators import policylog as pl
from wardlake.operators import tags as tg
from wardlake.operators.access import decide_requests
from wardlake.sources.tables import read_order


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names under ``path`` through the Hadoop file system (works on any store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def committed(spark: SparkSession, out: str, name: str = "batch") -> list[str]:
    """The ``<name>=<id>`` folders under ``out`` whose write ended (they hold the success marker), by id."""
    ids = sorted(int(n.split("=")[1]) for n in list_children(spark, out) if n.startswith(f"{name}="))
    paths = [f"{out}/{name}={i}" for i in ids]
    return [p for p in paths if "_SUCCESS" in list_children(spark, p)]


def read_batches(spark: SparkSession, out: str, like: DataFrame) -> DataFrame:
    """All batches written to ``out``; without any, no rows with the columns of ``like``."""
    paths = committed(spark, out)
    return spark.read.schema(like.schema).parquet(*paths) if paths else spark.createDataFrame([], like.schema)


def run(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
        available_now: bool = True, processing_time: str | None = None) -> None:
    """Run ``stream``; with ``available_now`` until all input there is has been processed, however long, and an
    error of the query is raised: a part of the result never passes for the whole."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()


def batch_writer(out: str, fmt: str = "parquet"):
    """foreachBatch sink: one directory per batch id, overwritten on replay."""
    def fn(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{out}/batch={batch_id}")
    return fn


# --- keyed state, folded and compacted ---------------------------------------

#: Batches after which a stream folds its state anew.
COMPACT_EVERY = 8


def _numbers(spark: SparkSession, out: str, name: str) -> list[int]:
    return [int(p.rsplit("=", 1)[1]) for p in committed(spark, out, name)]


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def state_parts(spark: SparkSession, out: str, before: int | None = None) -> list[str]:
    """The folders that make up the state: the newest base (older than batch ``before``) and the batches after it."""
    bases = [i for i in _numbers(spark, out, "base") if before is None or i < before]
    base = max(bases, default=-1)
    parts = [f"{out}/base={base}"] if bases else []
    return parts + [f"{out}/batch={i}" for i in _numbers(spark, out, "batch") if i > base and (before is None or i <= before)]


def fold_batch(delta: DataFrame, batch_id: int, out: str, fold: Callable[[DataFrame], DataFrame],
               closed: Callable[[DataFrame], Column] | None = None, every: int = COMPACT_EVERY) -> None:
    """Add the batch's own state rows to ``out``; each ``every`` batches, fold base and batches into a new base.

    So a run reads the state and at most ``every`` batches, however many there were. ``closed`` tells which folded
    rows are done: they leave the state for ``closed=<batch>``, which is only ever read for the result. All folders are
    named by batch and overwritten on replay; what a new base replaces is kept until the base after it.
    """
    spark = delta.sparkSession
    delta.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    if (batch_id + 1) % every:
        return
    parts = state_parts(spark, out, batch_id)
    if f"{out}/batch={batch_id}" not in parts:
        parts.append(f"{out}/batch={batch_id}")
    merged = fold(spark.read.schema(delta.schema).parquet(*parts))
    if closed is not None:
        done = closed(merged)
        merged.where(done).write.mode("overwrite").parquet(f"{out}/closed={batch_id}")
        merged = merged.where(~F.coalesce(done, F.lit(False)))
    merged.write.mode("overwrite").parquet(f"{out}/base={batch_id}")
    bases = _numbers(spark, out, "base")
    kept = bases[-2] if len(bases) > 1 else -1
    for name, last in (("batch", kept), ("base", kept - 1)):
        for i in _numbers(spark, out, name):
            if i <= last:
                _remove(spark, f"{out}/{name}={i}")


def read_state(spark: SparkSession, out: str, like: DataFrame, fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """State and closed rows, folded; without any, no rows with the columns of ``like``."""
    parts = state_parts(spark, out) + committed(spark, out, "closed")
    return fold(spark.read.schema(like.schema).parquet(*parts)) if parts else spark.createDataFrame([], like.schema)


# --- STR-01: policy-change lines -> parsed events --------------------------

def _file_stream(spark: SparkSession, files_per_trigger: int | None):
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader


def policy_change_stream(spark: SparkSession, log_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parsed policy lines with ``_metadata``; a batch takes ``files_per_trigger`` files (None: all there are)."""
    lines = _file_stream(spark, files_per_trigger).text(log_dir).select("value", "_metadata")
    kept = lines.where(pl.positional_filter(F.col("value")))
    p = pl.parse_header(kept)
    return pl.extract_policy_fields(p).withColumn("kind", pl.event_kind(F.col("message")))


def stream_policy_changes(spark: SparkSession, log_dir: str, out: str, checkpoint: str,
                          files_per_trigger: int | None = None) -> DataFrame:
    s = policy_change_stream(spark, log_dir, files_per_trigger).select("policy_id", "kind", "service", "log_ts")
    run(s, batch_writer(out), checkpoint)
    return read_batches(spark, out, s)


# --- STR-02: grant state, replaced by Sid -----------------------------------

def stream_grant_state(spark: SparkSession, log_dir: str, state_dir: str, checkpoint: str,
                       files_per_trigger: int | None = None, every: int = COMPACT_EVERY) -> DataFrame:
    """The newest statement per (doc, sid) by log time, then read order, whatever the batch it came in.

    A batch writes only its own newest statements with their time and order; every ``every`` batches they are folded
    into the state. A replayed batch overwrites its folder.
    """
    stream = policy_change_stream(spark, log_dir, files_per_trigger)

    def statements(df: DataFrame, batch_id: int) -> DataFrame:
        return pl.latest_statements(pl.grants_object_store(df.withColumn("seq", read_order(batch_id))))

    run(stream, lambda df, batch_id: fold_batch(statements(df, batch_id), batch_id, state_dir, pl.latest_statements, every=every),
        checkpoint)
    empty = spark.read.schema("value string").text(log_dir).select("value", "_metadata").limit(0)
    p = pl.extract_policy_fields(pl.parse_header(empty)).withColumn("kind", pl.event_kind(F.col("message")))
    return read_state(spark, state_dir, statements(p, 0), pl.latest_statements)


# --- STR-03: audit summary over a stream of requests ------------------------

def stream_audit_summary(spark: SparkSession, stream: DataFrame, decide_fn: Callable[[DataFrame], DataFrame],
                         key_cols: list[str], out: str, checkpoint: str, window: str = "1 hour",
                         delay: str = "1 day", every: int = COMPACT_EVERY) -> DataFrame:
    """Requests decided and counted per window.

    ``decide_fn(keys) -> keys + decision`` decides the distinct keys of each batch, so no request is lost for a key
    that was not known beforehand. The state holds the counts of open windows: a window that ended ``delay`` before the
    newest request of the state is closed when the state is folded and is not read again by the stream. A request that
    comes later still counts: it makes a row of its own for the closed window, and the result adds both up.
    """
    keys = [*key_cols, "decision", "w"]
    counts = [F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")]

    def fold(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("n_events").alias("n_events"), F.min("first_ts").alias("first_ts"),
                                     F.max("last_ts").alias("last_ts"))

    def closed(df: DataFrame) -> Column:
        newest = df.agg(F.max("last_ts")).first()[0]  # one value
        return F.col("w.end") <= F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")

    def fn(df: DataFrame, batch_id: int) -> None:
        dec = decide_fn(df.select(*key_cols).distinct()).select(*key_cols, "decision")
        delta = decide_requests(df, key_cols, dec).groupBy(*key_cols, "decision", F.window("ts", window).alias("w")).agg(*counts)
        fold_batch(delta, batch_id, out, fold, closed, every)

    run(stream, fn, checkpoint)
    like = (spark.createDataFrame([], stream.schema).withColumn("decision", F.lit(""))
            .groupBy(*key_cols, "decision", F.window("ts", window).alias("w")).agg(*counts))
    return read_state(spark, out, like, fold)


# --- STR-04: tag files re-read periodically, replace by version -------------

def stream_tag_replace(spark: SparkSession, tag_dir: str, out: str, checkpoint: str,
                       available_now: bool = True) -> DataFrame:
    """Each batch of tag documents: keep the greatest version per service
    among the batch and the current snapshot, write the new snapshot."""
    src = spark.readStream.schema(tg.TAGSET).json(tag_dir)

    def fn(df: DataFrame, batch_id: int) -> None:
        sess = df.sparkSession
        prev = [p for p in committed(sess, out, "v") if int(p.rsplit("=", 1)[1]) < batch_id]
        allv = df if not prev else df.unionByName(sess.read.parquet(prev[-1]))
        tg.latest_tagsets(allv).write.mode("overwrite").parquet(f"{out}/v={batch_id}")

    run(src, fn, checkpoint, available_now=available_now, processing_time="30 seconds")
    versions = committed(spark, out, "v")
    return spark.read.parquet(versions[-1]) if versions else spark.createDataFrame([], src.schema)


# --- STR-05: directory sync ---------------------------------------------------

def stream_directory_sync(spark: SparkSession, ldif_dir: str, out: str, checkpoint: str,
                          files_per_trigger: int | None = None, every: int = COMPACT_EVERY) -> DataFrame:
    """LDIF files arrive; the directory after all their records, in order of (batch, file, place).

    A batch writes the latest changes of its own records; every ``every`` batches they are folded into the values that
    stand, so a run reads the directory and at most ``every`` batches, not all records ever sent.
    """
    src = (_file_stream(spark, files_per_trigger).option("lineSep", "\n\n").text(ldif_dir)
           .select("value", "_metadata"))

    def fn(df: DataFrame, batch_id: int) -> None:
        fold_batch(d.changes_of(d.parse_entries(d.split_records(df, batch_id))), batch_id, out, d.settle, every=every)

    run(src, fn, checkpoint)
    like = d.changes_of(d.parse_entries(d.read_ldif(spark, ldif_dir).limit(0)))
    return read_state(spark, out, like, d.settle).select("dn", "attr", "value")
