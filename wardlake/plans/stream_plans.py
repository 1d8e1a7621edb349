"""Streaming queries, drained with ``availableNow`` over files landed from data."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlake.plans import access_plans as ap
from wardlake.plans import directory_plans as dp
from wardlake.plans import log_plans as lp
from wardlake.plans.registry import REGISTRY, query
from wardlake.session import fresh_path
from wardlake.sources.tables import scan_parquet
from wardlake.streaming import streams as st


# Rows of a landed file, which one task sorts and writes: the files grow in number with the table, not in size.
FILE_ROWS = 250_000


def _files(spark, rows: int = 0) -> int:
    """Files landed for a stream, taken half at a time: as many as there are cores, at least 2, more for many ``rows``."""
    return max(2, spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))


def _land_log(spark, sf_dir) -> tuple[str, int]:
    """The folder and the number of files."""
    path, lines = fresh_path(spark, "stream_log_in"), lp.log_lines(spark, sf_dir)
    files = _files(spark, 2 * scan_parquet(spark, sf_dir, "orders").count())  # two lines of an order; counted in the footers
    (lines.repartition(files, "line_id").sortWithinPartitions("line_id")
     .select("value").write.mode("overwrite").text(path))
    return path, files


@query("stream_policy_changes", lambda: REGISTRY["filter_positional_words"].sql())
def q_stream_policy_changes(spark, sf_dir):
    path, files = _land_log(spark, sf_dir)
    out = st.stream_policy_changes(spark, path, fresh_path(spark, "stream_changes_out"),
                                   fresh_path(spark, "stream_changes_ckpt"), files // 2)
    return out.select("policy_id", "kind")


@query("stream_grant_state", lambda: REGISTRY["grants_object_store"].sql())
def q_stream_grant_state(spark, sf_dir):
    path, files = _land_log(spark, sf_dir)
    state = st.stream_grant_state(spark, path, fresh_path(spark, "stream_grants_state"),
                                  fresh_path(spark, "stream_grants_ckpt"), files // 2)
    return state.select("policy_doc", "sid", "effect", F.array_join("actions", ",").alias("actions"),
                        F.array_join("resources", ",").alias("resources"))


@query("stream_audit_summary", lambda: REGISTRY["audit_summary"].sql())
def q_stream_audit_summary(spark, sf_dir):
    landed = fresh_path(spark, "stream_events_in")
    ev = scan_parquet(spark, sf_dir, "events")
    files = _files(spark, ev.count())
    # dealt by a hash of the row: without a key Spark sorts all rows of a task to deal them out
    ev.repartition(files, F.xxhash64(*ev.columns)).write.mode("overwrite").parquet(landed)
    stream_events = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", files // 2)
                     .parquet(landed))
    # The same request derivation as the batch job, on the stream.
    from wardlake.plans import fixtures as fx
    reqs = (stream_events.withColumn("res_idx", F.pmod(F.col("event_id"), F.lit(fx.N_RESOURCES)).cast("int"))
            .join(F.broadcast(fx.resources_df(spark)), "res_idx")
            .join(F.broadcast(fx.access_map_df(spark)), "event_type")
            .select(F.col("event_id").alias("request_id"),
                    F.col("ts").cast("timestamp").alias("ts"), fx.user_name(F.col("user_id")).alias("user"),
                    "access", "db", "tbl", "col"))
    out = st.stream_audit_summary(spark, reqs, lambda keys: ap.decide_keys(spark, sf_dir, keys), ap.KEY, fresh_path(spark, "stream_audit_out"),
                                  fresh_path(spark, "stream_audit_ckpt"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return out.select("user", "db", "tbl", "col", "access", "decision",
                      F.date_format("w.start", fmt).alias("window_start"), "n_events",
                      F.date_format("first_ts", fmt).alias("first_seen"),
                      F.date_format("last_ts", fmt).alias("last_seen"))


@query("stream_directory_sync", lambda: REGISTRY["apply_changes"].sql())
def q_stream_directory_sync(spark, sf_dir):
    path = fresh_path(spark, "stream_ldif_in") + "/part0"
    # Entries arrive before the changes to them: two writes, one batch each.
    for records in (dp.ldif_adds(spark, sf_dir), dp.ldif_changes(spark, sf_dir)):
        records.repartition(_files(spark)).write.mode("append").text(path)
    return st.stream_directory_sync(spark, path, fresh_path(spark, "stream_ldif_out"),
                                    fresh_path(spark, "stream_ldif_ckpt"), _files(spark))
