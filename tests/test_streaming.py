import json
import os

import pytest

from wardlake.plans import fixtures as fx
from wardlake.streaming import streams as st


def test_tag_replace_keeps_latest_version(spark, tmp_path):
    src = tmp_path / "tags"
    src.mkdir()
    lines = open(fx.TAGSET_FILE).read().splitlines()
    # two files arrive one after the other: the newer version must win
    (src / "a.json").write_text(lines[1] + "\n")
    (src / "b.json").write_text(lines[0] + "\n" + lines[2] + "\n")
    out = st.stream_tag_replace(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = {(r.serviceName, r.tagVersion) for r in out.collect()}
    versions = {json.loads(x)["serviceName"]: json.loads(x)["tagVersion"] for x in lines}
    assert got == {("lakehouse", 4), ("objectstore", versions["objectstore"])}


def test_stream_equals_batch(spark, sf_dir):
    import __spark_entry__ as se
    q = se.queries()
    a = sorted(tuple(r) for r in q["stream_policy_changes"](spark, sf_dir).collect())
    b = sorted(tuple(r) for r in q["filter_positional_words"](spark, sf_dir).collect())
    assert a == b and len(a) > 0


def test_list_children(spark, tmp_path):
    (tmp_path / "v=1").mkdir()
    (tmp_path / "v=2").mkdir()
    assert st.list_children(spark, str(tmp_path)) == ["v=1", "v=2"]
    assert st.list_children(spark, os.path.join(str(tmp_path), "missing")) == []


def _line(ts, sid, write):
    return (f"{ts} [t] INFO  com.example.Log (Log.java:1) - <== ServiceREST.updatePolicy(StorePolicy={{id={{{sid}}} "
            "guid={g} isEnabled={true} service={objectstore} name={n} policyType={0} resources={path={PolicyResource="
            "{values={s3://lake/a } isExcludes={false} isRecursive={true} }} } policyItems={PolicyItem={accessTypes={"
            "PolicyItemAccess={type={read} isAllowed={true} }PolicyItemAccess={type={write} isAllowed={"
            f"{write}}} }}}} users={{}} groups={{team }} conditions={{}} delegateAdmin={{false}} }}}} denyPolicyItems={{}}}})\n")


def test_grant_state_keeps_the_newest_statement_out_of_order(spark, tmp_path):
    src = tmp_path / "log"
    src.mkdir()
    (src / "1.log").write_text(_line("2024-01-05 10:00:00,000", 1, "false") + _line("2024-01-05 09:00:00,000", 2, "true"))
    (src / "2.log").write_text(_line("2024-01-05 08:00:00,000", 1, "true") + _line("2024-01-05 09:00:00,000", 2, "false"))
    os.utime(src / "1.log", (1, 1))
    state = st.stream_grant_state(spark, str(src), str(tmp_path / "state"), str(tmp_path / "ckpt"), 1)
    assert len(st.committed(spark, str(tmp_path / "state"))) == 2
    # sid 1: the later batch holds an older statement; sid 2: a tie in time goes to the later line
    assert {r.sid: len(r.actions) for r in state.collect()} == {"1": 3, "2": 3}


def test_streams_without_input(spark, tmp_path):
    src = tmp_path / "log"
    src.mkdir()
    assert st.stream_grant_state(spark, str(src), str(tmp_path / "s"), str(tmp_path / "c1")).count() == 0
    assert st.stream_policy_changes(spark, str(src), str(tmp_path / "o"), str(tmp_path / "c2")).count() == 0
    assert st.stream_directory_sync(spark, str(src), str(tmp_path / "d"), str(tmp_path / "c3")).count() == 0


@pytest.mark.parametrize("every", [1, 2, 100])
def test_audit_counts_unseen_keys_and_late_rows(spark, tmp_path, every):
    from pyspark.sql import functions as F
    src = str(tmp_path / "in")
    schema = "ts timestamp, user string"
    for n, rows in enumerate(([("2024-01-05 10:10:00", "a")], [("2024-01-09 10:00:00", "b")],
                              [("2024-01-05 10:50:00", "a"), ("2024-01-05 01:00:00", "new")])):
        (spark.createDataFrame(rows, "ts string, user string").select(F.col("ts").cast("timestamp"), "user").coalesce(1)
         .write.mode("append").parquet(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = st.stream_audit_summary(spark, stream, lambda k: k.withColumn("decision", F.lit("ALLOW")), ["user"],
                                  str(tmp_path / "out"), str(tmp_path / "ckpt"), every=every)
    if every == 1:  # the windows of the first day left the state when the second batch was folded
        state = spark.read.parquet(*st.state_parts(spark, str(tmp_path / "out")))
        assert {r.user for r in state.collect()} == {"b"}
    got = sorted((r.user, str(r.w.start), r.n_events) for r in out.collect())
    assert got == [("a", "2024-01-05 10:00:00", 2), ("b", "2024-01-09 10:00:00", 1), ("new", "2024-01-05 01:00:00", 1)]


def test_folded_state_reads_few_folders_and_survives_replay(spark, tmp_path):
    """Newest value per key over 20 batches; every batch is run twice, as after a failure."""
    from pyspark.sql import functions as F
    out, want = str(tmp_path / "state"), {}

    def newest(df):
        return df.groupBy("k").agg(F.max_by("v", "v").alias("v"))

    like = spark.createDataFrame([], "k int, v int")
    for batch in range(20):
        rows = [(k, batch * 10 + k) for k in range(batch % 5, 12)]
        want.update(dict(rows))
        for _ in range(2):
            st.fold_batch(spark.createDataFrame(rows, "k int, v int"), batch, out, newest, every=4)
        parts = st.state_parts(spark, out)
        assert len(parts) <= 5  # one base and less than ``every`` batches, however many there were
        assert dict(map(tuple, st.read_state(spark, out, like, newest).collect())) == want
    assert len(st.list_children(spark, out)) <= 2 + 8
    assert st.read_state(spark, str(tmp_path / "none"), like, newest).count() == 0


@pytest.mark.parametrize("every", [1, 2, 100])
def test_directory_folded_over_batches_is_that_of_all_records(spark, tmp_path, every):
    src = tmp_path / "ldif"
    src.mkdir()
    batches = [
        "dn: CN=a\nchangetype: add\ncn: a\nmail: one\nmail: two\n\ndn: CN=b\nchangetype: add\ncn: b\n",
        "dn: CN=a\nchangetype: modify\nreplace: mail\nmail: three\n-\nadd: title\ntitle: x\ntitle: y\n-\n",
        "dn: CN=b\nchangetype: delete\n\ndn: CN=a\nchangetype: modify\ndelete: title\ntitle: x\n-\n",
        "dn: CN=b\nchangetype: add\ncn: again\n\ndn: CN=a\nchangetype: modify\nadd: mail\nmail: one\n-\n",
        "dn: CN=a\nchangetype: modify\ndelete: cn\n-\nadd: title\ntitle: x\n-\n",
    ]
    for k, text in enumerate(batches):
        (src / f"{k}.ldif").write_text(text + "\n")
        os.utime(src / f"{k}.ldif", (k + 1, k + 1))
    got = st.stream_directory_sync(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"), 1, every)
    want = {("CN=a", "mail", "three"), ("CN=a", "mail", "one"), ("CN=a", "title", "x"), ("CN=a", "title", "y"),
            ("CN=b", "cn", "again")}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert len(st.state_parts(spark, str(tmp_path / "out"))) == {1: 1, 2: 2, 100: 5}[every]


def test_landed_files_grow_in_number_with_the_rows(spark):
    from wardlake.plans import stream_plans as sp
    cores = max(2, spark.sparkContext.defaultParallelism)
    assert sp._files(spark) == cores
    assert sp._files(spark, 100 * sp.FILE_ROWS + 1) == 101  # before: as many as cores, whatever the rows
