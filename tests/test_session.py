from wardlake.session import cut_lineage, fresh_path, get_spark, shared_dir


def test_shared_dir_is_stable_and_used(spark):
    d = shared_dir(spark)
    assert d and shared_dir(spark) == d
    p1, p2 = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert p1 != p2 and p1.startswith(d)


def test_cut_lineage_round_trip(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    staged = cut_lineage(df, name="t")
    assert sorted(r.k for r in staged.collect()) == list(range(100))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan  # the stage is a plain file scan


def test_snapshot_bounds(spark, sf_dir):
    from wardlake.plans.policy_plans import policy_snapshot, resource_bound
    snap = policy_snapshot(spark, sf_dir)
    n = snap["resources"].where("service = 'lakehouse'").count()
    assert resource_bound(spark, sf_dir, "lakehouse") == n > 0
    assert resource_bound(spark, sf_dir, "items:lakehouse") == snap["items_x"].where("service = 'lakehouse'").count()


def test_running_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_spark(shuffle_partitions=77) is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shared_dir_keeps_its_scheme(spark, tmp_path, monkeypatch):
    """A folder named as a URI of a file system stays one, and tables are written and read there."""
    monkeypatch.setattr(spark.sparkContext._conf, "get", lambda *a: f"file://{tmp_path}/")
    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: self._conf)
    assert shared_dir(spark) == f"file://{tmp_path}"
    assert cut_lineage(spark.range(5), name="t").count() == 5
    assert any((tmp_path / "wardlake").iterdir())
