"""Landing per owner."""

import os

from wardlake.sources import sinks


def _files(path):
    return {o: sum(f.endswith(".csv") for f in os.listdir(f"{path}/{o}")) for o in os.listdir(path) if o.startswith("owner=")}


def test_an_owner_is_one_file_unless_hot(spark, tmp_path):
    rows = [(f"o{k % 20}", k) for k in range(400)] + [("hot", k) for k in range(900)] + [(None, k) for k in range(9)]
    df = spark.createDataFrame(rows, "owner string, n int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the partitions were large
    try:
        sinks.land_per_owner(df, "owner", str(tmp_path / "out"), rows_per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = _files(tmp_path / "out")
    assert files.pop("owner=hot") > 1
    assert set(files.values()) == {1} and len(files) == 21  # before: up to four files of each owner
    back = spark.read.option("sep", "\t").schema("n int, owner string").csv(str(tmp_path / "out"))
    assert sorted((r.owner or "", r.n) for r in back.collect()) == sorted((o or "", n) for o, n in rows)
