import pytest
from fixtures import as_set, rows
from pyspark.sql import functions as F

from hirelens.operators import quality, staging
from hirelens.operators.geo import geocode
from hirelens.operators.ids import dense_ids
from hirelens.operators.upsert import absent_rows, one_per_key, upsert

PAY = "job_id long, min double, max double"


def test_dense_ids_in_input_order(spark):
    df = spark.range(0, 1000, 1, 7)
    got = dense_ids(df, "n", start=11)
    assert [(r["id"], r["n"]) for r in got.orderBy("id").collect()] == [(i, i + 11) for i in range(1000)]


def test_dense_ids_in_given_order_with_empty_partitions(spark):
    df = spark.range(0, 500, 1, 5).filter("id % 100 < 30").withColumn("key", -F.col("id")).repartition(9)
    got = [(r["n"], r["key"]) for r in dense_ids(df, "n", order_by=["key"]).orderBy("n").collect()]
    assert [n for n, _ in got] == list(range(1, 151))
    assert [k for _, k in got] == sorted(k for _, k in got)


def test_dense_ids_of_nothing(spark):
    assert rows(dense_ids(spark.range(0), "n")) == []


def test_stage_uses_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(5), "numbers")
    assert all(folder in f for f in staged.inputFiles())
    assert staged.count() == 5


def test_staged_tables_are_dropped_at_the_end_of_their_scope(spark):
    from pathlib import Path

    def files(df):
        return [Path(f.removeprefix("file://").removeprefix("file:")) for f in df.inputFiles()]

    outer = files(staging.stage(spark.range(1), "outer"))
    with staging.staging_scope(spark):
        inner = files(staging.stage(spark.range(1), "inner"))
        assert all(f.exists() for f in inner)
    assert not any(f.exists() for f in inner) and all(f.exists() for f in outer)


def test_without_a_named_folder_the_warehouse_is_used():
    from types import SimpleNamespace

    settings = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse/"}
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"))
    assert staging.checkpoint_dir(session) == "hdfs://shared/warehouse/_staged"


def test_nothing_staged_is_left_when_the_program_ends(tmp_path):
    """Also after the session was stopped."""
    import subprocess
    import sys
    from pathlib import Path

    folder = tmp_path / "named"
    program = f"""
from pyspark.sql import SparkSession
from hirelens.operators.staging import stage
b = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
spark = b.config("spark.checkpoint.dir", {str(folder)!r}).getOrCreate()
df = stage(spark.range(3), "numbers")
assert df.count() == 3
import glob
print(len(glob.glob({str(folder)!r} + "/**/numbers-*", recursive=True)))
spark.stop()
"""
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", program], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.stdout.split()[-1:] == ["1"], (done.stdout, done.stderr[-2000:])
    assert not [p for p in folder.rglob("*") if "numbers" in p.name]


def test_scopes_of_two_threads_do_not_meet(spark):
    import threading
    from pathlib import Path

    here = lambda df: Path(df.inputFiles()[0].removeprefix("file://").removeprefix("file:")).exists()
    ready, done, seen = threading.Event(), threading.Event(), []

    def other():
        with staging.staging_scope(spark):
            df = staging.stage(spark.range(1), "other")
            ready.set()
            done.wait(60)
            seen.append(here(df))

    thread = threading.Thread(target=other)
    thread.start()
    ready.wait(60)
    with staging.staging_scope(spark):
        staging.stage(spark.range(1), "own")
    done.set()
    thread.join()
    assert seen == [True]


def test_upsert_replaces_all_columns_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], PAY)
    updates = spark.createDataFrame([(None, 9.0, 2), (5.0, 6.0, 3)], "min double, max double, job_id long")
    once = upsert(target, updates, ["job_id"])
    assert as_set(once) == {(1, 1.0, 2.0), (2, None, 9.0), (3, 5.0, 6.0)}
    assert as_set(upsert(once, updates, ["job_id"])) == as_set(once)


def test_upsert_keeps_one_of_several_updates(spark):
    target = spark.createDataFrame([(1, 1.0, 2.0)], PAY)
    updates = spark.createDataFrame([(1, 8.0, 8.0), (1, 9.0, 9.0), (4, 7.0, 7.0)], PAY)
    got = upsert(target, updates, ["job_id"], order_by=[F.col("min").desc()])
    assert as_set(got) == {(1, 9.0, 9.0), (4, 7.0, 7.0)}
    assert as_set(one_per_key(updates, ["job_id"], [F.col("min")])) == {(1, 8.0, 8.0), (4, 7.0, 7.0)}


def test_absent_rows(spark):
    new = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "job_id long, skill_id long")
    old = spark.createDataFrame([(1, 2), (5, 5)], "job_id long, skill_id long")
    assert as_set(absent_rows(new, old, ["job_id", "skill_id"])) == {(1, 1), (2, 1)}


def test_geocode(spark):
    where = spark.createDataFrame(
        [(1, "Paris", None, "France"), (2, None, None, None), (3, "Nowhere", "Xx", None), (4, "", "Ny", "")],
        "job_id long, city string, state string, country string",
    )
    places = spark.createDataFrame([("Paris, France", 48.9, 2.4), ("Ny", 40.7, -74.0)], "place string, lat double, lon double")
    want = {(1, 48.9, 2.4, 0.7), (2, None, None, None), (3, None, None, None), (4, 40.7, -74.0, 0.7)}
    assert as_set(geocode(where, places), "job_id", "lat", "lon", "geocode_confidence") == want
    again = [("Paris, France", 50.0, 1.0), ("Paris, France", None, 0.0), ("Paris, France", 48.9, 3.0), ("Ny", 40.7, None), (None, 1.0, 1.0)]
    twice = places.unionByName(spark.createDataFrame(again, places.schema))
    assert as_set(geocode(where, twice), "job_id", "lat", "lon", "geocode_confidence") == want


def broken(spark):
    return {
        "jobs": spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "d")], "job_id long, title_raw string"),
        "skills": spark.createDataFrame([(1, "x")], "skill_id long, skill_raw string"),
        "jobs_skills": spark.createDataFrame([(1, 1), (1, 1), (9, 1), (9, 2), (None, 1)], "job_id long, skill_id long"),
    }


def test_geocode_by_parts_of_the_place(spark):
    where = spark.createDataFrame(
        [(1, "Ulm", "BW", "DE"), (2, "Bonn", "NW", "DE"), (3, "Kiel", "SH", "DE"), (4, "Oslo", None, "NO"), (5, "Rome", "LZ", "IT"),
         (6, None, None, None), (7, "", "NW", "DE"), (8, "Ulm", None, None), (1, "Ulm", "BW", "DE")],
        "job_id long, city string, state string, country string")
    places = spark.createDataFrame(
        [("Ulm, BW, DE", 1.0, 1.0), ("Ulm, DE", 9.0, 9.0), ("Bonn, DE", 2.0, None), ("Bonn, DE", 3.0, 0.0), ("NW, DE", 4.0, 4.0), ("DE", 5.0, 5.0),
         ("NO", None, 6.0), (None, 7.0, 7.0)], "place string, lat double, lon double")
    got = geocode(where, places, fallback=True).select("job_id", "lat", "lon", "geocode_confidence", "geocode_level").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        (1, 1.0, 1.0, 0.7, 0), (1, 1.0, 1.0, 0.7, 0), (2, 2.0, None, 0.7, 1), (3, 5.0, 5.0, 0.7, 3), (4, None, 6.0, 0.7, 3),
        (5, None, None, None, None), (6, None, None, None, None), (7, 4.0, 4.0, 0.7, 0), (8, None, None, None, None)], key=str)


def test_a_machine_local_folder_is_refused_on_a_cluster():
    from hirelens.operators.staging import below_warehouse

    assert below_warehouse("file:/w/", "local[4]") == "file:/w/_staged" and below_warehouse("hdfs://n/w", "yarn") == "hdfs://n/w/_staged"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        below_warehouse("file:/w", "yarn")


def test_integrity_checks(spark):
    t = broken(spark)
    assert as_set(quality.pk_violations(t)) == {("jobs", "1", 2), ("jobs_skills", "1,1", 2)}
    assert as_set(quality.fk_orphans(t)) == {("jobs_skills", "job_id", 9, 2), ("jobs_skills", "skill_id", 2, 1)}
    assert as_set(quality.not_null_violations(t)) == {
        ("jobs", "job_id", 1), ("jobs", "title_raw", 2), ("jobs_skills", "job_id", 1)
    }
