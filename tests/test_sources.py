import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from wayfact import session
from wayfact.operators import eventlog
from wayfact.sources import catalog, guards, readers, writers
from wayfact.sources.guards import SchemaValidationError


@pytest.fixture
def zone_csv(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,rate\n1,Queens,0.5\n2,Bronx,\n")
    return str(path)


def test_csv_typings(spark, zone_csv):
    assert dict(readers.csv_inferred(spark, zone_csv).dtypes)["LocationID"] == "int"
    text = readers.csv_text(spark, zone_csv)
    assert {kind for _, kind in text.dtypes} == {"string"}
    declared = readers.csv_declared(spark, zone_csv, "LocationID long, Borough string, rate double")
    assert dict(declared.dtypes)["LocationID"] == "bigint"
    assert declared.count() == text.count() == 2


def test_ride_schema_has_thirteen_columns(spark):
    assert len(spark.createDataFrame([], readers.RIDE_SCHEMA).columns) == 13


def test_text_rows_view_and_generator(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo\n")
    assert readers.text_lines(spark, str(tmp_path / "a.txt")).count() == 3
    squares = readers.rows(spark, [(x, 2 * x) for x in range(10)], ["x", "y"])
    assert squares.where("x >= 5").count() == 5
    readers.temp_view(squares, "squares")
    assert spark.sql("select sum(y) from squares").first()[0] == 90
    made = readers.generated(spark, 100)
    assert made.exceptAll(readers.generated(spark, 100)).count() == 0
    assert made.where("passengers between 1 and 4 and fare between 5 and 45").count() == 100


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], ["b"])
    assert guards.require_columns(df, ["b"], "X") is df
    with pytest.raises(ValueError, match="X is missing required columns: a, c"):
        guards.require_columns(df, ["c", "b", "a"], "X")


def test_schema_report(spark, tmp_path):
    times, numbers = ["t"], ["n", "m"]
    good = spark.range(1).select(
        F.lit(dt.datetime(2024, 1, 1)).alias("t"),
        F.lit(1).alias("n"),
        F.lit("1.5").cast("decimal(5,2)").alias("m"),
    )
    good.write.parquet(str(tmp_path / "good"))
    good.drop("m").write.parquet(str(tmp_path / "missing"))
    good.withColumn("t", F.lit("text")).write.parquet(str(tmp_path / "wrong"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    paths = {name: str(tmp_path / name) for name in ("good", "missing", "wrong", "broken", "absent")}
    report = guards.schema_report(spark, paths, times, numbers)
    rows = {r.label: r for r in report.collect()}
    assert {k: r.status for k, r in rows.items()} == {
        "good": "PASS", "missing": "FAIL", "wrong": "FAIL", "broken": "FAIL", "absent": "FAIL"
    }
    assert rows["missing"].missing == "m" and rows["wrong"].incompatible == "t=string"
    assert rows["absent"].error
    with pytest.raises(SchemaValidationError, match="4 inputs failed"):
        guards.require_schemas(report)
    guards.require_schemas(report.where("status = 'PASS'"))


@pytest.mark.parametrize("names", [("a", "b"), ("b", "a")])
def test_one_bad_file_fails_its_folder(spark, tmp_path, names):
    good = spark.range(1).select(F.lit(1).alias("n"))
    for name, df in zip(names, (good, good.select(F.lit("x").alias("n")))):
        df.coalesce(1).write.parquet(str(tmp_path / "all" / name))
    report = guards.schema_report(spark, {"mixed": str(tmp_path / "all")}, [], ["n"]).first()
    assert report.status == "FAIL" and report.incompatible == "n=string"
    assert f"/{names[1]}/" in report.error
    files = guards.file_schemas(spark, {"mixed": str(tmp_path / "all")}, [], ["n"])
    assert files.count() == 2


def test_applications_are_kept_apart(spark):
    lines = [
        ("eventlog_v2_a/events_1_a", task(1, "Success", **{"Executor Run Time": 5})),
        ("eventlog_v2_a/events_1_a", task(1, "Success", **{"Executor Run Time": 7})),
        ("eventlog_v2_b/events_1_b", task(1, "ExceptionFailure")),
        ("logs/app-3.inprogress", task(1, "Success", **{"Executor Run Time": 9})),
    ]
    rows = [(file, json.dumps(record)) for file, record in lines]
    found = eventlog.event_log_metrics(spark.createDataFrame(rows, "file string, value string").coalesce(1))
    got = {r.application: r for r in found.collect()}
    assert {k: r.successful_task_attempts for k, r in got.items()} == {"a": 1, "b": 0, "app-3": 1}
    assert got["a"].executor_run_time_seconds == 0.005 and got["b"].failed_task_attempts == 1


def test_monthly_paths():
    paths = guards.monthly_paths("s3://b/raw/", 2024, "year={year}/month={month}/f.parquet")
    assert len(paths) == 12
    assert paths["2024-03"] == "s3://b/raw/year=2024/month=03/f.parquet"


def test_dynamic_overwrite_keeps_other_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    writers.write_partitioned(df, path, ["k"])
    writers.write_partitioned(df.where("k = 'a'").withColumn("v", F.lit(9)), path, ["k"], only_present=True)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(2, "b"), (9, "a")]
    writers.write_partitioned(df.where("k = 'a'"), path, ["k"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "a")]


def test_partition_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(spark.range(10).withColumn("k", F.col("id") % 2), path, ["k"], rebalance=True)
    plan = spark.read.parquet(path).where("k = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def test_json_is_one_file(spark, tmp_path):
    path = writers.write_json(spark.range(10), str(tmp_path), "out")
    assert len(list((tmp_path / "out").glob("*.json"))) == 1
    assert spark.read.json(path).count() == 10


def test_footprint(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(3).write.parquet(path)
    row = writers.footprint(spark.read.parquet(path)).first()
    sizes = [f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")]
    assert (row.files, row.bytes) == (3, sum(sizes))


def test_catalog_tables(spark, tmp_path):
    plain, split = str(tmp_path / "p"), str(tmp_path / "s")
    spark.range(5).write.parquet(plain)
    spark.range(6).withColumn("k", F.col("id") % 3).write.partitionBy("k").parquet(split)
    try:
        assert catalog.register_table(spark, "t_plain", plain).count() == 5
        table = catalog.register_table(spark, "t_split", split, "id bigint, k bigint", ["k"])
        assert table.where("k = 2").count() == 2
        assert spark.sql("show partitions t_split").count() == 3
    finally:
        spark.sql("drop table if exists t_plain")
        spark.sql("drop table if exists t_split")
    assert spark.read.parquet(plain).count() == 5


def test_scratch_follows_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    kept = session.materialize(spark.range(7), "numbers")
    assert kept.count() == 7
    assert glob.glob(f"{root}/wayfact/numbers-*")
    assert "wayfact/numbers-" in kept.inputFiles()[0]


def task(task_id, reason, attempt=0, **metrics):
    return {
        "Event": eventlog.TASK_END,
        "Stage ID": 1,
        "Task End Reason": reason,
        "Task Info": {"Task ID": task_id, "Attempt": attempt},
        "Task Metrics": metrics,
    }


def test_event_log(spark, tmp_path):
    good = {
        "Executor Run Time": 1500,
        "Peak Execution Memory": 2 * 1024 * 1024,
        "Disk Bytes Spilled": True,
        "Input Metrics": {"Bytes Read": 1048576, "Records Read": 10},
        "Shuffle Read Metrics": {"Remote Bytes Read": 5, "Local Bytes Read": 6, "Records Read": 4},
    }
    stage = {"Event": eventlog.STAGE_DONE, "Stage Info": {"Stage ID": 1, "Number of Tasks": 8}}
    lines = [
        {"Event": eventlog.JOB_START, "Job ID": 0},
        {"Event": eventlog.JOB_START, "Job ID": 0},
        {"Event": eventlog.SQL_START, "extra": {"nested": [1]}},
        stage,
        stage,
        {"Event": eventlog.STAGE_DONE, "Stage Info": {}},
        task(1, {"Reason": "Success"}, **good),
        task(1, {"Reason": "Success"}, **good),
        task(2, "success", **{"Executor Run Time": 1}),
        task(3, {"Reason": "ExceptionFailure"}, **good),
        task(None, {"Reason": "Success"}, **good),
        {"Event": "SparkListenerOther", "Stage ID": "text"},
    ]
    folder = tmp_path / "eventlog_v2_app"
    folder.mkdir()
    text = [json.dumps(line) for line in lines]
    (folder / "events_1_app").write_text("\n".join(text[:6]) + "\n{broken\n\n")
    (folder / "events_2_app").write_text("\n".join(text[6:]) + "\n")
    (folder / "appstatus_app").write_text("")
    for root in (folder, tmp_path):
        row = eventlog.event_log_metrics(eventlog.read_event_log(spark, str(root))).first().asDict()
        expected = {
            "event_files": 2,
            "spark_jobs": 1,
            "sql_executions": 1,
            "completed_stage_attempts": 1,
            "scheduled_stage_tasks": 8,
            "successful_task_attempts": 2,
            "failed_task_attempts": 1,
            "input_megabytes_read": 1.0,
            "input_records_read": 10,
            "shuffle_read_bytes": 11,
            "shuffle_read_records": 4,
            "disk_bytes_spilled": 0,
            "peak_execution_memory_megabytes": 2.0,
            "executor_run_time_seconds": 1.501,
            "malformed_event_lines": 1,
        }
        assert {k: row[k] for k in expected} == expected


def test_quoted_texts_come_back(spark, tmp_path):
    rows = [(1, 'a "b", c\nd'), (2, ""), (3, None), (4, "  x\t"), (5, "\\"), (6, "a\r\nb"), (7, '"'), (8, "é,;"), (9, "\n")]
    frame = spark.createDataFrame(rows, "id int, t string")
    path = writers.write_csv_quoted(frame, str(tmp_path / "q"))
    assert sorted(map(tuple, readers.csv_quoted(spark, path, "id int, t string").collect())) == rows


def test_rows_that_do_not_fit_are_kept_whole(spark, tmp_path):
    lines = ["a,b", "1,x", "y,z", "2", "3,p,q", ""]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(str(tmp_path / "c"))
    found = readers.csv_checked(spark, str(tmp_path / "c"), "a int, b string").collect()
    assert sorted(map(str, found)) == sorted(
        map(str, spark.createDataFrame(
            [(1, "x", None), (None, "z", "y,z"), (2, None, "2"), (3, "p", "3,p,q")], "a int, b string, corrupt string"
        ).collect())
    )
