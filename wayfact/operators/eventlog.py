"""Run metrics from Spark event logs, read and reduced as a distributed job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfact.functions import exact
from wayfact.session import materialize

# Event names and the places of the metrics inside a task record.
JOB_START = "SparkListenerJobStart"
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
STAGE_DONE = "SparkListenerStageCompleted"
TASK_END = "SparkListenerTaskEnd"
SUMMED = {
    "input_bytes_read": ("Input Metrics", "Bytes Read"),
    "input_records_read": ("Input Metrics", "Records Read"),
    "output_bytes_written": ("Output Metrics", "Bytes Written"),
    "output_records_written": ("Output Metrics", "Records Written"),
    "remote_bytes": ("Shuffle Read Metrics", "Remote Bytes Read"),
    "local_bytes": ("Shuffle Read Metrics", "Local Bytes Read"),
    "shuffle_write_bytes": ("Shuffle Write Metrics", "Shuffle Bytes Written"),
    "shuffle_write_records": ("Shuffle Write Metrics", "Shuffle Records Written"),
    "memory_bytes_spilled": ("Memory Bytes Spilled",),
    "disk_bytes_spilled": ("Disk Bytes Spilled",),
    "run_time_ms": ("Executor Run Time",),
    "cpu_time_ns": ("Executor CPU Time",),
}
READ_RECORDS = (
    ("Shuffle Read Metrics", "Total Records Read"),
    ("Shuffle Read Metrics", "Records Read"),
)
PEAK = ("Peak Execution Memory",)
MEGABYTE = 1024 * 1024
CORRUPT = "_unreadable"
ROLLING = "eventlog_v2_([^/]+)"


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the event files in a folder, single or rolling layout."""
    root = path.rstrip("/")
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "events_*")
        .text(root)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )


def _record_schema() -> T.StructType:
    """The few fields the metrics need, out of each record."""
    text, number = T.StringType(), T.LongType()

    def struct(fields: dict) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])

    metrics: dict = {}
    for place in (*SUMMED.values(), *READ_RECORDS, PEAK):
        if len(place) == 1:
            metrics[place[0]] = number
        else:
            metrics.setdefault(place[0], {})[place[1]] = number
    groups = {n: struct(k) if isinstance(k, dict) else k for n, k in metrics.items()}
    return struct(
        {
            "Event": text,
            "Job ID": number,
            "Stage ID": number,
            "Stage Attempt ID": number,
            "Stage Info": struct(
                {"Stage ID": number, "Stage Attempt ID": number, "Number of Tasks": number}
            ),
            "Task Info": struct({"Task ID": number, "Attempt": number}),
            "Task End Reason": text,
            "Task Metrics": struct(groups),
            CORRUPT: text,
        }
    )


def _field(*names: str) -> Column:
    field = F.col("record")
    for name in names:
        field = field.getField(name)
    return field


def _whole(*names: str) -> Column:
    """A number inside the record, 0 where absent or not a number."""
    return F.coalesce(_field(*names), F.lit(0).cast("bigint"))


def application() -> Column:
    """The application of a log file: the name of its rolling folder, or else of the file."""
    folder = F.regexp_extract("file", ROLLING, 1)
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.inprogress$", "")
    return F.when(folder != "", folder).otherwise(name)


def parsed_events(lines: DataFrame) -> DataFrame:
    """One row per line with the few fields the metrics need; malformed lines flagged."""
    options = {"columnNameOfCorruptRecord": CORRUPT}
    read = lines.where(F.trim("value") != "").withColumn(
        "record", F.from_json("value", _record_schema(), options)
    )
    kind = _field("Event")
    is_stage, is_task = kind == STAGE_DONE, kind == TASK_END
    # a record with an odd field is kept; only text that is no JSON at all is malformed
    malformed = F.when(
        _field(CORRUPT).isNotNull(), F.try_parse_json("value").isNull()
    ).otherwise(False)
    reason = _field("Task End Reason")
    reason = F.coalesce(F.get_json_object(reason, "$.Reason"), reason)
    return read.select(
        "file",
        application().alias("application"),
        F.monotonically_increasing_id().alias("line"),
        malformed.alias("malformed"),
        kind.alias("kind"),
        _field("Job ID").alias("job_id"),
        F.when(is_stage, _field("Stage Info", "Stage ID"))
        .when(is_task, _field("Stage ID"))
        .alias("stage_id"),
        F.when(is_stage, _whole("Stage Info", "Stage Attempt ID"))
        .when(is_task, _whole("Stage Attempt ID"))
        .alias("stage_attempt"),
        _whole("Stage Info", "Number of Tasks").alias("stage_tasks"),
        _field("Task Info", "Task ID").alias("task_id"),
        _whole("Task Info", "Attempt").alias("task_attempt"),
        (F.lower(reason) == "success").alias("succeeded"),
        *[_whole("Task Metrics", *place).alias(name) for name, place in SUMMED.items()],
        F.greatest(*[_whole("Task Metrics", *place) for place in READ_RECORDS]).alias(
            "shuffle_read_records"
        ),
        _whole("Task Metrics", *PEAK).alias("peak_execution_memory_bytes"),
    )


def event_log_metrics(lines: DataFrame) -> DataFrame:
    """One row of run metrics an application.

    Repeated stage records count once; of repeated task records the first counts. The
    parsed lines are written once; jobs, stages and tasks are then reduced from those
    columns, each by its own key, with partial sums before every shuffle.
    """
    events = materialize(parsed_events(lines), "events")
    summed = (*SUMMED, "shuffle_read_records")
    rows = events.groupBy("application").agg(
        F.countDistinct("file").alias("event_files"),
        F.countDistinct(F.when(F.col("kind") == JOB_START, F.col("job_id"))).alias("spark_jobs"),
        F.count_if(F.col("kind") == SQL_START).alias("sql_executions"),
        F.count_if("malformed").alias("malformed_event_lines"),
    )
    stages = (
        events.where((F.col("kind") == STAGE_DONE) & F.col("stage_id").isNotNull())
        .groupBy("application", "stage_id", "stage_attempt")
        .agg(F.max("stage_tasks").alias("tasks"))
        .groupBy("application")
        .agg(
            F.count(F.lit(1)).alias("completed_stage_attempts"),
            F.sum("tasks").alias("scheduled_stage_tasks"),
        )
    )
    known = F.col("stage_id").isNotNull() & F.col("task_id").isNotNull()
    good, peak = F.col("record.succeeded"), "peak_execution_memory_bytes"
    record = F.struct(F.coalesce("succeeded", F.lit(False)).alias("succeeded"), *summed, peak)
    tasks = (
        events.where((F.col("kind") == TASK_END) & known)
        .groupBy("application", "stage_id", "stage_attempt", "task_id", "task_attempt")
        .agg(F.min_by(record, F.struct("file", "line")).alias("record"))
        .groupBy("application")
        .agg(
            F.count_if(good).alias("successful_task_attempts"),
            F.count_if(~good).alias("failed_task_attempts"),
            *[F.sum(F.when(good, F.col(f"record.{name}"))).alias(name) for name in summed],
            F.max(F.when(good, F.col(f"record.{peak}"))).alias(peak),
        )
    )
    rows = rows.join(stages, "application", "left").join(tasks, "application", "left")
    rows = rows.select(
        "application", *[F.coalesce(name, F.lit(0)).alias(name) for name in rows.columns if name != "application"]
    )
    rows = rows.withColumn("shuffle_read_bytes", F.col("remote_bytes") + F.col("local_bytes"))
    return rows.select("application", *_report_columns())


def _report_columns() -> Sequence[Column]:
    def plain(*names: str) -> list[Column]:
        return [F.col(name) for name in names]

    def sized(name: str, megabytes: str) -> list[Column]:
        return [F.col(name), exact.ratio(name, str(MEGABYTE), 3).alias(megabytes)]

    return [
        *plain(
            "event_files",
            "spark_jobs",
            "completed_stage_attempts",
            "scheduled_stage_tasks",
            "successful_task_attempts",
            "failed_task_attempts",
            "sql_executions",
        ),
        *sized("input_bytes_read", "input_megabytes_read"),
        *plain("input_records_read"),
        *sized("output_bytes_written", "output_megabytes_written"),
        *plain("output_records_written"),
        *sized("shuffle_read_bytes", "shuffle_read_megabytes"),
        *plain("shuffle_read_records"),
        *sized("shuffle_write_bytes", "shuffle_write_megabytes"),
        *plain("shuffle_write_records"),
        *sized("memory_bytes_spilled", "memory_megabytes_spilled"),
        *sized("disk_bytes_spilled", "disk_megabytes_spilled"),
        *sized("peak_execution_memory_bytes", "peak_execution_memory_megabytes"),
        exact.ratio("run_time_ms", "1000", 3).alias("executor_run_time_seconds"),
        exact.ratio("cpu_time_ns", str(10**9), 3).alias("executor_cpu_time_seconds"),
        *plain("malformed_event_lines"),
    ]
