"""Run log of a workspace: one row per event, ``details`` as a JSON string.

Events are buffered on the driver during an update (they are few: a handful per
flow and update) and appended as one small Parquet write when the update ends.
Queries over the log are plain DataFrame filters with JSON path extraction.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("pipeline_id", T.StringType()),
    T.StructField("update_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("flow_name", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("details", T.StringType()),
])


class EventLog:
    def __init__(self, spark: SparkSession, path: str, pipeline_id: str):
        self.spark = spark
        self.path = path
        self.pipeline_id = pipeline_id
        self._buffer: list[tuple] = []
        self._seq = 0

    def emit(self, event_type: str, details: dict, update_id: str | None = None, table: str | None = None,
             flow: str | None = None, level: str = "INFO", message: str = "") -> None:
        self._seq += 1
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._buffer.append((str(uuid.uuid4()), self._seq, now, self.pipeline_id, update_id, event_type,
                             level, table, flow, message, json.dumps(details, default=str)))

    def flush(self) -> None:
        if not self._buffer:
            return
        rows, self._buffer = self._buffer, []
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(SCHEMA).parquet(self.path)


def event_log(spark: SparkSession, log_path: str, pipeline_id: str | None = None) -> DataFrame:
    """All events of a log, optionally of one pipeline (``event_log(pipeline_id)``)."""
    df = spark.read.schema(SCHEMA).parquet(log_path)
    return df if pipeline_id is None else df.where(F.col("pipeline_id") == F.lit(pipeline_id))


def event_log_for_table(spark: SparkSession, log_path: str, table: str) -> DataFrame:
    """``event_log(TABLE(t))``: the whole log of the pipeline that manages ``t``.

    The owning pipeline ids are found by a semi join against the log itself, so
    nothing is collected to the driver."""
    df = spark.read.schema(SCHEMA).parquet(log_path)
    owners = df.where(F.col("table_name") == F.lit(table)).select("pipeline_id").distinct()
    return df.join(owners, "pipeline_id", "left_semi")


def detail(path: str) -> Column:
    """``details:a:b`` path extraction on the JSON string column."""
    return F.get_json_object(F.col("details"), "$." + path.replace(":", "."))


def user_actions(log: DataFrame) -> DataFrame:
    return (log.where(F.col("event_type") == "user_action")
            .select("timestamp", detail("user_action:action").alias("action"),
                    detail("user_action:user_name").alias("user_name")))


_FLOW_METRICS = T.StructType([
    T.StructField("num_output_rows", T.LongType()),
    T.StructField("num_input_rows", T.LongType()),
    T.StructField("dropped_records", T.LongType()),
    T.StructField("duration_ms", T.LongType()),
])
_EXPECTATIONS = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("passed_records", T.LongType()),
    T.StructField("failed_records", T.LongType()),
]))


def flow_progress(log: DataFrame) -> DataFrame:
    """Completed flow runs with their row counts, drops and time."""
    m = F.from_json(detail("flow_progress:metrics"), _FLOW_METRICS)
    return (log.where((F.col("event_type") == "flow_progress")
                      & (detail("flow_progress:status") == "COMPLETED"))
            .select("update_id", "table_name", "flow_name", "timestamp", m.alias("m"))
            .select("update_id", "table_name", "flow_name", "timestamp", "m.*"))


def table_metrics(log: DataFrame) -> DataFrame:
    """Rows processed, rows dropped by rules and time spent, per table."""
    return (flow_progress(log).groupBy("table_name")
            .agg(F.sum("num_output_rows").alias("num_output_rows"),
                 F.sum("dropped_records").alias("dropped_records"),
                 F.sum("duration_ms").alias("duration_ms"),
                 F.count(F.lit(1)).alias("flow_runs")))


def expectation_metrics(log: DataFrame) -> DataFrame:
    """Passed and failed rows per dataset and expectation, summed over runs."""
    e = F.explode(F.from_json(detail("flow_progress:data_quality:expectations"), _EXPECTATIONS))
    return (log.where(F.col("event_type") == "flow_progress").select(e.alias("e"))
            .groupBy(F.col("e.dataset").alias("dataset"), F.col("e.name").alias("expectation"))
            .agg(F.sum("e.passed_records").alias("passed_records"),
                 F.sum("e.failed_records").alias("failed_records")))


def breaches(log: DataFrame, max_failed_share: float = 0.0) -> DataFrame:
    """Events an alert would fire on: failed updates or flows, and expectations whose
    failed share is above ``max_failed_share``."""
    failed = (log.where((F.col("level") == "ERROR")
                        | (detail("update_progress:state") == "FAILED")
                        | (detail("flow_progress:status") == "FAILED"))
              .select(F.col("timestamp"), F.lit("failure").alias("kind"), F.col("table_name"),
                      F.coalesce(F.col("flow_name"), F.lit("")).alias("subject"),
                      F.col("message").alias("message")))
    e = F.explode(F.from_json(detail("flow_progress:data_quality:expectations"), _EXPECTATIONS))
    q = (log.where(F.col("event_type") == "flow_progress").select("timestamp", "table_name", e.alias("e"))
         .where(F.col("e.failed_records") > F.lit(max_failed_share)
                * (F.col("e.passed_records") + F.col("e.failed_records")))
         .select("timestamp", F.lit("expectation").alias("kind"), "table_name",
                 F.col("e.name").alias("subject"),
                 F.format_string("%d of %d rows failed", F.col("e.failed_records"),
                                 F.col("e.passed_records") + F.col("e.failed_records")).alias("message")))
    return failed.unionByName(q)
