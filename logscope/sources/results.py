"""Re-read materialized results with their fixed schema.

Schema inference would turn ``0052`` into 52 and times into strings; the
contract schemas are passed instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TIMELINE_SCHEMA = ("cluster_id STRING, application_id STRING, app_number STRING, "
                   "start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ")
CLUSTER_SUMMARY_SCHEMA = ("cluster_id STRING, num_applications BIGINT, "
                          "cluster_first_app TIMESTAMP_NTZ, cluster_last_app TIMESTAMP_NTZ")
LEVEL_COUNTS_SCHEMA = "log_level STRING, count BIGINT"
DURATIONS_SCHEMA = ("cluster_id STRING, application_id STRING, app_number STRING, "
                    "start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, duration_min DOUBLE")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSS]"


def read_result_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (spark.read.schema(schema).option("header", "true")
            .option("timestampNTZFormat", TIME_FORMAT).option("escape", '"').option("mode", "FAILFAST").csv(path))


def read_timeline(spark: SparkSession, path: str) -> DataFrame:
    return read_result_csv(spark, path, TIMELINE_SCHEMA)


def read_cluster_summary(spark: SparkSession, path: str) -> DataFrame:
    return read_result_csv(spark, path, CLUSTER_SUMMARY_SCHEMA)


def read_durations(spark: SparkSession, path: str) -> DataFrame:
    return read_result_csv(spark, path, DURATIONS_SCHEMA)
