"""Writers of the reconciliation results.

The partition columns are in the path only, never in the body.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.contracts import LEDGER, conform
from lakeledger.operators.layers import GROUP, ID
from lakeledger.sinks.tables import delete_files, move_file, write_partitions
from lakeledger.sources.layers import COMMITTED, PARTITION, data_files, date_folders, newest_entries

REPORT_KEYS = ("event_date", "survey_name")


def _write_rows(summary: DataFrame, path: str) -> None:
    # Nulls stay in the body, so that every count has its field.
    write_partitions(
        summary, path, REPORT_KEYS, "json", row_per_key=True, ignoreNullFields="false"
    )


def write_report(summary: DataFrame, path: str, layout: str = "unified") -> None:
    """One JSON row per date and survey. ``split`` keeps the two pipeline kinds apart."""
    if layout == "unified":
        _write_rows(summary, path)
    elif layout == "split":
        for status, prefix in (("ACTIVE", "active"), ("RAW_ONLY", "raw_only")):
            _write_rows(summary.filter(F.col("pipeline_status") == status), f"{path}/{prefix}")
    else:
        raise ValueError("layout is 'unified' or 'split'")


def anomaly_rows(unexplained: DataFrame, generated_at: str) -> DataFrame:
    """(survey_name, event_date, generated_at, unaccounted_contact_record_id): a row per id at every size."""
    return unexplained.select(
        *GROUP,
        F.lit(generated_at).alias("generated_at"),
        F.col(ID).alias("unaccounted_contact_record_id"),
    )


def write_anomalies(unexplained: DataFrame, path: str, generated_at: str) -> None:
    """Detail of unexplained ids, one JSON row each; a survey and date without any gets no partition."""
    rows = anomaly_rows(unexplained, generated_at)
    write_partitions(rows, path, REPORT_KEYS, "json", ignoreNullFields="false")


def ledger_rows(summary: DataFrame, report_path: str) -> DataFrame:
    location = F.concat_ws(
        "/",
        F.lit(report_path.rstrip("/")),
        F.concat(F.lit("event_date="), F.col("event_date")),
        F.concat(F.lit("survey_name="), F.col("survey_name")),
    )
    return conform(
        summary.withColumn("report_path", location).withColumnRenamed(
            "survey_name", "survey_type"
        ),
        LEDGER,
    )


def write_ledger(summary: DataFrame, path: str, report_path: str) -> None:
    """Upsert by (date, survey), also by several writers at once. Written last.

    A run adds entries and replaces none: they are staged in a folder of the
    run, which readers don't see, and each file is moved under a name of its
    own into the folder of its date, where the newest commit of a key counts
    (``read_ledger``). The dates of the run are then compacted. Only their
    folders are read.
    """
    spark = summary.sparkSession
    commit = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    rows = ledger_rows(summary, report_path).withColumn(COMMITTED, F.lit(commit))
    dates = _publish(spark, rows, path, commit)
    compact_ledger(spark, path, dates)


def compact_ledger(spark: SparkSession, path: str, dates: Iterable[str]) -> None:
    """One row per key in the folders of these dates.

    The files that are there are read, their newest entries published in new
    files, and then exactly those files deleted that were read. Entries keep
    the time of their commit. So whatever another writer adds meanwhile stays
    and counts, two compactions at once leave equal entries twice at most, and
    one that stops half-way has lost nothing.
    """
    found = [data_files(spark, f"{path}/{PARTITION}={d}") for d in sorted(set(dates))]
    old = [file for files in found if len(files) > 1 for file in files]
    if not old:
        return
    schema = T.StructType([*LEDGER.schema.fields, T.StructField(COMMITTED, T.StringType())])
    entries = spark.read.schema(schema).option("basePath", path).parquet(*old)
    _publish(spark, newest_entries(entries), path, f"{time.time_ns():020d}-{uuid.uuid4().hex}")
    delete_files(spark, old)


def _publish(spark: SparkSession, rows: DataFrame, path: str, name: str) -> list[str]:
    """Write ``rows`` aside and move the files into the folders of their dates, which are returned."""
    staged = f"{path}/_staging-{name}"
    write_partitions(rows, staged, (PARTITION,), row_per_key=True)
    dates = date_folders(spark, staged)
    for date in dates:
        for number, file in enumerate(data_files(spark, f"{staged}/{PARTITION}={date}")):
            move_file(spark, file, f"{path}/{PARTITION}={date}/{name}-{number}.parquet")
    delete_files(spark, [staged])
    return dates
