"""The typed report, fed with event times in the source's text formats."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakeledger.functions import run_time
from lakeledger.plans.program_report import (
    REPORT_COLUMNS,
    build_program_report,
    create_report_view,
    refresh_program_report,
)
from lakeledger.session import scratch_path
from workload.base import query, table

RUN = datetime(2026, 8, 16, 1, 2, 3)

_SPARK = {
    "number": lambda: F.col("event_id").cast("decimal(38,0)"),
    "time": lambda: F.col("ts"),
    "flag": lambda: F.when(F.col("value") > 20, True).when(F.col("value") > 5, False),
    "us_time": lambda: F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"),
    "us_date": lambda: F.date_format("ts", "MM/dd/yyyy"),
    "iso_date": lambda: F.date_format("ts", "yyyy-MM-dd"),
}
_SQL = {
    "number": "event_id",
    "time": "ts",
    "flag": "CASE WHEN value > 20 THEN 'true' WHEN value > 5 THEN 'No' END",
    "us_time": "date_trunc('second', ts)::TIMESTAMP",
    "us_date": "date_trunc('day', ts)::TIMESTAMP",
    "iso_date": "date_trunc('day', ts)::TIMESTAMP",
    "load": "TIMESTAMP '2026-08-16 01:02:03'",
}


def _text_source(name: str) -> str:
    return "props" if name.startswith("P") else "event_type"


def report_source(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        *[
            (F.col(_text_source(name)) if kind == "text" else _SPARK[kind]()).alias(name)
            for name, kind in REPORT_COLUMNS
            if kind != "load"
        ]
    )


def _numbers_as_bigint(df):
    return df.withColumns(
        {name: F.col(name).cast("bigint") for name, kind in REPORT_COLUMNS if kind == "number"}
    )


_ORACLE = "SELECT {} FROM events".format(
    ", ".join(
        f"{_text_source(name) if kind == 'text' else _SQL[kind]} AS {name}"
        for name, kind in REPORT_COLUMNS
    )
)


@query("program_report", _ORACLE)
def program_report(spark, sf_dir):
    return _numbers_as_bigint(build_program_report(report_source(spark, sf_dir), run_time(RUN)))


@query("program_report_view", _ORACLE)
def program_report_view(spark, sf_dir):
    target = scratch_path(spark, "program-report")
    refresh_program_report(report_source(spark, sf_dir), target, run_time(RUN))
    create_report_view(spark.read.parquet(target), "program_report_view")
    return _numbers_as_bigint(spark.table("program_report_view"))
