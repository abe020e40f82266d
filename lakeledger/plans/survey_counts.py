"""Job: daily counts table and survey summary of one curation run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from lakeledger.functions import iso_text
from lakeledger.operators.survey_counts import (
    MANUAL_LABEL,
    daily_counts,
    survey_summary,
    survey_summary_lines,
)
from lakeledger.sinks.tables import write_partitions

KEYS = ("survey_name", "event_date")


def write_daily_counts(
    rows: DataFrame, path: str, job_run_id: str, env: str, processed_at: datetime
) -> None:
    """Counts of this run replace the partitions of the same survey and date only.

    Nothing to count writes nothing.
    """
    counts = daily_counts(rows, job_run_id, env, iso_text(processed_at))
    write_partitions(counts, path, KEYS, row_per_key=True)


def summary_report(daily: DataFrame, manual_label: str = MANUAL_LABEL) -> DataFrame:
    """Text report of daily counts, in print order."""
    lines = survey_summary_lines(survey_summary(daily), manual_label)
    return lines.orderBy("section", "survey_name")
