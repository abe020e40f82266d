"""Job: full refresh of the typed 64-column program report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.contracts import NUMBER, TEXT, TIMESTAMP, ColumnSpec, Contract, enforce
from lakeledger.functions import flag_to_text, parse_timestamp_ntz, run_stamp, run_time
from lakeledger.functions.columns import DATE_ISO, DATE_TIME_12H, DATE_US
from lakeledger.sinks.tables import overwrite_table

# The report columns in order, with what happens to each.
# text / number / time: passed through under that type; us_time, us_date,
# iso_date: text parsed to a time; flag: boolean shown as text; load: run time.
REPORT_COLUMNS = [
    ("CLIENT", "text"),
    ("LOB", "text"),
    ("PLAN_TYPE", "text"),
    ("OPS_SEGMENT", "text"),
    ("TPA_NAME", "text"),
    ("PATIENT", "text"),
    ("DATE_OF_BIRTH", "time"),
    ("PATIENT_ID", "number"),
    ("PROGRAM", "text"),
    ("PROGRAM_ID", "text"),
    ("PCP_CARE_COORDINATION_NAME", "text"),
    ("PCP_CARE_COORDINATION_NPI", "text"),
    ("PCP_INSURANCE_NAME", "text"),
    ("PCP_INSURANCE_NPI", "text"),
    ("PRACTICE_NAME", "text"),
    ("PROVIDER_OUTREACH_REQUESTED", "flag"),
    ("PROGRAM_STATUS", "text"),
    ("PROGRAM_PRIORITY", "text"),
    ("REFERRAL_SOURCE", "text"),
    ("DELIVERY_MODEL", "text"),
    ("REASON_FOR_PROGRAM", "text"),
    ("PRIMARY_STAFF_MEMBER", "text"),
    ("PRIMARY_STAFF_ROLE", "text"),
    ("OTHER_CARE_TEAM_MEMBER", "text"),
    ("OTHER_CARE_TEAM_MEMBER_ROLE", "text"),
    ("DATE_PRIMARY_STAFF_ASSIGNED", "us_time"),
    ("FACILITY_NAME", "text"),
    ("FACILITY_TYPE", "text"),
    ("ADMIT_DATE", "us_date"),
    ("TARGET_DISCHARGE_DATE", "us_date"),
    ("ACTUAL_DISCHARGE_DATE", "us_date"),
    ("DISCHARGE_DISPOSITION", "text"),
    ("DISCHARGE_DELAY_REASON", "text"),
    ("PROGRAM_CREATE_DATE", "time"),
    ("PROGRAM_CREATED_BY", "text"),
    ("PROGRAM_ASSIGNED_DATE", "us_date"),
    ("PROGRAM_START_DATE", "time"),
    ("PROGRAM_CLOSED_DATE", "iso_date"),
    ("LAST_PROGRAM_ACTIVITY_DATE", "us_time"),
    ("LAST_PROGRAM_ACTIVITY_BY", "text"),
    ("TOTAL_SUBMITTED_ASSESSMENTS", "number"),
    ("TOTAL_DRAFT_ASSESSMENTS", "number"),
    ("FIRST_ASSESSMENT_SUBMITTED_DATE_ENGAGEMENT_DATE", "us_time"),
    ("LAST_ASSESSMENT_SUBMITTED_DATE", "us_time"),
    ("NAME_OF_LAST_SUBMITTED_ASSESSMENT", "text"),
    ("ENGAGED_DATE", "us_time"),
    ("TOTAL_PATIENT_CONTACTS", "number"),
    ("FIRST_PATIENT_CONTACT_DATE", "us_time"),
    ("LAST_PATIENT_CONTACT_DATE", "us_time"),
    ("TOTAL_UNSIGNED_CARE_NOTES", "number"),
    ("TOTAL_OPEN_ACTION_ITEMS", "number"),
    ("TOTAL_OVERDUE_ACTION_ITEMS", "number"),
    ("TOTAL_SUCCESSFULLY_CLOSED_PROGRAM_GRADUATION_GOALS", "number"),
    ("TOTAL_OVERDUE_GOALS", "number"),
    ("TOTAL_OVERDUE_INTERVENTIONS", "number"),
    ("FIRST_CARE_PLAN_DATE", "us_time"),
    ("NUMBER_OF_CARE_PLANS", "number"),
    ("LAST_PCSP_COMPLETED", "text"),
    ("TOTAL_PCSPS_COMPLETED", "text"),
    ("LAST_CMR_SUBMITTED_DATE", "us_date"),
    ("WELCOME_PACKET_GENERATED_DATE", "us_date"),
    ("TOTAL_LETTERS_GENERATED", "number"),
    ("TOTAL_UPLOADED_DOCUMENTS", "text"),
    ("LOAD_TS", "load"),
]

_TEXT_FORMATS = {"us_time": DATE_TIME_12H, "us_date": DATE_US, "iso_date": DATE_ISO}
FLAG_LENGTH = 10


def _target(name: str, kind: str) -> ColumnSpec:
    if kind == "flag":
        return ColumnSpec(name, TEXT, FLAG_LENGTH)
    return ColumnSpec(name, {"text": TEXT, "number": NUMBER}.get(kind, TIMESTAMP))


PROGRAM_REPORT = Contract(
    "program_report", tuple(_target(name, kind) for name, kind in REPORT_COLUMNS)
)


def source_type(kind: str) -> str:
    """Type that the report source has for a column of this kind."""
    return {"number": NUMBER, "time": TIMESTAMP, "flag": "boolean"}.get(kind, TEXT)


def build_program_report(source: DataFrame, load_ts: Column, on_error: str = "raise") -> DataFrame:
    """One projection; text that is no date fails the load unless ``on_error='null'``."""

    def value(name: str, kind: str) -> Column:
        if kind == "load":
            # To the second, cut off as text: no detour through the session zone.
            return F.substring(load_ts.cast("timestamp_ntz").cast("string"), 1, 19).cast(
                "timestamp_ntz"
            )
        if kind == "flag":
            return flag_to_text(F.col(name))
        if kind in _TEXT_FORMATS:
            return parse_timestamp_ntz(F.col(name), _TEXT_FORMATS[kind], on_error)
        return F.col(name)

    report = source.select(*[value(name, kind).alias(name) for name, kind in REPORT_COLUMNS])
    return enforce(report, PROGRAM_REPORT)


def refresh_program_report(
    source: DataFrame, target: str, load_ts: Column, table: bool = False, on_error: str = "raise"
) -> None:
    overwrite_table(build_program_report(source, load_ts, on_error), target, table)


def create_report_view(report: DataFrame, view: str) -> None:
    """View with an explicit column list; no filter, no masking."""
    report.select(*PROGRAM_REPORT.names).createOrReplaceTempView(view)


def publish_program_report(
    source: DataFrame, folder: str, view: str, load_ts: datetime, on_error: str = "raise"
) -> str:
    """Full refresh whose readers never meet an empty or half-written table.

    Each run writes a folder of its own; the catalog view is moved to it once
    the write is done. Folders of earlier runs stay until they are retired.
    """
    target = f"{folder.rstrip('/')}/load_{run_stamp(load_ts)}"
    refresh_program_report(source, target, run_time(load_ts), on_error=on_error)
    columns = ", ".join(PROGRAM_REPORT.names)
    source.sparkSession.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.`{target}`"
    )
    return target
