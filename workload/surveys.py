"""Survey queries. Events stand for survey records: the type is the survey, the
user the contact, the day of the event its date."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions import clean_label_column, rename_columns
from lakeledger.operators.layers import (
    missing_ids,
    missing_records,
    reason_counts,
    unexplained_records,
)
from lakeledger.operators.raw_counts import raw_counts
from lakeledger.operators.survey_counts import (
    daily_counts,
    survey_summary,
    survey_summary_lines,
)
from lakeledger.plans.reconcile import (
    Options,
    Paths,
    ReconciliationError,
    dates_by_survey,
    latest_by_survey,
    log_rows,
    not_applicable_as_text,
    reconcile,
    run_reconciliation,
    run_totals,
    select_surveys,
    skip_done,
)
from lakeledger.plans.deliveries import delivery_counts, take_in
from lakeledger.plans.survey_counts import write_daily_counts
from lakeledger.session import scratch_path
from lakeledger.sinks.reports import write_anomalies, write_ledger, write_report
from lakeledger.sinks.tables import overwrite_table, write_partitions, write_staged
from lakeledger.sources.json import read_control_dates
from lakeledger.sources.layers import (
    child_folders,
    date_folders,
    latest_event_dates,
    list_event_dates,
    partition_has_data,
    read_layer,
    read_ledger,
    survey_config,
)
from workload.base import day_text, query, table

# The surveys of the test data: an argument of the jobs. Errors and signups
# have no sentiment step.
CONFIGS = [
    {
        "survey_name": kind.upper(),
        "raw_survey_name": f"{kind} survey",
        "curated_folder": f"folder={kind}",
        "sentiment_folder": f"folder={kind}" if active else None,
        "quarantine_folder": f"folder={kind}" if active else None,
        "sentiment_pipeline_active": active,
    }
    for kind, active in (
        ("click", True),
        ("error", False),
        ("purchase", True),
        ("signup", False),
        ("view", True),
    )
]
NOW = datetime(2026, 5, 12, 8, 0, 0)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated layer: every event."""
    return table(spark, sf_dir, "events").select(
        F.upper("event_type").alias("survey_name"),
        day_text("ts").alias("event_date"),
        F.col("user_id").cast("string").alias("contact_record_id"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "ts",
        "event_id",
    )


def scored(curated: DataFrame) -> DataFrame:
    """Sentiment layer."""
    return curated.filter("value >= 5")


def removed(curated: DataFrame) -> DataFrame:
    """Quarantine: low values, with a reason or with none."""
    reason = F.when(F.col("k") < 30, "REPEATED").when(F.col("k") < 60, "DOUBLE_ENTRY")
    return curated.filter("value < 2").withColumn("removal_reason", reason)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw layer: each record in the folder of its day, high values delivered there
    twice, and all once more in the next day's window; low values have no date."""
    base = records(spark, sf_dir).select(
        F.concat(F.lit(" "), F.initcap("survey_name"), F.lit(" Survey ")).alias("raw_survey_name"),
        "contact_record_id",
        F.when(F.col("value") < 1, "  ").otherwise(F.col("ts").cast("string")).alias(
            "invitation_date"
        ),
        "event_date",
        "value",
        "event_id",
    )
    window = F.array(
        F.struct(F.col("event_date").alias("event_date")),
        F.struct(F.date_add("event_date", 1).cast("string").alias("event_date")),
    )
    again = F.array(F.struct(F.col("event_date").alias("event_date")))
    folders = F.when(F.col("value") >= 10, F.concat(window, again)).otherwise(window)
    return base.select(
        "raw_survey_name", "contact_record_id", "invitation_date", "event_id", F.inline(folders)
    )


# The same layers on the SQL side.
_LAYERS = r"""
curated AS (
  SELECT upper(event_type) AS survey_name, ts::DATE::VARCHAR AS event_date,
         user_id::VARCHAR AS contact_record_id, value,
         regexp_extract(props, '(\d+)', 1)::INT AS k
  FROM events
), sentiment AS (SELECT * FROM curated WHERE value >= 5
), quarantine AS (
  SELECT survey_name, event_date, contact_record_id,
         min(CASE WHEN k < 30 THEN 'REPEATED' WHEN k < 60 THEN 'DOUBLE_ENTRY' END) AS reason
  FROM curated WHERE value < 2 GROUP BY 1, 2, 3
), missing AS (
  SELECT survey_name, event_date, contact_record_id FROM curated
  EXCEPT SELECT survey_name, event_date, contact_record_id FROM sentiment
), explained AS (
  SELECT m.*, q.contact_record_id IS NOT NULL AS accounted,
         CASE WHEN q.contact_record_id IS NULL THEN 'UNACCOUNTED' ELSE q.reason END AS removal_reason
  FROM missing m LEFT JOIN quarantine q USING (survey_name, event_date, contact_record_id)
), reasons AS (
  SELECT survey_name, event_date, removal_reason, count(*) AS record_count,
         sum(CASE WHEN accounted THEN 0 ELSE 1 END)::BIGINT AS unaccounted_count
  FROM explained GROUP BY 1, 2, 3
)"""

_RAW = """
valid AS (
  SELECT upper(event_type) AS survey_name, ts::DATE::VARCHAR AS event_date, user_id, value
  FROM events WHERE value >= 1
), naive AS (
  SELECT survey_name, event_date, sum(CASE WHEN value >= 10 THEN 2 ELSE 1 END)::BIGINT AS raw_count
  FROM valid GROUP BY 1, 2
), once AS (
  SELECT event_date, user_id, min(survey_name) AS survey_name FROM valid GROUP BY 1, 2
), deduped AS (
  SELECT survey_name, event_date, count(*) AS raw_count FROM once GROUP BY 1, 2
)"""


def explained(spark, sf_dir):
    curated = records(spark, sf_dir)
    return missing_records(curated, scored(curated), removed(curated))


@query(
    "raw_count_naive",
    f"WITH {_RAW} SELECT event_date, lower(survey_name) || ' survey' AS raw_survey_name, raw_count FROM naive",
)
def raw_count_naive(spark, sf_dir):
    return raw_counts(deliveries(spark, sf_dir), dedup=False)


@query(
    "raw_count_dedup",
    f"WITH {_RAW} SELECT event_date, lower(survey_name) || ' survey' AS raw_survey_name, raw_count FROM deduped",
)
def raw_count_dedup(spark, sf_dir):
    return raw_counts(deliveries(spark, sf_dir))


@query(
    "raw_count_of_two_runs",
    f"""WITH {_RAW}
SELECT event_date, lower(survey_name) || ' survey' AS raw_survey_name, raw_count, TRUE AS deduplicated FROM deduped
UNION ALL SELECT event_date, lower(survey_name) || ' survey', raw_count, FALSE FROM naive""",
)
def raw_count_of_two_runs(spark, sf_dir):
    """Half of the records are delivered after the first run; the second takes in their files and no others."""
    root = scratch_path(spark, "two-runs")
    raw = deliveries(spark, sf_dir)
    days = [r[0] for r in raw.select("event_date").distinct().collect()]
    late = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    numbers = []
    for at, part in enumerate((raw.filter(~late), raw.filter(late), raw.filter("false"))):
        _write_deliveries(part, f"{root}/raw", f"window {at}")
        numbers.append(take_in(spark, f"{root}/raw", f"{root}/state", days)[0])
    assert numbers[0] > 0 and numbers[1] > 0 and numbers[2] == 0
    counts = [
        delivery_counts(spark, f"{root}/state", days, dedup).withColumn("deduplicated", F.lit(dedup)) for dedup in (True, False)
    ]
    return counts[0].unionByName(counts[1])


@query(
    "missing_ids",
    f"WITH {_LAYERS} SELECT * FROM missing",
)
def missing_ids_query(spark, sf_dir):
    curated = records(spark, sf_dir)
    return missing_ids(
        curated, scored(curated), ["survey_name", "event_date", "contact_record_id"]
    )


@query(
    "explained_ids",
    f"WITH {_LAYERS} SELECT survey_name, event_date, contact_record_id, accounted, removal_reason FROM explained",
)
def explained_ids(spark, sf_dir):
    return explained(spark, sf_dir)


@query(
    "reason_counts",
    f"WITH {_LAYERS} SELECT * FROM reasons",
)
def reason_counts_query(spark, sf_dir):
    return reason_counts(explained(spark, sf_dir))


@query(
    "anomaly_ids",
    f"WITH {_LAYERS} SELECT survey_name, event_date, contact_record_id FROM explained WHERE NOT accounted",
)
def anomaly_ids(spark, sf_dir):
    return unexplained_records(explained(spark, sf_dir))


@query(
    "anomaly_detail",
    f"""WITH {_LAYERS}
SELECT survey_name, event_date, contact_record_id AS unaccounted_contact_record_id,
       'now' AS generated_at
FROM explained WHERE NOT accounted""",
)
def anomaly_detail(spark, sf_dir):
    """The rows of the anomaly files, as they were written."""
    path = scratch_path(spark, "anomalies")
    write_anomalies(unexplained_records(explained(spark, sf_dir)), path, "now")
    schema = (
        "generated_at string, unaccounted_contact_record_id string,"
        " event_date string, survey_name string"
    )
    return spark.read.schema(schema).json(path)


def _reconciled(spark, sf_dir, **options):
    curated = records(spark, sf_dir)
    dates = curated.select("event_date").distinct()
    return reconcile(
        dates_by_survey(dates, CONFIGS),
        raw_counts(deliveries(spark, sf_dir)),
        curated,
        scored(curated),
        missing_records(curated, scored(curated), removed(curated)),
        "now",
        **options,
    )


_SUMMARY = f"""
WITH {_LAYERS}, {_RAW}, work AS (
  SELECT DISTINCT c.event_date, s.survey_name, s.survey_name NOT IN ('ERROR', 'SIGNUP') AS active
  FROM curated c, (SELECT DISTINCT upper(event_type) AS survey_name FROM events) s
), summary AS (
  SELECT w.event_date, w.survey_name, w.active,
    coalesce((SELECT raw_count FROM deduped d WHERE d.survey_name = w.survey_name
              AND d.event_date = w.event_date), 0)::BIGINT AS raw_count,
    (SELECT count(*) FROM curated c WHERE c.survey_name = w.survey_name
              AND c.event_date = w.event_date) AS curated_count,
    (SELECT count(*) FROM sentiment c WHERE c.survey_name = w.survey_name
              AND c.event_date = w.event_date) AS sentiment_count,
    (SELECT count(*) FROM explained c WHERE c.survey_name = w.survey_name
              AND c.event_date = w.event_date) AS removed_count,
    (SELECT count(*) FROM explained c WHERE c.survey_name = w.survey_name
              AND c.event_date = w.event_date AND NOT accounted) AS unaccounted_count,
    coalesce((SELECT string_agg(coalesce(removal_reason, 'None') || ': ' || record_count, ', '
                                ORDER BY removal_reason NULLS FIRST)
              FROM reasons c WHERE c.survey_name = w.survey_name
              AND c.event_date = w.event_date), 'NONE') AS reason_breakdown
  FROM work w
)
"""
_SHOWN = """
SELECT event_date, survey_name, raw_count, curated_count,
       raw_count <> curated_count AS raw_curated_mismatch,
       CASE WHEN active THEN sentiment_count END AS sentiment_count,
       CASE WHEN active THEN removed_count END AS removed_count,
       CASE WHEN active THEN unaccounted_count END AS unaccounted_count,
       CASE WHEN active THEN reason_breakdown ELSE 'NONE' END AS reason_breakdown,
       CASE WHEN active THEN 'ACTIVE' ELSE 'RAW_ONLY' END AS pipeline_status
FROM summary"""


@query("reconcile_active", f"{_SUMMARY} {_SHOWN} WHERE active")
def reconcile_active(spark, sf_dir):
    summary = _reconciled(spark, sf_dir).summary
    return summary.filter("pipeline_status = 'ACTIVE'").drop("generated_at")


@query("reconcile_raw_only", f"{_SUMMARY} {_SHOWN} WHERE NOT active")
def reconcile_raw_only(spark, sf_dir):
    summary = _reconciled(spark, sf_dir).summary
    return summary.filter("pipeline_status = 'RAW_ONLY'").drop("generated_at")


@query(
    "reconcile_not_applicable",
    f"""{_SUMMARY}
SELECT event_date, survey_name, raw_count,
       CASE WHEN active THEN sentiment_count::VARCHAR ELSE 'N/A' END AS sentiment_count,
       CASE WHEN active THEN removed_count::VARCHAR ELSE 'N/A' END AS removed_count,
       CASE WHEN active THEN unaccounted_count::VARCHAR ELSE 'N/A' END AS unaccounted_count
FROM summary""",
)
def reconcile_not_applicable(spark, sf_dir):
    shown = not_applicable_as_text(_reconciled(spark, sf_dir).summary)
    return shown.select(
        "event_date",
        "survey_name",
        "raw_count",
        "sentiment_count",
        "removed_count",
        "unaccounted_count",
    )


@query(
    "reconcile_reason_list",
    f"""{_SUMMARY}
SELECT r.survey_name, r.event_date, r.removal_reason, r.record_count
FROM reasons r WHERE survey_name NOT IN ('ERROR', 'SIGNUP')""",
)
def reconcile_reason_list(spark, sf_dir):
    summary = _reconciled(spark, sf_dir, reasons_as="list").summary
    return summary.select("survey_name", "event_date", F.inline("reason_breakdown"))


@query(
    "reconcile_whitespace",
    f"""{_SUMMARY} SELECT event_date, survey_name, raw_count FROM summary""",
)
def reconcile_whitespace(spark, sf_dir):
    """Names with tabs and line ends around them, on both sides of the name join."""
    raw = deliveries(spark, sf_dir).withColumn(
        "raw_survey_name", F.concat(F.lit("\t"), F.trim("raw_survey_name"), F.lit("\r\n"))
    )
    configs = [{**c, "raw_survey_name": f"{c['raw_survey_name']}\n"} for c in CONFIGS]
    curated = records(spark, sf_dir)
    summary = reconcile(
        dates_by_survey(curated.select("event_date").distinct(), configs),
        raw_counts(raw, all_whitespace=True),
        curated,
        scored(curated),
        missing_records(curated, scored(curated), removed(curated)),
        "now",
        all_whitespace=True,
    ).summary
    return summary.select("event_date", "survey_name", "raw_count")


def _write_layers(spark, sf_dir, paths: Paths, nested: bool = False) -> None:
    """The layers as files: date folders below one folder per survey.

    ``nested`` puts the files one folder deeper and the quarantine in Parquet.
    """
    curated = records(spark, sf_dir).withColumn("folder", F.lower("survey_name"))
    keys = ("folder", "event_date")
    if nested:
        keys = (*keys, "half")
        curated = curated.withColumn("half", F.floor(F.hour("ts") / 12))
    layer = ["contact_record_id", *keys]
    # Hundreds of small partitions: their files are opened by all tasks, not by one.
    write_partitions(curated.select(*layer), paths.curated, keys, row_per_key=True)
    write_partitions(scored(curated).select(*layer), paths.sentiment, keys, row_per_key=True)
    write_partitions(
        removed(curated).select("removal_reason", *layer),
        paths.quarantine,
        keys,
        "parquet" if nested else "csv",
        row_per_key=True,
        **({} if nested else {"header": "true"}),
    )
    _write_deliveries(deliveries(spark, sf_dir), paths.raw)


def _write_deliveries(raw: DataFrame, path: str, window: str | None = None) -> None:
    """Deliveries as JSON arrays: a file per date and hash group, below a folder of their window if there is one.

    A date has as many groups as its own records need, about 30,000 to a
    group. So files follow the records, not dates times records.
    """
    groups = raw.groupBy("event_date").agg((F.count(F.lit(1)) / 30_000).cast("bigint").alias("more"))
    record = F.struct(
        F.col("raw_survey_name").alias("Survey Name"),
        F.col("contact_record_id").alias("Contact Record ID"),
        F.col("invitation_date").alias("Invitation Date"),
    )
    # One row per date; a record may lack its date.
    dated = raw.join(
        F.broadcast(groups.withColumnRenamed("event_date", "_date")), F.col("event_date").eqNullSafe(F.col("_date"))
    )
    files = (
        dated.withColumn("part", F.pmod(F.xxhash64("event_id"), F.col("more") + 1))
        .groupBy("event_date", "part")
        .agg(F.to_json(F.collect_list(record)).alias("value"))
    )
    keys = ("event_date", "part")
    if window is not None:
        files, keys = files.withColumn("window", F.lit(window)), ("event_date", "window", "part")
    # The CSV writer is the text writer that lets the file extension be chosen.
    files.write.mode("append").partitionBy(*keys).options(
        header="false", sep="\u0001", quote="\u0002", extension="json"
    ).csv(path)


def _job_paths(spark, name: str) -> Paths:
    root = scratch_path(spark, name)
    return Paths(*[f"{root}/{part}" for part in Paths.__annotations__])


REPORT_SCHEMA = (
    "raw_count bigint, curated_count bigint, raw_curated_mismatch boolean,"
    " sentiment_count bigint, removed_count bigint, unaccounted_count bigint,"
    " reason_breakdown string, pipeline_status string,"
    " event_date string, survey_name string"
)


@query("reconcile_job", f"{_SUMMARY} {_SHOWN}")
def reconcile_job(spark, sf_dir):
    """The whole job over files: layers written, control file read, report read back."""
    paths = _job_paths(spark, "reconcile")
    _write_layers(spark, sf_dir, paths)
    control = f"{paths.work}-control"
    (
        records(spark, sf_dir)
        .agg(F.collect_set("event_date").alias("dates"))
        .select(F.to_json(F.create_map(F.lit("dates"), "dates")).alias("value"))
        .write.text(control)
    )
    run_reconciliation(spark, paths, CONFIGS, NOW, control_file=control)
    return spark.read.schema(REPORT_SCHEMA).json(paths.report)


@query(
    "reconcile_live_job",
    f"""{_SUMMARY}, latest AS (
  SELECT survey_name, max(event_date) AS event_date FROM sentiment
  WHERE survey_name NOT IN ('ERROR', 'SIGNUP') GROUP BY 1
  UNION ALL SELECT survey_name, max(event_date) FROM curated
  WHERE survey_name IN ('ERROR', 'SIGNUP') GROUP BY 1
)
SELECT s.* FROM ({_SHOWN}) s JOIN latest USING (event_date, survey_name)""",
)
def reconcile_live_job(spark, sf_dir):
    """Live mode over layers whose files lie one folder deeper and whose quarantine is Parquet;
    the report is read through its registered table."""
    paths = _job_paths(spark, "reconcile-live")
    _write_layers(spark, sf_dir, paths, nested=True)
    report = f"live_report_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {report} ({REPORT_SCHEMA}) USING json"
        f" PARTITIONED BY (event_date, survey_name) LOCATION '{paths.report}'"
    )
    try:
        options = Options(quarantine_fmt="parquet", report_table=report)
        run_reconciliation(spark, paths, CONFIGS, NOW, options=options)
        # Kept before the table goes.
        kept = f"{paths.work}-shown"
        overwrite_table(spark.table(report), kept)
    finally:
        spark.sql(f"DROP TABLE {report}")
    return spark.read.schema(REPORT_SCHEMA).parquet(kept)


@query(
    "layer_has_data",
    """
SELECT upper(t) AS survey_name, t IN ('click', 'purchase', 'view') AS sentiment_pipeline_active,
       EXISTS (SELECT 1 FROM events WHERE event_type = t AND value >= 50) AS has_data
FROM (SELECT DISTINCT event_type AS t FROM events)""",
)
def layer_has_data(spark, sf_dir):
    """The configuration as a relation, and whether each survey's layer folder holds a row."""
    path = scratch_path(spark, "layer-data")
    rows = records(spark, sf_dir).filter("value >= 50").withColumn("folder", F.lower("survey_name"))
    keys = ("folder", "event_date")
    write_partitions(rows.select("contact_record_id", *keys), path, keys)
    found = [
        (c["survey_name"], partition_has_data(read_layer(spark, f"{path}/{c['curated_folder']}")))
        for c in CONFIGS
    ]
    return (
        survey_config(spark, CONFIGS)
        .join(spark.createDataFrame(found, "survey_name string, has_data boolean"), "survey_name")
        .select("survey_name", "sentiment_pipeline_active", "has_data")
    )


@query(
    "latest_date",
    """
SELECT upper(event_type) AS survey_name, max(ts::DATE)::VARCHAR AS event_date
FROM events GROUP BY 1""",
)
def latest_date(spark, sf_dir):
    return latest_event_dates(records(spark, sf_dir).select("survey_name", "event_date"))


@query(
    "layer_latest_date",
    """
SELECT upper(event_type) AS survey_name, max(ts::DATE)::VARCHAR AS event_date
FROM events WHERE value >= 5 GROUP BY 1""",
)
def layer_latest_date(spark, sf_dir):
    """Latest date per survey from the listing of a written layer."""
    path = scratch_path(spark, "layer")
    keys = ("survey_name", "event_date")
    write_partitions(
        scored(records(spark, sf_dir)).select("contact_record_id", *keys), path, keys
    )
    found = [
        (survey.removeprefix("survey_name="), date)
        for survey in child_folders(spark, path)
        for date in date_folders(spark, f"{path}/{survey}")
    ]
    return latest_event_dates(spark.createDataFrame(found, "survey_name string, event_date string"))


@query(
    "control_dates",
    """
SELECT ts::DATE::VARCHAR AS event_date, count(*) AS row_count
FROM events WHERE ts::DATE IN (SELECT ts::DATE FROM events WHERE value > 100)
GROUP BY 1""",
)
def control_dates(spark, sf_dir):
    """A control file of the days with a high value, read back and applied."""
    curated = records(spark, sf_dir)
    path = scratch_path(spark, "control")
    (
        curated.filter("value > 100")
        .agg(F.collect_set("event_date").alias("dates"))
        .select(F.to_json(F.create_map(F.lit("dates"), "dates")).alias("value"))
        .write.text(path)
    )
    dates = read_control_dates(spark, path)
    return (
        curated.join(dates, "event_date", "left_semi")
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "skip_done",
    """
WITH done AS (SELECT DISTINCT ts::DATE AS d, event_type FROM events WHERE value > 150)
SELECT w.d::VARCHAR AS event_date, upper(w.t) AS survey_name, w.t || ' survey' AS raw_survey_name
FROM (SELECT DISTINCT ts::DATE AS d, t FROM events, (VALUES ('click'), ('error'), ('view')) v(t)) w
WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.d = w.d AND done.event_type = w.t)""",
)
def skip_done_query(spark, sf_dir):
    curated = records(spark, sf_dir)
    configs = select_surveys(CONFIGS, ["CLICK", "ERROR", "VIEW", "UNKNOWN"])
    work = dates_by_survey(curated.select("event_date").distinct(), configs)
    ledger = (
        curated.filter("value > 150")
        .select("event_date", F.col("survey_name").alias("survey_type"))
        .distinct()
    )
    return skip_done(work, ledger).select("event_date", "survey_name", "raw_survey_name")


@query(
    "live_work",
    """
SELECT upper(t) AS survey_name,
       (SELECT max(ts::DATE)::VARCHAR FROM events WHERE event_type = t) AS event_date
FROM (SELECT DISTINCT event_type AS t FROM events UNION SELECT 'letter')""",
)
def live_work(spark, sf_dir):
    """Live mode: the surveys with their own latest date, null without any."""
    latest = latest_event_dates(records(spark, sf_dir))
    letter = {"survey_name": "LETTER", "raw_survey_name": "letter", "sentiment_pipeline_active": False}
    return latest_by_survey(latest, [*CONFIGS, letter]).select("survey_name", "event_date")


@query(
    "run_totals",
    """
WITH d AS (SELECT count(DISTINCT ts::DATE) AS n FROM events)
SELECT 'reconciled' AS status, n AS items FROM d UNION ALL SELECT 'skipped', n FROM d
UNION ALL SELECT 'failed', n FROM d""",
)
def run_totals_query(spark, sf_dir):
    """Log of a real run: one survey is done already, one has an unreadable layer, one is reconciled."""
    paths = _job_paths(spark, "totals")
    _write_layers(spark, sf_dir, paths)
    dates = date_folders(spark, f"{paths.curated}/folder=view")
    every = records(spark, sf_dir).select("event_date").distinct()
    days = sorted({*dates, *(r[0] for r in every.collect())})
    run_reconciliation(spark, paths, CONFIGS, NOW, days, surveys=["SIGNUP"])
    broken = f"{paths.curated}/folder=click"
    for day in days:
        # A layer file without the id column.
        spark.range(1).write.mode("overwrite").parquet(f"{broken}/event_date={day}")
    try:
        run_reconciliation(spark, paths, CONFIGS, NOW, days, surveys=["CLICK", "SIGNUP", "VIEW"])
        raise AssertionError("the broken survey went unnoticed")
    except ReconciliationError as error:
        return run_totals(log_rows(spark, error.run_log))


@query(
    "daily_counts",
    """
SELECT event_type AS survey_name, ts::DATE::VARCHAR AS event_date, count(*) AS row_count
FROM events GROUP BY 1, 2""",
)
def daily_counts_query(spark, sf_dir):
    return daily_counts(records(spark, sf_dir))


@query(
    "survey_summary",
    """
WITH d AS (SELECT event_type, ts::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY 1, 2)
SELECT 0 AS section, event_type AS survey_name, sum(n)::BIGINT AS total_count,
       string_agg(day, ', ' ORDER BY day) AS event_dates FROM d GROUP BY event_type
UNION ALL
SELECT 1, 'GRAND TOTAL (all surveys)', sum(n)::BIGINT, '' FROM d""",
)
def survey_summary_query(spark, sf_dir):
    return survey_summary(daily_counts(records(spark, sf_dir)))


@query(
    "survey_summary_text",
    """
WITH d AS (SELECT event_type, ts::DATE::VARCHAR AS day, count(*) AS n FROM events
           GROUP BY 1, 2),
s AS (SELECT event_type AS name, sum(n)::BIGINT::VARCHAR AS n,
             string_agg(day, ', ' ORDER BY day) AS days FROM d GROUP BY 1)
SELECT 2 AS section, name AS survey_name,
       rpad(name, 29, ' ') || rpad(n, 15, ' ') || rpad(days, greatest(40, length(days))::INT, ' ') AS line FROM s
UNION ALL SELECT 0, NULL, rpad('Survey Name', 29, ' ') || rpad('Total Count', 15, ' ') || rpad('Event Date(s) Processed', 40, ' ')
UNION ALL SELECT x, NULL, repeat('-', 84) FROM (VALUES (1), (3), (5), (7)) v(x)
UNION ALL SELECT 4, NULL, rpad('GRAND TOTAL (all surveys)', 29, ' ') || rpad(sum(n)::BIGINT::VARCHAR, 15, ' ') || repeat(' ', 40) FROM d
UNION ALL SELECT 6, NULL, rpad('Total count entered by hand', 29, ' ') || repeat(' ', 55)""",
)
def survey_summary_text(spark, sf_dir):
    daily = daily_counts(records(spark, sf_dir))
    return survey_summary_lines(survey_summary(daily))


@query(
    "report_partition_overwrite",
    """
SELECT event_type AS survey_name, ts::DATE::VARCHAR AS event_date,
       CASE WHEN event_type = 'purchase' AND sum(CASE WHEN value >= 50 THEN 1 ELSE 0 END) > 0
            THEN sum(CASE WHEN value >= 50 THEN 1 ELSE 0 END) ELSE count(*) END::BIGINT AS row_count,
       CASE WHEN event_type = 'purchase' AND sum(CASE WHEN value >= 50 THEN 1 ELSE 0 END) > 0
            THEN 'second' ELSE 'first' END AS job_run_id
FROM events GROUP BY 1, 2""",
)
def report_partition_overwrite(spark, sf_dir):
    """Daily counts written, then the partitions of a second run replaced."""
    curated = records(spark, sf_dir)
    path = scratch_path(spark, "daily-counts")
    write_daily_counts(curated, path, "first", "dev", NOW)
    again = curated.filter("survey_name = 'PURCHASE' and value >= 50")
    write_daily_counts(again, path, "second", "dev", NOW)
    schema = "row_count bigint, job_run_id string, survey_name string, event_date string"
    return spark.read.schema(schema).parquet(path)


@query(
    "staged_rows",
    """
SELECT event_type AS survey_name, ts::DATE::VARCHAR AS event_date, user_id::VARCHAR AS contact_record_id,
       count(*) OVER () AS rows_written
FROM events""",
)
def staged_rows(spark, sf_dir):
    """Curated rows staged by partition; their number is observed during the write."""
    path = scratch_path(spark, "staged")
    rows = records(spark, sf_dir).select(
        "contact_record_id", F.lower("survey_name").alias("survey_name"), "event_date"
    )
    written = write_staged(rows, path)
    schema = "contact_record_id string, survey_name string, event_date string"
    return spark.read.schema(schema).parquet(path).withColumn(
        "rows_written", F.lit(written).cast("bigint")
    )


@query("report_split_layout", f"{_SUMMARY} {_SHOWN}")
def report_split_layout(spark, sf_dir):
    path = scratch_path(spark, "split-report")
    write_report(_reconciled(spark, sf_dir).summary, path, layout="split")
    active = spark.read.schema(REPORT_SCHEMA).json(f"{path}/active")
    return active.unionByName(spark.read.schema(REPORT_SCHEMA).json(f"{path}/raw_only"))


@query(
    "ledger_upsert",
    f"""{_SUMMARY}
SELECT event_date, survey_name AS survey_type, raw_count, curated_count,
       CASE WHEN active THEN 'ACTIVE' ELSE 'RAW_ONLY' END AS pipeline_status,
       'report/event_date=' || event_date || '/survey_name=' || survey_name AS report_path,
       CASE WHEN active THEN 'second' ELSE 'now' END AS generated_at
FROM summary""",
)
def ledger_upsert(spark, sf_dir):
    """All items written, then the active ones once more: still one row per key."""
    path = scratch_path(spark, "ledger")
    summary = _reconciled(spark, sf_dir).summary
    write_ledger(summary, path, "report")
    again = summary.filter("pipeline_status = 'ACTIVE'")
    write_ledger(again.withColumn("generated_at", F.lit("second")), path, "report/")
    return read_ledger(spark, path).select(
        "raw_count", "curated_count", "pipeline_status", "report_path", "generated_at", "event_date", "survey_type"
    )


@query(
    "clean_label",
    r"""
SELECT event_id, regexp_replace(
  event_type || CASE WHEN value < 5 THEN '-ThankYou' WHEN value < 20 THEN ' - thank  you '
                     WHEN value < 50 THEN 'Thankyou' ELSE ' rate' END,
  '-?\s*thank\s*you\s*$', '', 'i') AS intent
FROM events""",
)
def clean_label_query(spark, sf_dir):
    value = F.col("value")
    suffix = (
        F.when(value < 5, "-ThankYou")
        .when(value < 20, " - thank  you ")
        .when(value < 50, "Thankyou")
        .otherwise(" rate")
    )
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Event ID"), F.concat("event_type", suffix).alias("Intent")
    )
    named = rename_columns(raw, {"Event ID": "event_id", "Intent": "intent"})
    return clean_label_column(named)
