"""Job: reconcile the raw, curated and sentiment layers per survey and date.

All surveys and dates go through the same set-based plan, and no record id
reaches the driver; only the configuration and the dates to work on (control
data) do. The number of Spark jobs grows neither with the surveys nor with the
dates.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.contracts import SURVEY_CONFIG
from lakeledger.functions import normalise_name
from lakeledger.operators.layers import (
    GROUP,
    ID,
    layer_counts,
    missing_records,
    reason_counts,
    reason_list,
    reason_text,
    unexplained_records,
)
from lakeledger.operators.raw_counts import raw_counts_with_broken
from lakeledger.plans.deliveries import delivery_counts, take_in
from lakeledger.session import scratch_path
from lakeledger.sinks.reports import REPORT_KEYS, write_anomalies, write_ledger, write_report
from lakeledger.sinks.tables import overwrite_table, register_partitions
from lakeledger.sources.json import read_control_dates
from lakeledger.sources.layers import (
    NO_COLUMN,
    PARTITION,
    date_folders,
    folder_key,
    latest_event_dates,
    read_layer,
    read_layers,
    read_ledger,
    read_quarantine,
    read_quarantines,
    read_raw_surveys,
)

# Fixed values of the report.
ACTIVE, RAW_ONLY, NOT_APPLICABLE = "ACTIVE", "RAW_ONLY", "N/A"
RECONCILED, SKIPPED, FAILED = "reconciled", "skipped", "failed"
NULLABLE_COUNTS = ("sentiment_count", "removed_count", "unaccounted_count")
REPORT_COLUMNS = (
    "event_date",
    "survey_name",
    "raw_count",
    "curated_count",
    "raw_curated_mismatch",
    "sentiment_count",
    "removed_count",
    "unaccounted_count",
    "reason_breakdown",
    "pipeline_status",
    "generated_at",
)


def _config_entries(configs: list[dict]) -> Column:
    return F.array(
        *[
            F.struct(
                *[F.lit(c.get(s.name)).cast(s.type).alias(s.name) for s in SURVEY_CONFIG.columns]
            )
            for c in configs
        ]
    )


def select_surveys(configs: list[dict], names: Iterable[str] | None = None) -> list[dict]:
    """Survey subset; names that are not configured are ignored."""
    return configs if names is None else [c for c in configs if c["survey_name"] in set(names)]


def dates_by_survey(dates: DataFrame, configs: list[dict]) -> DataFrame:
    """Work list of given dates: every date with every configured survey.

    The configuration is an argument of the job, so it is unfolded from a
    literal array on each date row; there is no join.
    """
    return dates.select("event_date", F.inline(_config_entries(configs)))


def latest_by_survey(latest: DataFrame, configs: list[dict]) -> DataFrame:
    """Work list of live mode: every survey with its own latest date; without one, null."""
    rows = latest.sparkSession.range(1).select(F.inline(_config_entries(configs)))
    return rows.join(latest.select("survey_name", "event_date"), "survey_name", "left").select(
        "event_date", *SURVEY_CONFIG.names
    )


def skip_done(work: DataFrame, ledger: DataFrame) -> DataFrame:
    """Work items that the ledger of finished work does not hold.

    A ledger holds one row per survey and date, by its contract.
    """
    done = ledger.select("event_date", F.col("survey_type").alias("survey_name"))
    return work.join(done, ["event_date", "survey_name"], "left_anti").select(work.columns)


@dataclass(frozen=True)
class Reconciliation:
    summary: DataFrame
    reasons: DataFrame
    unexplained: DataFrame


def reconcile(
    work: DataFrame,
    raw_per_survey: DataFrame,
    curated: DataFrame,
    sentiment: DataFrame,
    missing: DataFrame,
    generated_at: str,
    reasons_as: str = "text",
    all_whitespace: bool = False,
) -> Reconciliation:
    """Summary row per work item.

    ``raw_per_survey`` comes from ``raw_counts``, ``missing`` from
    ``missing_records``; the layers carry (survey_name, event_date,
    contact_record_id). Raw-only surveys have no sentiment side: their counts
    are null. ``reasons_as`` is ``text`` or ``list``. ``all_whitespace`` must be
    what ``raw_counts`` got, so that the names meet.
    """
    reasons = reason_counts(missing)
    listed = reason_list(reasons)
    active = F.col("sentiment_pipeline_active")
    items = work.withColumn("_raw_key", normalise_name(F.col("raw_survey_name"), all_whitespace))
    raw_side = raw_per_survey.withColumnRenamed("raw_survey_name", "_raw_key")
    joined = (
        items.join(raw_side, ["event_date", "_raw_key"], "left")
        .join(layer_counts(curated, "curated_count"), list(GROUP), "left")
        .join(layer_counts(sentiment, "sentiment_count"), list(GROUP), "left")
        .join(listed, list(GROUP), "left")
    )

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    if reasons_as == "text":
        breakdown = F.when(active, reason_text(F.col("reasons"))).otherwise(
            reason_text(F.lit(None).cast("array<struct<removal_reason:string,record_count:bigint>>"))
        )
    elif reasons_as == "list":
        empty = F.array().cast("array<struct<removal_reason:string,record_count:bigint>>")
        breakdown = F.when(active, F.coalesce("reasons", empty)).otherwise(empty)
    else:
        raise ValueError("reasons_as is 'text' or 'list'")

    summary = joined.select(
        "event_date",
        "survey_name",
        count("raw_count").alias("raw_count"),
        count("curated_count").alias("curated_count"),
        (count("raw_count") != count("curated_count")).alias("raw_curated_mismatch"),
        *[F.when(active, count(name)).alias(name) for name in NULLABLE_COUNTS],
        breakdown.alias("reason_breakdown"),
        F.when(active, F.lit(ACTIVE)).otherwise(F.lit(RAW_ONLY)).alias("pipeline_status"),
        F.lit(generated_at).alias("generated_at"),
    )
    return Reconciliation(summary, reasons, unexplained_records(missing))


def not_applicable_as_text(summary: DataFrame) -> DataFrame:
    """Older form of the report: counts as text, ``N/A`` where a survey has none."""
    return summary.withColumns(
        {
            name: F.coalesce(F.col(name).cast("string"), F.lit(NOT_APPLICABLE))
            for name in NULLABLE_COUNTS
        }
    )


def run_totals(run_log: DataFrame) -> DataFrame:
    """(status, items): how many work items were reconciled, skipped or failed."""
    return run_log.groupBy("status").agg(F.count(F.lit(1)).alias("items"))


@dataclass(frozen=True)
class Paths:
    """Folders of the layers and of the results."""

    raw: str
    curated: str
    sentiment: str
    quarantine: str
    report: str
    anomalies: str
    ledger: str
    # Staging of a run, overwritten by the next one; a new scratch folder if not given.
    work: str | None = None


@dataclass(frozen=True)
class Options:
    dedup: bool = True
    quarantine_fmt: str = "csv"
    layout: str = "unified"
    na_as_text: bool = False
    reasons_as: str = "text"
    skip_done_on_override: bool = True
    # Any white space around survey names is cut, not blanks only.
    all_whitespace: bool = False
    # Folder of what raw deliveries have said: files are then parsed in one run only.
    raw_state: str | None = None
    # Table over the report folder: the partitions of a run are made visible in it.
    report_table: str | None = None


class ReconciliationError(RuntimeError):
    """Some work items failed; the others are written. ``run_log`` tells which."""

    def __init__(self, message: str, run_log: list[dict]):
        super().__init__(message)
        self.run_log = run_log


def log_rows(spark: SparkSession, log: list[dict]) -> DataFrame:
    """The log of a run as rows (event_date, survey_name, status, message)."""
    names = ("event_date", "survey_name", "status", "message")
    return spark.createDataFrame(
        [tuple(row[n] for n in names) for row in log], ", ".join(f"{n} string" for n in names)
    )


def _message(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _named(df: DataFrame, config: dict) -> DataFrame:
    return df.withColumn("survey_name", F.lit(config["survey_name"]))


def live_dates(spark: SparkSession, paths: Paths, configs: list[dict]) -> DataFrame:
    """Latest date per survey: of its sentiment folder, or curated when raw-only."""
    found = []
    for c in configs:
        if c["sentiment_pipeline_active"]:
            folder = f"{paths.sentiment}/{c['sentiment_folder']}"
        else:
            folder = f"{paths.curated}/{c['curated_folder']}"
        found += [(c["survey_name"], date) for date in date_folders(spark, folder)]
    return latest_event_dates(
        spark.createDataFrame(found, "survey_name string, event_date string")
    )


def resolve_work(
    spark: SparkSession,
    paths: Paths,
    configs: list[dict],
    dates: Iterable[str] | None = None,
    options: Options = Options(),
) -> tuple[list[tuple[str, str]], list[tuple[str | None, str]]]:
    """((date, survey) items to do, items that are skipped).

    This is control data: at most the given dates times the configured surveys.
    """
    if dates is None:
        wanted = latest_by_survey(live_dates(spark, paths, configs), configs)
    else:
        day_rows = spark.createDataFrame([(d,) for d in sorted(set(dates))], "event_date string")
        wanted = dates_by_survey(day_rows, configs)
    every = [(r[0], r[1]) for r in wanted.select("event_date", "survey_name").collect()]
    todo = wanted.filter(F.col("event_date").isNotNull())
    if dates is None or options.skip_done_on_override:
        todo = skip_done(todo, read_ledger(spark, paths.ledger, {d for d, _ in every if d is not None}))
    do = [(r[0], r[1]) for r in todo.select("event_date", "survey_name").collect()]
    done = set(do)
    return do, [item for item in every if item not in done]


@dataclass(frozen=True)
class _Layers:
    curated: DataFrame
    sentiment: DataFrame
    quarantine: DataFrame

    def union(self, other: _Layers) -> _Layers:
        return _Layers(
            self.curated.unionByName(other.curated),
            self.sentiment.unionByName(other.sentiment),
            self.quarantine.unionByName(other.quarantine),
        )


def _folders(paths: Paths, config: dict) -> dict[str, str]:
    """Folder of each layer that a survey has."""
    found = {"curated": f"{paths.curated}/{config['curated_folder']}"}
    if config["sentiment_pipeline_active"]:
        found["sentiment"] = f"{paths.sentiment}/{config['sentiment_folder']}"
        found["quarantine"] = f"{paths.quarantine}/{config['quarantine_folder']}"
    return found


def _days_of(items: list[tuple[str, str]]) -> dict[str, list[str]]:
    """Survey -> its own dates: in live mode they differ from survey to survey."""
    found: dict[str, set[str]] = {}
    for day, survey in items:
        found.setdefault(survey, set()).add(day)
    return {survey: sorted(days) for survey, days in found.items()}


def _common_layers(
    spark: SparkSession, paths: Paths, configs: list[dict], items: list[tuple[str, str]], options: Options
) -> _Layers:
    """Layers of all surveys of ``items``: one scan for each kind of layer."""
    days = _days_of(items)
    folders: dict[str, dict[str, str]] = {"curated": {}, "sentiment": {}, "quarantine": {}}
    for config in configs:
        if config["survey_name"] in days:
            for kind, folder in _folders(paths, config).items():
                folders[kind][config["survey_name"]] = folder
    return _Layers(
        read_layers(spark, folders["curated"], days),
        read_layers(spark, folders["sentiment"], days),
        read_quarantines(spark, folders["quarantine"], days, options.quarantine_fmt),
    )


def _own_layers(
    spark: SparkSession, paths: Paths, config: dict, dates: list[str], options: Options
) -> _Layers:
    """Layers of one survey by the schemas of its files: for ids that are no text, and to find out what is wrong."""
    folders = _folders(paths, config)
    curated = read_layer(spark, folders["curated"], dates)
    if config["sentiment_pipeline_active"]:
        sentiment = read_layer(spark, folders["sentiment"], dates)
        quarantine = read_quarantine(spark, folders["quarantine"], dates, options.quarantine_fmt)
    else:
        sentiment = curated.limit(0)
        quarantine = sentiment.withColumn("removal_reason", F.lit(None).cast("string"))
    return _Layers(*(_named(df, config) for df in (curated, sentiment, quarantine)))


def _reconcile_and_write(
    spark: SparkSession,
    paths: Paths,
    configs: list[dict],
    layers: _Layers,
    items: list[tuple[str, str]],
    raw_per_survey: DataFrame,
    generated_at: str,
    options: Options,
    staging: str,
) -> None:
    by_name = {c["survey_name"]: c for c in configs}
    work = spark.createDataFrame(
        [(d, *[by_name[s].get(n) for n in SURVEY_CONFIG.names]) for d, s in items],
        f"event_date string, {', '.join(f'{c.name} {c.type}' for c in SURVEY_CONFIG.columns)}",
    )
    active = sorted({s for _, s in items if by_name[s]["sentiment_pipeline_active"]})
    missing = missing_records(
        layers.curated.filter(F.col("survey_name").isin(active)) if active else layers.curated.limit(0),
        layers.sentiment,
        layers.quarantine,
    )
    # Summary, anomalies and ledger all need it: written once, read three times.
    staged = f"{staging}/missing"
    overwrite_table(missing, staged)
    result = reconcile(
        work,
        raw_per_survey,
        layers.curated,
        layers.sentiment,
        spark.read.schema(missing.schema).parquet(staged),
        generated_at,
        reasons_as=options.reasons_as,
        all_whitespace=options.all_whitespace,
    )
    summary_path = f"{staging}/summary"
    overwrite_table(result.summary, summary_path)
    summary = spark.read.schema(result.summary.schema).parquet(summary_path)
    shown = not_applicable_as_text(summary) if options.na_as_text else summary
    # The report first, the ledger last: an item is done only when all is written.
    write_report(shown, paths.report, options.layout)
    write_anomalies(result.unexplained, paths.anomalies, generated_at)
    write_ledger(summary, paths.ledger, paths.report)


def _bad_surveys(
    spark: SparkSession,
    paths: Paths,
    configs: list[dict],
    items: list[tuple[str, str]],
    options: Options,
    error: Exception,
    own: dict[str, _Layers],
) -> dict[str, str]:
    """Survey -> message of those that made the common job fail; never none of all that are left.

    Every survey's schemas are looked at: a layer without its columns fails its
    survey. The error names the file that could not be read: one that lacks the
    id column fails its survey; if the schemas of that survey are sound, it goes
    into ``own`` and is read by them from now on (ids that are no text), and if
    it is there already, it has failed. An error that points at no survey has
    failed them all.
    """
    days, bad = _days_of(items), {}
    found: dict[str, _Layers] = {}
    for config in configs:
        survey = config["survey_name"]
        if survey in days and survey not in own:
            try:
                found[survey] = _own_layers(spark, paths, config, days[survey], options)
            except Exception as reason:  # noqa: BLE001 - any bad survey is logged, the rest goes on
                bad[survey] = _message(reason)
    told = str(error)
    named = [
        c["survey_name"]
        for c in configs
        if c["survey_name"] in days
        and any(f"{folder_key(spark, folder)}/{PARTITION}=" in told for folder in _folders(paths, c).values())
    ]
    for survey in named:
        if survey in own or (NO_COLUMN in told and survey not in bad):
            bad[survey] = _message(error)
        elif survey in found:
            own[survey] = found[survey]
    if not bad and not any(survey in found for survey in named):
        return dict.fromkeys(days, _message(error))
    return bad


def run_reconciliation(
    spark: SparkSession,
    paths: Paths,
    configs: list[dict],
    generated_at: datetime,
    dates: Iterable[str] | None = None,
    control_file: str | None = None,
    surveys: Iterable[str] | None = None,
    options: Options = Options(),
) -> list[dict]:
    """Run the job and return its log: (event_date, survey_name, status, message) rows.

    The dates are the given ones, else those of the control file, else (live
    mode) the latest date of each survey.

    One scan per kind of layer serves all surveys, so the number of Spark jobs
    depends neither on surveys nor on dates. A date with an unreadable raw file
    and a survey with an unreadable layer fail on their own: when the common
    job fails, its error and the schemas tell which surveys are bad, and it
    runs again without them. With any failure the run raises at the end, after
    writing the rest.
    """
    configs = select_surveys(configs, surveys)
    log: list[dict] = []

    def note(item: tuple[str | None, str], status: str, message: str = "") -> None:
        log.append(
            {"event_date": item[0], "survey_name": item[1], "status": status, "message": message}
        )

    if dates is None and control_file is not None:
        dates = [r["event_date"] for r in read_control_dates(spark, control_file).collect()]
    staging = paths.work or scratch_path(spark, "reconciliation")
    items, skipped = resolve_work(spark, paths, configs, dates, options)
    for item in skipped:
        note(item, SKIPPED)
    days = sorted({d for d, _ in items})

    counted = f"{staging}/raw-counts"
    if items and options.raw_state:
        _, broken = take_in(spark, paths.raw, options.raw_state, days, options.all_whitespace)
        counts = delivery_counts(spark, options.raw_state, days, options.dedup)
        overwrite_table(counts, counted)
        per_survey = spark.read.schema(counts.schema).parquet(counted)
    elif items:
        # One pass over the raw files gives one small row per survey and date.
        raw = raw_counts_with_broken(
            read_raw_surveys(spark, paths.raw, days), options.dedup, options.all_whitespace
        )
        overwrite_table(raw, counted)
        marked = spark.read.schema(raw.schema).parquet(counted)
        broken = {r[0] for r in marked.filter("is_broken").select("event_date").distinct().collect()}
        per_survey = marked.filter("not is_broken").drop("is_broken")
    if items:
        for item in [i for i in items if i[0] in broken]:
            note(item, FAILED, "unreadable raw file")
        items = [i for i in items if i[0] not in broken]

    own: dict[str, _Layers] = {}
    while items:
        try:
            common = _common_layers(spark, paths, configs, [i for i in items if i[1] not in own], options)
            _reconcile_and_write(
                spark,
                paths,
                configs,
                reduce(_Layers.union, own.values(), common),
                items,
                per_survey,
                generated_at.isoformat(),
                options,
                staging,
            )
            for item in items:
                note(item, RECONCILED)
            break
        except Exception as error:  # noqa: BLE001 - find out which surveys it was
            bad = _bad_surveys(spark, paths, configs, items, options, error, own)
            for item in [i for i in items if i[1] in bad]:
                note(item, FAILED, bad[item[1]])
            items = [i for i in items if i[1] not in bad]
            own = {survey: layers for survey, layers in own.items() if survey not in bad}

    if options.report_table:
        written = [{k: r[k] for k in REPORT_KEYS} for r in log if r["status"] == RECONCILED]
        register_partitions(spark, options.report_table, written)
    failures = sum(1 for row in log if row["status"] == FAILED)
    if failures:
        raise ReconciliationError(f"{failures} reconciliation(s) failed", log)
    return log
