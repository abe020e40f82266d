import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeledger.functions import run_stamp
from lakeledger.plans import deliveries
from lakeledger.plans import reconcile as reconcile_module
from lakeledger.plans.reconcile import (
    Options,
    Paths,
    ReconciliationError,
    log_rows,
    run_reconciliation,
    run_totals,
)
from lakeledger.operators.layers import missing_ids, missing_records, reason_counts
from lakeledger.operators.raw_counts import raw_counts
from lakeledger.contracts import LEDGER
from lakeledger.sinks import reports
from lakeledger.sinks.reports import compact_ledger, write_anomalies, write_ledger
from lakeledger.sources import layers
from lakeledger.sources.json import read_control_dates
from lakeledger.sources.layers import (
    list_event_dates,
    partition_has_data,
    read_layer,
    read_ledger,
    read_quarantine,
    read_raw_surveys,
    survey_config,
)
from workload import surveys

DAY = "2026-05-11"
NOW = datetime(2026, 5, 12, 8, 0, 0)
CONFIGS = [
    {
        "survey_name": "PHONE",
        "raw_survey_name": "phone survey",
        "curated_folder": "survey_phone",
        "sentiment_folder": "phone",
        "quarantine_folder": "phone_quarantine",
        "sentiment_pipeline_active": True,
    },
    {
        "survey_name": "WEB",
        "raw_survey_name": "Web Survey ",
        "curated_folder": "survey_web",
        "sentiment_folder": "web",
        "quarantine_folder": "web_quarantine",
        "sentiment_pipeline_active": True,
    },
    {
        "survey_name": "MAIL",
        "raw_survey_name": "mail survey",
        "curated_folder": "survey_mail",
        "sentiment_folder": None,
        "quarantine_folder": None,
        "sentiment_pipeline_active": False,
    },
]


def raw_record(survey, contact, when):
    return {"Survey Name": survey, "Contact Record ID": contact, "Invitation Date": when, "x": 1}


def put(path, text):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text)


def ids(spark, path, values):
    spark.createDataFrame(
        [(v, "other") for v in values], "contact_record_id string, other string"
    ).coalesce(1).write.parquet(path)


@pytest.fixture
def paths(spark, folder):
    p = Paths(*[f"{folder}/{n}" for n in Paths.__annotations__])
    raw = f"{p.raw}/event_date={DAY}"
    put(
        f"{raw}/one.json",
        json.dumps(
            [
                raw_record("Phone Survey", "r1", f"{DAY} 08:00:00"),
                raw_record("Phone Survey", "r2", f"{DAY} 09:00:00"),
                raw_record("Phone Survey", "r9", "2026-05-10 23:00:00"),
                raw_record("Phone Survey", "r8", "  "),
                raw_record("mail survey", "m1", f"{DAY} 08:00:00"),
                raw_record("unknown survey", "u1", f"{DAY} 08:00:00"),
            ]
        ),
    )
    put(
        f"{raw}/two.json",
        json.dumps(
            [
                raw_record(" phone survey ", "r2", f"{DAY} 09:00:00"),
                raw_record(" phone survey ", "r3", f" {DAY} 10:00:00"),
            ],
            indent=1,
        ),
    )
    put(f"{raw}/notes.txt", "not a delivery")
    ids(spark, f"{p.curated}/survey_phone/event_date={DAY}", ["r1", "r2", "r3"])
    put(f"{p.curated}/survey_phone/event_date={DAY}/readme.txt", "stray")
    ids(spark, f"{p.sentiment}/phone/event_date={DAY}", ["r1"])
    put(
        f"{p.quarantine}/phone_quarantine/event_date={DAY}/q.csv",
        "removal_reason,contact_record_id\nDOUBLE_ENTRY,r2\n",
    )
    ids(spark, f"{p.curated}/survey_mail/event_date={DAY}", ["m1", "m2"])
    return p


def report_rows(path):
    found = {}
    for file in Path(path).glob("event_date=*/survey_name=*/*.json"):
        for line in file.read_text().splitlines():
            found[(file.parts[-3][11:], file.parts[-2][12:])] = json.loads(line)
    return found


def test_whole_run(spark, paths):
    log = run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY])
    assert {(r["survey_name"], r["status"]) for r in log} == {
        ("PHONE", "reconciled"), ("WEB", "reconciled"), ("MAIL", "reconciled"),
    }
    report = report_rows(paths.report)
    assert report[(DAY, "PHONE")] == {
        "raw_count": 3, "curated_count": 3, "raw_curated_mismatch": False,
        "sentiment_count": 1, "removed_count": 2, "unaccounted_count": 1,
        "reason_breakdown": "DOUBLE_ENTRY: 1, UNACCOUNTED: 1", "pipeline_status": "ACTIVE",
        "generated_at": NOW.isoformat(),
    }
    # Nothing there at all: zero counts, nothing missing.
    assert report[(DAY, "WEB")] == {
        "raw_count": 0, "curated_count": 0, "raw_curated_mismatch": False,
        "sentiment_count": 0, "removed_count": 0, "unaccounted_count": 0,
        "reason_breakdown": "NONE", "pipeline_status": "ACTIVE", "generated_at": NOW.isoformat(),
    }
    assert report[(DAY, "MAIL")] == {
        "raw_count": 1, "curated_count": 2, "raw_curated_mismatch": True,
        "sentiment_count": None, "removed_count": None, "unaccounted_count": None,
        "reason_breakdown": "NONE", "pipeline_status": "RAW_ONLY",
        "generated_at": NOW.isoformat(),
    }
    assert report_rows(paths.anomalies) == {
        (DAY, "PHONE"): {
            "generated_at": NOW.isoformat(), "unaccounted_contact_record_id": "r3",
        }
    }
    ledger = spark.read.parquet(paths.ledger)
    assert ledger.count() == 3
    assert "reason_breakdown" not in ledger.columns
    row = ledger.filter("survey_type = 'MAIL'").first()
    assert row["report_path"].endswith(f"event_date={DAY}/survey_name=MAIL")

    again = run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY])
    assert {r["status"] for r in again} == {"skipped"}
    totals = run_totals(log_rows(spark, again)).collect()
    assert [(r["status"], r["items"]) for r in totals] == [("skipped", 3)]
    redo = run_reconciliation(
        spark, paths, CONFIGS, NOW, dates=[DAY], options=Options(skip_done_on_override=False)
    )
    assert {r["status"] for r in redo} == {"reconciled"}
    assert spark.read.parquet(paths.ledger).count() == 3


def test_naive_counts_and_older_forms(spark, paths):
    options = Options(dedup=False, layout="split", na_as_text=True, reasons_as="list")
    run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY], options=options)
    phone = report_rows(f"{paths.report}/active")[(DAY, "PHONE")]
    assert phone["raw_count"] == 4 and phone["raw_curated_mismatch"] is True
    assert phone["reason_breakdown"] == [
        {"removal_reason": "DOUBLE_ENTRY", "record_count": 1},
        {"removal_reason": "UNACCOUNTED", "record_count": 1},
    ]
    mail = report_rows(f"{paths.report}/raw_only")[(DAY, "MAIL")]
    assert mail["sentiment_count"] == "N/A" and mail["reason_breakdown"] == []


def test_live_mode_takes_latest_date_of_each_survey(spark, paths):
    ids(spark, f"{paths.sentiment}/phone/event_date=2026-05-09", ["r0"])
    ids(spark, f"{paths.curated}/survey_mail/event_date=2026-05-12", ["m3"])
    log = run_reconciliation(spark, paths, CONFIGS, NOW)
    assert sorted((r["survey_name"], r["event_date"], r["status"]) for r in log) == [
        ("MAIL", "2026-05-12", "reconciled"),
        ("PHONE", DAY, "reconciled"),
        ("WEB", None, "skipped"),
    ]
    assert set(report_rows(paths.report)) == {("2026-05-12", "MAIL"), (DAY, "PHONE")}


def test_dates_of_a_control_file(spark, paths, folder):
    put(f"{folder}/dates.json", json.dumps({"dates": [DAY, "2026-05-10", DAY]}))
    log = run_reconciliation(spark, paths, CONFIGS, NOW, control_file=f"{folder}/dates.json")
    assert len(log) == 6 and {r["event_date"] for r in log} == {DAY, "2026-05-10"}
    # A raw record of the day before lies in this day's folder and counts for neither.
    assert report_rows(paths.report)[("2026-05-10", "PHONE")]["raw_count"] == 0


def test_survey_subset(spark, paths):
    log = run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY], surveys=["MAIL", "nope"])
    assert [r["survey_name"] for r in log] == ["MAIL"]


def test_unreadable_raw_file_fails_its_date_only(spark, paths):
    put(f"{paths.raw}/event_date=2026-05-12/cut.json", '[{"Survey Name":"phone')
    with pytest.raises(ReconciliationError) as caught:
        run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY, "2026-05-12"])
    statuses = {(r["event_date"], r["status"]) for r in caught.value.run_log}
    assert statuses == {(DAY, "reconciled"), ("2026-05-12", "failed")}
    assert {d for d, _ in report_rows(paths.report)} == {DAY}


def test_unreadable_layer_fails_its_survey_only(spark, paths):
    put(f"{paths.curated}/survey_web/event_date={DAY}/broken.parquet", "no parquet")
    with pytest.raises(ReconciliationError) as caught:
        run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY])
    statuses = {(r["survey_name"], r["status"]) for r in caught.value.run_log}
    assert statuses == {("PHONE", "reconciled"), ("MAIL", "reconciled"), ("WEB", "failed")}


def layer(spark, rows):
    return spark.createDataFrame(
        [("S", DAY, r) for r in rows], "survey_name string, event_date string, contact_record_id string"
    )


def quarantined(spark, rows):
    return spark.createDataFrame(
        [("S", DAY, *r) for r in rows],
        "survey_name string, event_date string, contact_record_id string, removal_reason string",
    )


def test_missing_records_cases(spark):
    curated = layer(spark, ["a", "a", "b", "c", "d", None])
    sentiment = layer(spark, ["a", "z"])
    quarantine = quarantined(spark, [("b", "Z"), ("b", "A"), ("c", None), ("x", "Q")])
    got = {
        r["contact_record_id"]: (r["accounted"], r["removal_reason"])
        for r in missing_records(curated, sentiment, quarantine).collect()
    }
    assert got == {
        "b": (True, "A"), "c": (True, None),
        "d": (False, "UNACCOUNTED"), None: (False, "UNACCOUNTED"),
    }
    null_known = quarantined(spark, [(None, "N")])
    rows = missing_records(layer(spark, [None]), sentiment, null_known).collect()
    assert [(r["accounted"], r["removal_reason"]) for r in rows] == [(True, "N")]


def test_reasons_add_up(spark):
    curated = layer(spark, [f"i{n}" for n in range(200)])
    sentiment = layer(spark, [f"i{n}" for n in range(50)])
    quarantine = quarantined(spark, [(f"i{n}", f"R{n % 3}") for n in range(40, 120)])
    missing = missing_records(curated, sentiment, quarantine)
    reasons = reason_counts(missing).collect()
    assert sum(r["record_count"] for r in reasons) == missing.count() == 150
    assert sum(r["unaccounted_count"] for r in reasons) == 80


def test_missing_ids_treats_nulls_as_equal(spark):
    left = layer(spark, ["a", None, "b"])
    right = layer(spark, [None, "b"])
    keys = ["survey_name", "event_date", "contact_record_id"]
    assert [r[2] for r in missing_ids(left, right, keys).collect()] == ["a"]


def test_id_of_two_surveys_counts_for_the_lowest_name(spark):
    raw = spark.createDataFrame(
        [("b", "1", DAY, DAY), ("A ", "1", DAY, DAY), ("b", None, DAY, DAY), ("b", None, DAY, DAY),
         (None, "2", DAY, DAY)],
        "raw_survey_name string, contact_record_id string, invitation_date string, event_date string",
    )
    got = {r["raw_survey_name"]: r["raw_count"] for r in raw_counts(raw).collect()}
    assert got == {"a": 1, "b": 1, None: 1}
    got = {r["raw_survey_name"]: r["raw_count"] for r in raw_counts(raw, dedup=False).collect()}
    assert got == {"a": 1, "b": 3, None: 1}


def test_anomalies_are_a_row_per_id_at_any_size(spark, folder):
    rows = layer(spark, [None, *[f"i{n}" for n in range(1000)]])
    write_anomalies(rows, folder, "now")
    found = spark.read.schema(
        "generated_at string, unaccounted_contact_record_id string, survey_name string, event_date string"
    ).json(folder).select("generated_at", "unaccounted_contact_record_id", "survey_name", "event_date")
    assert {tuple(r) for r in found.collect()} == {
        ("now", i, "S", DAY) for i in (None, *[f"i{n}" for n in range(1000)])
    }


def test_control_dates_use_the_first_key(spark, folder):
    put(f"{folder}/c.json", '{"z":["2026-05-12","2026-05-11","2026-05-12"],\n "a":["2020-01-01"]}')
    got = [r[0] for r in read_control_dates(spark, f"{folder}/c.json").collect()]
    assert got == ["2026-05-11", "2026-05-12"]
    put(f"{folder}/e.json", "{}")
    assert read_control_dates(spark, f"{folder}/e.json").count() == 0


def test_listing_and_readers(spark, paths, folder):
    put(f"{paths.curated}/survey_phone/tmp/x.parquet", "")
    dates = [r[0] for r in list_event_dates(spark, f"{paths.curated}/survey_phone").collect()]
    assert dates == [DAY]
    assert list_event_dates(spark, f"{folder}/nowhere").count() == 0
    raw = read_raw_surveys(spark, paths.raw, [DAY])
    rows = raw.collect()
    assert len(rows) == 8 and not any(r["is_broken"] for r in rows)
    assert read_raw_surveys(spark, f"{folder}/nowhere", [DAY]).count() == 0
    spark.createDataFrame([(1, "why")], "contact_record_id int, removal_reason string").write.parquet(
        f"{folder}/pq/event_date={DAY}"
    )
    older = read_quarantine(spark, f"{folder}/pq", [DAY], fmt="parquet").collect()
    assert [tuple(r) for r in older] == [("1", "why", DAY)]
    assert read_quarantine(spark, f"{folder}/pq", ["2026-01-01"], fmt="parquet").count() == 0


def test_layer_reads_one_column_of_the_wanted_folders(spark, paths):
    layer_df = read_layer(spark, f"{paths.curated}/survey_phone", [DAY])
    plan = layer_df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<contact_record_id:string>" in plan
    assert "PartitionFilters: []" not in plan and "event_date" in plan
    assert partition_has_data(layer_df)
    assert not partition_has_data(read_layer(spark, f"{paths.curated}/survey_phone", ["2020-01-01"]))
    (Path(paths.curated) / "empty" / "event_date=2026-01-01").mkdir(parents=True)
    assert not partition_has_data(read_layer(spark, f"{paths.curated}/empty"))


def test_survey_without_the_id_column_fails_alone(spark, paths):
    spark.range(3).write.parquet(f"{paths.curated}/survey_web/event_date={DAY}")
    with pytest.raises(ReconciliationError) as caught:
        run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY])
    statuses = {(r["survey_name"], r["status"]) for r in caught.value.run_log}
    assert statuses == {("PHONE", "reconciled"), ("MAIL", "reconciled"), ("WEB", "failed")}


def test_config_relation(spark):
    rows = survey_config(spark, CONFIGS).collect()
    assert [(r["survey_name"], r["sentiment_pipeline_active"]) for r in rows] == [
        ("PHONE", True), ("WEB", True), ("MAIL", False),
    ]
    assert rows[2]["sentiment_folder"] is None


def test_dates_of_nested_folders(spark, folder):
    put(f"{folder}/event_date=2026-01-01/part=0/x.json", "[]")
    put(f"{folder}/event_date=2026-01-02/x.json", "[]")
    put(f"{folder}/other/event_date=2026-01-03/x.json", "[]")
    assert [r[0] for r in list_event_dates(spark, folder).collect()] == ["2026-01-01", "2026-01-02"]
    ids(spark, f"{folder}/layer/event_date=2026-01-01/hour=3", ["a"])
    ids(spark, f"{folder}/layer/event_date=2026-01-02/hour=4", ["b"])
    rows = read_layer(spark, f"{folder}/layer", ["2026-01-01", "2026-01-05"]).collect()
    assert [tuple(r) for r in rows] == [("a", "2026-01-01")]


def test_surveys_read_their_own_dates_only(spark, paths, monkeypatch):
    ids(spark, f"{paths.sentiment}/phone/event_date=2026-05-09", ["r0"])
    ids(spark, f"{paths.curated}/survey_mail/event_date=2026-05-12", ["m3"])
    asked = []
    read = reconcile_module.read_layers
    monkeypatch.setattr(
        reconcile_module, "read_layers",
        lambda spark, folders, dates: asked.append((sorted(folders), dates)) or read(spark, folders, dates),
    )
    run_reconciliation(spark, paths, CONFIGS, NOW)
    days = {"PHONE": [DAY], "MAIL": ["2026-05-12"]}
    assert asked == [(["MAIL", "PHONE"], days), (["PHONE"], days)]


def test_error_that_points_at_no_survey(spark, paths, monkeypatch):
    def fail(*_):
        raise ValueError

    monkeypatch.setattr(reconcile_module, "write_report", fail)
    with pytest.raises(ReconciliationError) as caught:
        run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY])
    messages = {r["survey_name"]: r["message"] for r in caught.value.run_log}
    assert messages == {"PHONE": "ValueError: ", "WEB": "ValueError: ", "MAIL": "ValueError: "}


def counted(monkeypatch):
    """How often the common job runs."""
    runs = []
    run = reconcile_module._reconcile_and_write
    monkeypatch.setattr(reconcile_module, "_reconcile_and_write", lambda *args: runs.append(1) or run(*args))
    return runs


@pytest.mark.parametrize("kind", ["cut", "no column", "late file without column", "csv header"])
def test_a_bad_survey_costs_one_more_run(spark, paths, monkeypatch, kind):
    ids(spark, f"{paths.curated}/survey_web/event_date={DAY}", ["w1", "w2"])
    if kind == "cut":
        whole = next(Path(f"{paths.curated}/survey_web/event_date={DAY}").glob("*.parquet"))
        whole.write_bytes(whole.read_bytes()[:-20])
        (whole.parent / f".{whole.name}.crc").unlink()
    elif kind == "no column":
        spark.range(3).write.mode("overwrite").parquet(f"{paths.curated}/survey_web/event_date={DAY}")
    elif kind == "late file without column":
        spark.range(3).coalesce(1).write.parquet(f"{paths.curated}/survey_web/event_date={DAY}/zz")
    else:
        put(f"{paths.quarantine}/web_quarantine/event_date={DAY}/q.csv", "id,why\nw1,X\n")
    runs = counted(monkeypatch)
    with pytest.raises(ReconciliationError) as caught:
        run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY])
    assert {(r["survey_name"], r["status"]) for r in caught.value.run_log} == {
        ("PHONE", "reconciled"), ("MAIL", "reconciled"), ("WEB", "failed"),
    }
    assert len(runs) <= (3 if kind == "late file without column" else 2)
    assert report_rows(paths.report)[(DAY, "PHONE")]["unaccounted_count"] == 1


def test_ids_that_are_numbers(spark, paths, monkeypatch):
    """Such a survey is read by its own schema, and still counts."""
    spark.range(3).select("id", F.col("id").alias("contact_record_id")).write.parquet(f"{paths.curated}/survey_web/event_date={DAY}")
    put(f"{paths.quarantine}/web_quarantine/event_date={DAY}/q.csv", '"x",removal_reason,"contact_record_id"\n7,WHY,2\n')
    runs = counted(monkeypatch)
    run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY])
    assert len(runs) == 2
    web = report_rows(paths.report)[(DAY, "WEB")]
    assert (web["curated_count"], web["reason_breakdown"]) == (3, "UNACCOUNTED: 2, WHY: 1")


def test_number_of_jobs_does_not_depend_on_surveys(spark, folder):
    """One survey or five, one date or three: the same number of Spark jobs."""

    def jobs(surveys, days):
        p = Paths(*[f"{folder}/{surveys}-{days}/{n}" for n in Paths.__annotations__])
        configs = [
            {**CONFIGS[0], "survey_name": f"S{k}", "raw_survey_name": f"s{k}", "curated_folder": f"c {k}",
             "sentiment_folder": f"s{k}", "quarantine_folder": f"q{k}"}
            for k in range(surveys)
        ]
        dates = [f"2026-05-{11 + d}" for d in range(days)]
        for day in dates:
            put(f"{p.raw}/event_date={day}/a.json", json.dumps([raw_record(f"s{k}", f"{k}", day) for k in range(surveys)]))
            for k in range(surveys):
                ids(spark, f"{p.curated}/c {k}/event_date={day}", [f"{k}", f"{k}-b", f"{k}-c"])
                ids(spark, f"{p.sentiment}/s{k}/event_date={day}", [f"{k}"])
                put(f"{p.quarantine}/q{k}/event_date={day}/q.csv", f"contact_record_id,removal_reason\n{k}-b,R\n")
        group = f"{surveys}-{days}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            log = run_reconciliation(spark, p, configs, NOW, dates=dates)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(log) == surveys * days and {r["status"] for r in log} == {"reconciled"}
        assert {tuple(r[c] for c in ("raw_count", "curated_count", "reason_breakdown")) for r in report_rows(p.report).values()} == {(1, 3, "R: 1, UNACCOUNTED: 1")}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few = jobs(1, 1)
    assert jobs(5, 1) == few == jobs(5, 3)


def test_staging_is_overwritten(spark, paths):
    for _ in range(2):
        run_reconciliation(
            spark, paths, CONFIGS, NOW, dates=[DAY], options=Options(skip_done_on_override=False)
        )
    assert sorted(p.name for p in Path(paths.work).iterdir()) == ["missing", "raw-counts", "summary"]


def test_white_space_around_names(spark, paths):
    configs = [{**c, "raw_survey_name": f"\t{c['raw_survey_name']}\n"} for c in CONFIGS]
    options = Options(all_whitespace=True)
    run_reconciliation(spark, paths, configs, NOW, dates=[DAY], options=options)
    assert report_rows(paths.report)[(DAY, "PHONE")]["raw_count"] == 3


def test_raw_rows_go_by_hash_first(spark, paths):
    plan = raw_counts(read_raw_surveys(spark, paths.raw, [DAY]))
    steps = plan._jdf.queryExecution().sparkPlan().toString().splitlines()
    kinds = [line.strip(" +-:*()0123456789") for line in steps]
    aggregates = [k.split("(")[0] for k in kinds if "Aggregate(" in k]
    # From the top down; the last two stand next to the raw rows.
    assert aggregates[-2:] == ["HashAggregate", "HashAggregate"]


def test_run_stamps_are_utc():
    zoned = datetime(2026, 1, 1, tzinfo=timezone(timedelta(hours=5)))
    assert run_stamp(zoned) == "20251231T190000Z"
    assert run_stamp(datetime(2026, 1, 1)) == "20260101T000000Z"


def ledger_summary(spark, rows, stamp):
    """Summary rows (day, survey, raw count)."""
    columns = "event_date string, survey_name string, raw_count bigint"
    found = spark.createDataFrame(rows, columns)
    for c in LEDGER.columns:
        if c.name not in (*found.columns, "survey_type", "report_path"):
            found = found.withColumn(c.name, F.lit(stamp if c.name == "generated_at" else None).cast(c.type))
    return found


def ledger_of(spark, path, dates=None):
    return {(r["event_date"], r["survey_type"]): r["raw_count"] for r in read_ledger(spark, path, dates).collect()}


def test_two_ledger_writers_lose_nothing(spark, folder):
    """Both write the same date at the same time, again and again."""
    path = f"{folder}/ledger"

    def write(who):
        for n in range(3):
            write_ledger(ledger_summary(spark, [(DAY, who, n), (DAY, f"{who}{n}", n)], "now"), path, "report")

    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(write, "A"), pool.submit(write, "B")]:
            done.result()
    assert ledger_of(spark, path) == {(DAY, k): n for w in "AB" for k, n in [(w, 2), *[(f"{w}{n}", n) for n in range(3)]]}
    compact_ledger(spark, path, [DAY])
    assert spark.read.parquet(path).count() == 8
    assert [p.name for p in Path(path).iterdir()] == [f"event_date={DAY}"]


def test_entry_added_during_a_compaction(spark, folder, monkeypatch):
    """It stays, and counts against older entries that the compaction has written after it."""
    path = f"{folder}/ledger"
    monkeypatch.setattr(reports, "compact_ledger", lambda *_: None)
    write_ledger(ledger_summary(spark, [(DAY, "A", 1), (DAY, "B", 1)], "z"), path, "report")
    write_ledger(ledger_summary(spark, [(DAY, "B", 2)], "a"), path, "report")
    read = reports.newest_entries

    def meanwhile(entries):
        write_ledger(ledger_summary(spark, [(DAY, "A", 3)], "a"), path, "report")
        return read(entries)

    monkeypatch.setattr(reports, "newest_entries", meanwhile)
    compact_ledger(spark, path, [DAY])
    assert ledger_of(spark, path) == {(DAY, "A"): 3, (DAY, "B"): 2}


def test_ledger_reads_the_wanted_dates_only(spark, folder):
    path = f"{folder}/ledger"
    days = [f"2026-01-{d:02}" for d in range(1, 21)]
    write_ledger(ledger_summary(spark, [(d, "A", 1) for d in days], "now"), path, "report")
    found = read_ledger(spark, path, ["2026-01-03", "2026-01-04", "2027-01-01"])
    assert {f.split("event_date=")[1][:10] for f in found.inputFiles()} == {"2026-01-03", "2026-01-04"}
    assert ledger_of(spark, path, ["2026-01-03"]) == {("2026-01-03", "A"): 1}
    assert read_ledger(spark, f"{folder}/nothing", ["2026-01-03"]).count() == 0
    # A table of the time before entries had a commit time.
    old = spark.read.parquet(path).drop("committed_at").filter("event_date = '2026-01-05'").withColumn("raw_count", F.lit(9).cast("bigint"))
    rows = spark.createDataFrame(old.collect(), old.schema)
    rows.write.partitionBy("event_date").mode("append").parquet(path)
    assert ledger_of(spark, path, ["2026-01-05"]) == {("2026-01-05", "A"): 1}


@pytest.mark.parametrize("dedup", [True, False])
def test_deliveries_are_parsed_once(spark, paths, folder, monkeypatch, dedup):
    """Two deliveries in two runs count like one run over both, and the second run reads the new file only."""
    read = []
    reader = deliveries.read_raw_surveys
    monkeypatch.setattr(deliveries, "read_raw_surveys", lambda *a, files: read.append([Path(f).name for f in files]) or reader(*a, files=files))
    state, options = f"{folder}/state", Options(dedup=dedup, raw_state=f"{folder}/state", skip_done_on_override=False)
    run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY], options=options)
    assert report_rows(paths.report)[(DAY, "PHONE")]["raw_count"] == (3 if dedup else 4)
    more = [raw_record("phone survey", "r3", DAY), raw_record("phone survey", "r4", DAY), raw_record("mail survey", "r1", DAY), raw_record("phone survey", None, DAY)]
    put(f"{paths.raw}/event_date={DAY}/later/three.json", json.dumps(more))
    put(f"{paths.raw}/event_date=2026-05-12/cut.json", '[{"Survey Name":"phone')
    with pytest.raises(ReconciliationError) as caught:
        run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY, "2026-05-12"], options=options)
    assert {(r["event_date"], r["status"]) for r in caught.value.run_log} == {(DAY, "reconciled"), ("2026-05-12", "failed")}
    run_reconciliation(spark, paths, CONFIGS, NOW, dates=[DAY], options=options)
    assert [sorted(names) for names in read] == [["one.json", "two.json"], ["cut.json", "three.json"]]
    whole = {r["raw_survey_name"]: r["raw_count"] for r in raw_counts(read_raw_surveys(spark, paths.raw, [DAY]), dedup).collect()}
    assert {r["raw_survey_name"]: r["raw_count"] for r in deliveries.delivery_counts(spark, state, [DAY], dedup).collect()} == whole
    assert report_rows(paths.report)[(DAY, "PHONE")]["raw_count"] == whole["phone survey"]
    # A run that stops before its list of files has taken in nothing.
    put(f"{paths.raw}/event_date={DAY}/four.json", json.dumps([raw_record("phone survey", "r7", DAY)]))
    move = deliveries.move_file

    def stop(spark, source, target):
        if "/files/" in target:
            raise OSError("stopped")
        move(spark, source, target)

    monkeypatch.setattr(deliveries, "move_file", stop)
    with pytest.raises(OSError, match="stopped"):
        deliveries.take_in(spark, paths.raw, state, [DAY])
    assert {r["raw_survey_name"]: r["raw_count"] for r in deliveries.delivery_counts(spark, state, [DAY], dedup).collect()} == whole
    monkeypatch.setattr(deliveries, "move_file", move)
    assert deliveries.take_in(spark, paths.raw, state, [DAY]) == (1, set())
    counts = {r["raw_survey_name"]: r["raw_count"] for r in deliveries.delivery_counts(spark, state, [DAY], dedup).collect()}
    assert counts == {**whole, "phone survey": whole["phone survey"] + 1}
    assert deliveries.take_in(spark, f"{folder}/nowhere", state, [DAY]) == (0, set())


def test_delivery_files_follow_records(spark, folder):
    """Many dates and many records: a date has the files that its own records need."""
    rows = spark.range(70_000).selectExpr(
        "'View Survey' AS raw_survey_name", "cast(id AS string) AS contact_record_id", "'2026-01-01' AS invitation_date",
        "id AS event_id",
        "CASE WHEN id < 1000 THEN NULL WHEN id < 20000 THEN concat('2026-01-', 10 + id % 19) ELSE '2026-02-01' END AS event_date",
    )
    surveys._write_deliveries(rows, folder)
    files = list(Path(folder).rglob("*.json"))
    assert len(files) <= 19 + 1 + 2
    per_date = {}
    for file in files:
        date = file.parent.parent.name
        per_date[date] = per_date.get(date, 0) + len(json.loads(file.read_text()))
    assert per_date.pop("event_date=2026-02-01") == 50_000
    assert per_date.pop("event_date=__HIVE_DEFAULT_PARTITION__") == 1_000
    assert set(per_date.values()) == {1_000} and len(per_date) == 19


def test_survey_and_date_come_from_any_form_of_path(spark):
    """No pattern runs over the path of each row."""
    places = ["file:///a_b/x", "file:/a_b/x", "hdfs://host:8020/a_b/x", "/a_b/x", "s3a://bucket/a_b/x"]
    rows = [(f"{place}/event_date=2026-01-0{n}/deep/event_date=9/f:/{n}.parquet", n) for n, place in enumerate(places, 1)]
    files = spark.createDataFrame(rows + [("file:/other/event_date=1/f", 9)], "file string, id int")
    found = layers._by_survey(spark, files, {"VIEW": "/a_b/x"}, ["id"])
    assert sorted(map(tuple, found.collect())) == [("VIEW", f"2026-01-0{n}", n) for n in range(1, 6)]
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()
