import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeledger.contracts import (
    NUMBER,
    ColumnSpec,
    Contract,
    enforce,
    split_rejects,
    violation_counts,
    with_load_ts,
)
from lakeledger.functions import run_time
from lakeledger.operators.quality import (
    date_coverage,
    key_duplicates,
    key_duplicates_after,
    key_orphans,
    key_orphans_after,
    populated_share,
)
from lakeledger.operators.versions import maybe_in, of_batch, unseen_rows
from lakeledger.operators.survey_counts import daily_counts, survey_summary
from lakeledger.plans.program_report import (
    PROGRAM_REPORT,
    REPORT_COLUMNS,
    build_program_report,
    create_report_view,
    publish_program_report,
    refresh_program_report,
    source_type,
)
from lakeledger.plans.survey_counts import summary_report, write_daily_counts
from lakeledger.session import scratch_path
from lakeledger.sinks.reports import write_report
from lakeledger.sinks.tables import (
    append_table,
    overwrite_table,
    register_partitions,
    write_csv,
    write_staged,
)

NOW = datetime(2026, 5, 12, 8, 0, 0)


def staged(spark, *groups):
    rows = [(s, d, i) for s, d, n in groups for i in range(n)]
    return spark.createDataFrame(rows, "survey_name string, event_date string, i int")


def read_counts(spark, path):
    schema = "row_count bigint, job_run_id string, survey_name string, event_date string"
    rows = spark.read.schema(schema).parquet(path).collect()
    return {(r["survey_name"], r["event_date"]): (r["row_count"], r["job_run_id"]) for r in rows}


def test_daily_counts_replace_only_their_partitions(spark, folder):
    path = f"{folder}/counts"
    first = staged(spark, ("A", "2026-05-11", 3), ("a", "2026-05-12", 2), ("b", "2026-05-11", 4))
    write_daily_counts(first, path, "run1", "dev", NOW)
    write_daily_counts(staged(spark, ("a", "2026-05-11", 1)), path, "run2", "dev", NOW)
    assert read_counts(spark, path) == {
        ("a", "2026-05-11"): (1, "run2"),
        ("a", "2026-05-12"): (2, "run1"),
        ("b", "2026-05-11"): (4, "run1"),
    }
    body = next(Path(path).glob("survey_name=b/*/*.parquet"))
    assert spark.read.parquet(str(body)).columns == ["row_count", "job_run_id", "env", "processed_ts"]
    write_daily_counts(staged(spark), path, "run3", "dev", NOW)
    assert len(read_counts(spark, path)) == 3


def test_survey_summary_and_text(spark):
    daily = daily_counts(
        staged(spark, ("A", "2026-05-12", 2), ("a", "2026-05-11", 3), ("b", "2026-05-11", 4))
    )
    rows = {r["survey_name"]: (r["total_count"], r["event_dates"]) for r in survey_summary(daily).collect()}
    assert rows == {
        "a": (5, "2026-05-11, 2026-05-12"),
        "b": (4, "2026-05-11"),
        "GRAND TOTAL (all surveys)": (9, ""),
    }
    lines = [r["line"] for r in summary_report(daily).collect()]
    width = len("Total count entered by hand") + 2
    rule = "-" * (width + 55)

    def line(name, count, dates):
        return f"{name:<{width}}{count:<15}{dates:<40}"

    assert lines == [
        line("Survey Name", "Total Count", "Event Date(s) Processed"),
        rule,
        line("a", 5, "2026-05-11, 2026-05-12"),
        line("b", 4, "2026-05-11"),
        rule,
        line("GRAND TOTAL (all surveys)", 9, ""),
        rule,
        line("Total count entered by hand", "", ""),
        rule,
    ]
    nothing = [r["line"] for r in summary_report(daily_counts(staged(spark))).collect()]
    assert nothing == ["No surveys were processed in this run."]
    long_name = "n" * 40
    lines = [r["line"] for r in summary_report(daily_counts(staged(spark, (long_name, "d", 1)))).collect()]
    assert lines[1] == "-" * (42 + 55)


def test_staged_rows_are_counted_while_written(spark, folder):
    rows = staged(spark, ("a", "d1", 30), ("b", "d1", 12))
    assert write_staged(rows, f"{folder}/staged") == 42
    assert write_staged(staged(spark, ("a", "d1", 5)), f"{folder}/staged") == 5
    assert spark.read.parquet(f"{folder}/staged").count() == 17


def test_csv_has_header_and_never_overwrites(spark, folder):
    df = spark.createDataFrame([("x", None), ('q"u,o', 1), ("", 2), (" y ", 3)], "a string, b int")
    path = write_csv(df.coalesce(1), f"{folder}/", NOW)
    assert path == f"{folder}/combined_20260512T080000Z"
    text = next(Path(path).glob("*.csv")).read_text()
    assert text == 'a,b\nx,\n"q""u,o",1\n,2\n y ,3\n'
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        write_csv(df, folder, NOW)


def test_overwrite_and_append(spark, folder):
    df = spark.range(3)
    append_table(df, f"{folder}/t")
    append_table(df, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 6
    overwrite_table(df, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3


def test_new_partitions_are_registered(spark, folder):
    spark.sql(
        f"""CREATE TABLE report_table (raw_count BIGINT, event_date STRING, survey_name STRING)
        USING json PARTITIONED BY (event_date, survey_name) LOCATION '{folder}/report'"""
    )
    try:
        summary = spark.createDataFrame(
            [("2026-05-11", "A", 3), ("2026-05-12", "A", None)],
            "event_date string, survey_name string, raw_count bigint",
        )
        write_report(summary, f"{folder}/report")
        assert spark.table("report_table").count() == 0
        register_partitions(spark, "report_table")
        assert spark.table("report_table").count() == 2
        body = next(Path(folder).glob("report/event_date=2026-05-12/survey_name=A/*.json"))
        assert json.loads(body.read_text()) == {"raw_count": None}
    finally:
        spark.sql("DROP TABLE report_table")


CONTRACT = Contract(
    "things", (ColumnSpec("id", NUMBER, nullable=False), ColumnSpec("name", length=3))
)


def test_contract(spark):
    df = spark.createDataFrame(
        [("abc", 1, 0), ("abcd", 2, 0), (None, None, 0)], "name string, id int, extra int"
    )
    good, bad = split_rejects(df, CONTRACT)
    assert [tuple(r) for r in good.collect()] == [(1, "abc")]
    assert sorted(r["broken_rules"][0] for r in bad.collect()) == ["id: null", "name: longer than 3"]
    counts = {r["rule"]: r["violations"] for r in violation_counts(df, CONTRACT).collect()}
    assert counts == {"id: null": 1, "name: longer than 3": 1}
    assert enforce(df.filter("id = 1"), CONTRACT).schema == CONTRACT.schema
    for condition, message in (("id = 2", "longer than 3"), ("id is null", "id: null")):
        with pytest.raises(Exception, match=message):
            enforce(df.filter(condition), CONTRACT).collect()


class StubSession:
    """A session without a configured checkpoint folder."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, key, default):
        return default


def test_scratch_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_path(spark, "x").startswith(f"{shared.rstrip('/')}/lakeledger/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert "/lakeledger/x-" in scratch_path(StubSession("local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(StubSession("spark://host:7077"), "x")


def test_load_ts_default(spark):
    df = with_load_ts(spark.range(1), run_time(NOW))
    assert df.first()["load_ts"] == NOW
    assert with_load_ts(df, run_time(datetime(2000, 1, 1))).first()["load_ts"] == NOW


def report_source(spark, **changes):
    samples = {
        "text": "t", "number": 7, "time": datetime(2026, 1, 1), "flag": False,
        "us_time": "08/16/2026 01:02:03 PM", "us_date": "08/16/2026", "iso_date": "2026-08-16",
    }
    columns = [(n, k) for n, k in REPORT_COLUMNS if k != "load"]
    return spark.range(1).select(
        *[
            F.lit(changes.get(n, samples[k])).cast(source_type(k)).alias(n) for n, k in columns
        ]
    )


def test_program_report(spark, folder):
    assert len(REPORT_COLUMNS) == 64
    kinds = [k for _, k in REPORT_COLUMNS]
    assert [kinds.count(k) for k in ("us_time", "us_date", "iso_date", "number", "text")] == [8, 6, 1, 12, 32]
    refresh_program_report(report_source(spark), f"{folder}/report", run_time(NOW))
    create_report_view(spark.read.parquet(f"{folder}/report"), "report_under_test")
    row = spark.table("report_under_test").first()
    assert spark.table("report_under_test").columns == PROGRAM_REPORT.names
    assert row["ADMIT_DATE"] == row["PROGRAM_CLOSED_DATE"] == datetime(2026, 8, 16)
    assert row["ENGAGED_DATE"] == datetime(2026, 8, 16, 13, 2, 3)
    assert row["PROVIDER_OUTREACH_REQUESTED"] == "No"
    assert row["LOAD_TS"] == NOW
    blank = report_source(spark, ADMIT_DATE=None, PROVIDER_OUTREACH_REQUESTED=True)
    row = build_program_report(blank, run_time(NOW)).first()
    assert row["ADMIT_DATE"] is None and row["PROVIDER_OUTREACH_REQUESTED"] == "true"
    bad = report_source(spark, ADMIT_DATE="soon")
    with pytest.raises(Exception, match="soon"):
        build_program_report(bad, run_time(NOW)).collect()
    assert build_program_report(bad, run_time(NOW), "null").first()["ADMIT_DATE"] is None


def test_published_report_moves_its_view(spark, folder):
    first = publish_program_report(report_source(spark), f"{folder}/r", "published_report", NOW)
    try:
        assert first.endswith("load_20260512T080000Z")
        assert spark.table("published_report").columns == PROGRAM_REPORT.names
        later = report_source(spark, CLIENT="new")
        publish_program_report(later, f"{folder}/r", "published_report", datetime(2026, 5, 13))
        assert [r["CLIENT"] for r in spark.table("published_report").collect()] == ["new"]
        bad = report_source(spark, ADMIT_DATE="soon")
        with pytest.raises(Exception, match="soon"):
            publish_program_report(bad, f"{folder}/r", "published_report", datetime(2026, 5, 14))
        assert [r["CLIENT"] for r in spark.table("published_report").collect()] == ["new"]
    finally:
        spark.sql("DROP VIEW published_report")


def test_quality_reports(spark):
    df = spark.createDataFrame(
        [("a", "2026-01-01", "x"), ("a", "2026-01-04", None), ("b", "2026-01-02", None)],
        "g string, d string, v string",
    )
    shares = {r["g"]: r["populated_share"] for r in populated_share(df, ["g"], "v").collect()}
    assert shares == {"a": 0.5, "b": 0.0}
    gaps = sorted((r["g"], str(r["missing_date"])) for r in date_coverage(df, ["g"], "d").collect())
    assert gaps == [("a", "2026-01-02"), ("a", "2026-01-03")]
    gaps = date_coverage(df, ["g"], "d", start="2026-01-01", end="2026-01-02").collect()
    assert sorted((r["g"], str(r["missing_date"])) for r in gaps) == [("a", "2026-01-02"), ("b", "2026-01-01")]
    keys = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert [tuple(r) for r in key_duplicates(keys, ["k"]).collect()] == [(1, 2)]
    parents = spark.createDataFrame([(2,), (2,)], "p int")
    assert [tuple(r) for r in key_orphans(keys, parents, ["k"], ["p"]).collect()] == [(1, 2)]


def test_key_filter_leaves_what_may_match(spark):
    """Every stored row of the batch, hardly another, and no shuffle of the stored rows before the filter."""
    final = spark.range(20_000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("s"),
        F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit("2026-01-01").cast("timestamp_ntz")).alias("updated_on"),
    )
    batch = final.filter("k % 100 = 3").unionByName(final.filter("k < 20").withColumn("k", F.lit(None).cast("bigint")))
    keys = ["k", "s"]
    want = {r["k"] for r in final.filter("k % 100 = 3 and s is not null").collect()}
    found = [r["k"] for r in of_batch(final, batch, keys).collect()]
    assert want <= set(found) and len(found) == len(set(found)) <= len(want) + 2
    # A filter that is far too small lets more pass, and never fewer.
    assert want <= {r["k"] for r in of_batch(final, batch, keys, bits=64).collect()}
    assert of_batch(final, batch.limit(0), keys).count() == 0
    plan = unseen_rows(batch, of_batch(final, batch, keys), keys)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 1
    # The span of versions is in the plan as constants.
    assert "2026-01-01 00:00:00" in plan
    all_rows = final.unionByName(final.filter("k % 100 = 3").withColumn("updated_on", F.lit("2027-01-01").cast("timestamp_ntz")))
    left = unseen_rows(all_rows, of_batch(final, all_rows, keys), keys)
    assert left.count() == 200 + final.filter("s is null").count()


def test_only_the_partitions_of_a_run_are_registered(spark, folder, monkeypatch):
    """A thousand old partitions that the table doesn't know stay unknown; those named are added once."""
    table = "report_of_runs"
    spark.sql(f"CREATE TABLE {table} (n int, event_date string, survey_name string) USING json PARTITIONED BY (event_date, survey_name) LOCATION '{folder}/report'")
    try:
        for day in range(1000):
            (Path(folder) / "report" / f"event_date=1990-{day}" / "survey_name=OLD").mkdir(parents=True)
        new = [("2026-05-11", "A'B"), ("2026-05-12", "C=D")]
        rows = spark.createDataFrame([(1, *key) for key in new], "n int, event_date string, survey_name string")
        rows.write.partitionBy("event_date", "survey_name").mode("append").json(f"{folder}/report")
        monkeypatch.setattr(type(spark.catalog), "recoverPartitions", None)
        for _ in range(2):
            register_partitions(spark, table, [{"event_date": d, "survey_name": s} for d, s in new])
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2
        assert {(r["event_date"], r["survey_name"]) for r in spark.table(table).collect()} == set(new)
        register_partitions(spark, table, [])
    finally:
        spark.sql(f"DROP TABLE {table}")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_checks_of_loads_equal_the_full_checks(spark):
    """Three loads, with null key parts, keys that turn duplicate, gain rows or meet their parent late."""
    child = "a int, b string"
    loads = [
        [(1, "x"), (1, "x"), (2, "x"), (None, "x"), (3, None), (4, "y")],
        [(2, "x"), (1, "x"), (None, "x"), (5, "z"), (5, "z"), (6, "q")],
        [],
        [(3, None), (4, "y"), (6, "q"), (7, "x"), (None, None), (8, "x")],
    ]
    parents = [[(1, "x"), (4, "y")], [(6, "q"), (None, "x")], [(2, "x")], [(5, "z"), (7, "x"), (7, "x")]]
    keys, parent_keys = ["a", "b"], ["p", "q"]
    stored = spark.createDataFrame([], child)
    known = spark.createDataFrame([], "p int, q string")
    repeated, orphans = key_duplicates(stored, keys), key_orphans(stored, known, keys, parent_keys)
    for load, more in zip(loads, parents, strict=True):
        appended = spark.createDataFrame(load, child)
        known = known.union(spark.createDataFrame(more, "p int, q string"))
        repeated = spark.createDataFrame(
            key_duplicates_after(repeated, appended, stored, keys).collect(), child + ", row_count long"
        )
        orphans = spark.createDataFrame(
            key_orphans_after(orphans, appended, known, keys, parent_keys).collect(), child + ", row_count long"
        )
        stored = stored.union(appended)
        assert rows_of(repeated) == rows_of(key_duplicates(stored, keys))
        assert rows_of(orphans) == rows_of(key_orphans(stored, known, keys, parent_keys))
    assert rows_of(repeated) and rows_of(orphans)


def test_a_check_of_a_load_shuffles_few_stored_rows(spark, folder):
    spark.range(200_000).withColumnRenamed("id", "k").write.parquet(f"{folder}/stored")
    stored = spark.read.parquet(f"{folder}/stored")
    appended = spark.range(100, 120).withColumnRenamed("id", "k")
    df = key_duplicates_after(key_duplicates(stored, ["k"]).limit(0), appended, stored, ["k"])
    assert {tuple(r) for r in df.collect()} == {(k, 2) for k in range(100, 120)}
    assert maybe_in(stored, appended, ["k"]).count() < 100
