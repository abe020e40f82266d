"""Daily survey counts and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the text report.
TOTAL_LABEL = "GRAND TOTAL (all surveys)"
MANUAL_LABEL = "Total count entered by hand"
NAME_TITLE, COUNT_TITLE, DATES_TITLE = "Survey Name", "Total Count", "Event Date(s) Processed"
COUNT_WIDTH, DATES_WIDTH, NAME_MARGIN = 15, 40, 2
NOTHING_PROCESSED = "No surveys were processed in this run."


def daily_counts(
    df: DataFrame, job_run_id: str | None = None, env: str | None = None,
    processed_ts: str | None = None,
) -> DataFrame:
    """One row per survey and date, with the run's values when they are given."""
    counts = df.groupBy(F.lower("survey_name").alias("survey_name"), "event_date").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    if job_run_id is None:
        return counts
    return counts.select(
        "survey_name",
        "event_date",
        "row_count",
        F.lit(job_run_id).alias("job_run_id"),
        F.lit(env).alias("env"),
        F.lit(processed_ts).alias("processed_ts"),
    )


def survey_summary(daily: DataFrame) -> DataFrame:
    """(section, survey_name, total_count, event_dates): one row per survey and a total.

    The list of a survey holds its different days, so it is bounded by the
    calendar.
    """
    per_survey = daily.groupBy(F.lower("survey_name").alias("survey_name")).agg(
        F.sum("row_count").alias("total_count"),
        F.array_join(F.array_sort(F.collect_set("event_date")), ", ").alias("event_dates"),
    )
    return (
        per_survey.rollup("survey_name")
        .agg(
            F.grouping_id().cast("int").alias("section"),
            F.sum("total_count").alias("total_count"),
            F.max("event_dates").alias("dates"),
        )
        .select(
            "section",
            F.when(F.col("section") == 1, F.lit(TOTAL_LABEL))
            .otherwise(F.col("survey_name"))
            .alias("survey_name"),
            "total_count",
            F.when(F.col("section") == 1, F.lit("")).otherwise(F.col("dates")).alias("event_dates"),
        )
    )


def _line(name: Column, count: Column, dates: Column, width: Column) -> Column:
    def cell(value: Column, size: Column) -> Column:
        # Longer values are kept whole, as a text format does.
        return F.rpad(value, F.greatest(size, F.length(value)), F.lit(" "))

    return F.concat(
        cell(name, width), cell(count, F.lit(COUNT_WIDTH)), cell(dates, F.lit(DATES_WIDTH))
    )


def survey_summary_lines(summary: DataFrame, manual_label: str = MANUAL_LABEL) -> DataFrame:
    """(section, survey_name, line) of the fixed-width text report, one row per line.

    Sort by section and survey_name to print it. The name column is as wide as
    the longest name. ``manual_label`` begins a line that is filled in by hand.
    The summary has one row per survey: it becomes one row, so that it is
    computed once, and is unfolded into lines.
    """
    fixed = max(len(NAME_TITLE), len(manual_label), len(TOTAL_LABEL))
    whole = summary.agg(
        (F.greatest(F.lit(fixed), F.max(F.length("survey_name"))) + F.lit(NAME_MARGIN)).alias("width"),
        F.collect_list(F.struct("section", "survey_name", "total_count", "event_dates")).alias("rows"),
    )
    blank, w = F.lit(""), F.col("width")
    rule = F.repeat(F.lit("-"), w + COUNT_WIDTH + DATES_WIDTH)

    def entry(section: int, line: Column, name: Column | None = None) -> Column:
        named = F.lit(None).cast("string") if name is None else name
        return F.struct(
            F.lit(section).alias("section"), named.alias("survey_name"), line.alias("line")
        )

    def shown(row: Column) -> Column:
        return _line(row["survey_name"], row["total_count"].cast("string"), row["event_dates"], w)

    surveys = F.transform(
        F.filter("rows", lambda r: r["section"] == 0), lambda r: entry(2, shown(r), r["survey_name"])
    )
    total = F.get(F.filter("rows", lambda r: r["section"] == 1), F.lit(0))
    around = F.array(
        entry(0, _line(F.lit(NAME_TITLE), F.lit(COUNT_TITLE), F.lit(DATES_TITLE), w)),
        entry(1, rule),
        entry(3, rule),
        entry(4, shown(total)),
        entry(5, rule),
        entry(6, _line(F.lit(manual_label), blank, blank, w)),
        entry(7, rule),
    )
    nothing = F.array(entry(0, F.lit(NOTHING_PROCESSED)))
    lines = F.when(F.size("rows") > 0, F.concat(around, surveys)).otherwise(nothing)
    return whole.select(F.inline(lines))
