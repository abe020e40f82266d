"""Job: take in raw deliveries, every file once.

A raw folder of a date collects deliveries for about a week. What a file says
is kept as an increment: how often each contact id came under each survey
name. Counts come from the increments of a date, so a run parses the files
that are new and no others.

State folder: ``ids/event_date=D`` has the increments, ``files`` a row for each
file that was taken in, with the commit it belongs to. Increments are moved
into place first; the one file that lists the files of the run is moved last,
and increments count only by that. So a run that stops half-way has taken in
nothing, and two runs at once must not take in the same dates.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions import normalise_name
from lakeledger.operators.raw_counts import anchor_to_partition
from lakeledger.sinks.tables import delete_files, move_file, overwrite_table, write_partitions
from lakeledger.sources.layers import PARTITION, data_files, date_folders, read_raw_surveys, wanted_folders

FILES_SCHEMA = f"path string, length bigint, modified timestamp, {PARTITION} string, commit string"
IDS_SCHEMA = (
    f"contact_record_id string, raw_survey_name string, deliveries bigint, commit string, {PARTITION} string"
)


def taken_files(spark: SparkSession, state: str) -> DataFrame:
    """Files that were taken in; none before the first run."""
    paths = data_files(spark, f"{state}/files")
    if not paths:
        return spark.createDataFrame([], FILES_SCHEMA)
    return spark.read.schema(FILES_SCHEMA).parquet(*paths)


def delivered_files(spark: SparkSession, folder: str, dates: Iterable[str]) -> DataFrame:
    """(path, length, modified, event_date) of the raw files of these dates; nothing of them is read."""
    paths = wanted_folders(spark, folder, dates)
    if not paths:
        return spark.createDataFrame([], FILES_SCHEMA).drop("commit")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    try:
        found = files.load(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES_SCHEMA).drop("commit")
    date = F.regexp_extract("path", f"/{PARTITION}=([^/]*)/", 1)
    return found.select("path", "length", F.col("modificationTime").alias("modified"), date.alias(PARTITION))


def take_in(
    spark: SparkSession, folder: str, state: str, dates: Iterable[str], all_whitespace: bool = False
) -> tuple[int, set[str]]:
    """(number of files taken in, dates with a file that can't be read).

    Of such a date nothing is taken in, so the next run looks at its new files
    again. A file counts as new by its path, length and time: one that is
    written again is a further delivery. The driver sees the names of the new
    files, never their rows.
    """
    keys = ["path", "length", "modified"]
    known = taken_files(spark, state).select(*keys)
    fresh = delivered_files(spark, folder, dates).join(known, keys, "left_anti").collect()
    if not fresh:
        return 0, set()
    commit = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    staged = f"{state}/_staging-{commit}"
    raw = read_raw_surveys(spark, folder, files=[r["path"] for r in fresh])
    # A broken row has no date of its own; it stands for its folder's.
    own = F.when(F.col("is_broken"), F.col(PARTITION)).otherwise(F.col("invitation_date"))
    records = anchor_to_partition(raw.withColumn("invitation_date", own)).select(
        PARTITION,
        "is_broken",
        "contact_record_id",
        normalise_name(F.col("raw_survey_name"), all_whitespace).alias("raw_survey_name"),
    )
    increments = records.groupBy(PARTITION, "is_broken", "contact_record_id", "raw_survey_name").agg(
        F.count(F.lit(1)).alias("deliveries")
    )
    overwrite_table(increments, f"{staged}/read")
    kept = spark.read.schema(increments.schema).parquet(f"{staged}/read")
    broken = {r[0] for r in kept.filter("is_broken").select(PARTITION).distinct().collect()}
    good = kept.filter(~F.col("is_broken") & ~F.col(PARTITION).isin(sorted(broken))).drop("is_broken")
    write_partitions(good.withColumn("commit", F.lit(commit)), f"{staged}/ids", (PARTITION,))
    for date in date_folders(spark, f"{staged}/ids"):
        for number, file in enumerate(data_files(spark, f"{staged}/ids/{PARTITION}={date}")):
            move_file(spark, file, f"{state}/ids/{PARTITION}={date}/{commit}-{number}.parquet")
    done = [(*(r[k] for k in (*keys, PARTITION)), commit) for r in fresh if r[PARTITION] not in broken]
    if done:
        spark.createDataFrame(done, FILES_SCHEMA).coalesce(1).write.parquet(f"{staged}/files")
        move_file(spark, data_files(spark, f"{staged}/files")[0], f"{state}/files/{commit}.parquet")
    delete_files(spark, [staged])
    return len(done), broken


def delivery_counts(spark: SparkSession, state: str, dates: Iterable[str], dedup: bool = True) -> DataFrame:
    """(event_date, raw_survey_name, raw_count) of these dates, as ``raw_counts`` gives it over all files.

    With ``dedup`` an id counts once per date, under its lowest name, and all
    records without an id as one. Other dates' folders are not looked at.
    """
    paths = wanted_folders(spark, f"{state}/ids", dates)
    if not paths:
        return spark.createDataFrame([], f"{PARTITION} string, raw_survey_name string, raw_count bigint")
    every = spark.read.schema(IDS_SCHEMA).option("basePath", f"{state}/ids").parquet(*paths)
    commits = taken_files(spark, state).select("commit").distinct()
    rows = every.join(commits, "commit", "left_semi")
    # Ids of several deliveries go by hash first; the minimum of a text sorts.
    merged = rows.groupBy(PARTITION, "contact_record_id", "raw_survey_name").agg(F.sum("deliveries").alias("deliveries"))
    if not dedup:
        return merged.groupBy(PARTITION, "raw_survey_name").agg(F.sum("deliveries").alias("raw_count"))
    lowest = (
        merged.groupBy(PARTITION, "contact_record_id")
        .agg(F.min("raw_survey_name").alias("raw_survey_name"), F.sum("deliveries").alias("deliveries"))
        .filter("deliveries > 0")
    )
    return lowest.groupBy(PARTITION, "raw_survey_name").agg(F.count(F.lit(1)).alias("raw_count"))
