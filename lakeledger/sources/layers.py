"""Readers for the date-partitioned layers.

An absent folder is an empty layer, not an error; a file that is there but
cannot be read is an error.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.contracts import LAYER, LEDGER, QUARANTINE, SURVEY_CONFIG, Contract

# Field names of the raw survey records.
RAW_FIELDS = {
    "Survey Name": "raw_survey_name",
    "Contact Record ID": "contact_record_id",
    "Invitation Date": "invitation_date",
}
PARTITION = "event_date"
# Column of the ledger's files that orders the entries of one key.
COMMITTED = "committed_at"


def survey_config(spark: SparkSession, configs: list[dict]) -> DataFrame:
    rows = [tuple(c.get(name) for name in SURVEY_CONFIG.names) for c in configs]
    return spark.createDataFrame(rows, SURVEY_CONFIG.schema)


# There is no folder, or nothing in it that the reader takes.
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _load_or_empty(spark: SparkSession, load, schema) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return spark.createDataFrame([], schema)
        raise


def _as_text(df: DataFrame, contract: Contract, dates: Iterable[str] | None) -> DataFrame:
    """Contract columns as text, of the folders of these dates only.

    A missing column is an error here, before any job runs.
    """
    if dates is not None:
        df = df.filter(F.col(PARTITION).cast("string").isin(list(dates)))
    return df.select(*[F.col(name).cast("string").alias(name) for name in contract.names])


def read_layer(
    spark: SparkSession, folder: str, dates: Iterable[str] | None = None,
    contract: Contract = LAYER,
) -> DataFrame:
    """Contract columns of a Parquet layer; other files in the folder are ignored."""
    paths = wanted_folders(spark, folder, dates)
    if not paths:
        return spark.createDataFrame([], contract.schema)
    df = _load_or_empty(
        spark,
        lambda: spark.read.option("basePath", folder)
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths),
        contract.schema,
    )
    return _as_text(df, contract, dates)


def read_quarantine(
    spark: SparkSession, folder: str, dates: Iterable[str] | None = None, fmt: str = "csv"
) -> DataFrame:
    """(contact_record_id, removal_reason, event_date), from CSV with header or Parquet."""
    if fmt == "parquet":
        return read_layer(spark, folder, dates, QUARANTINE)
    if fmt != "csv":
        raise ValueError("fmt is 'csv' or 'parquet'")
    paths = wanted_folders(spark, folder, dates)
    if not paths:
        return spark.createDataFrame([], QUARANTINE.schema)
    df = _load_or_empty(
        spark,
        lambda: spark.read.option("basePath", folder).option("header", "true").csv(paths),
        QUARANTINE.schema,
    )
    return _as_text(df, QUARANTINE, dates)


# What stands for the id in files that have no such column.
_ABSENT = "no such column 8d1c4f0a6e"
NO_COLUMN = "no column contact_record_id in "


def folder_key(spark: SparkSession, folder: str) -> str:
    """A folder as the paths of its files begin, without scheme and host."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(path).toUri().getRawPath()


def _by_survey(
    spark: SparkSession, files: DataFrame, folders: dict[str, str], columns: Iterable[str]
) -> DataFrame:
    """(survey_name, event_date, *columns) of rows with their ``file``; a folder may serve several surveys.

    The survey comes from the folder above the date, by a join with the
    configuration, which is an argument of the job and broadcast.
    """
    keys = [(folder_key(spark, folder), survey) for survey, folder in folders.items()]
    surveys = spark.createDataFrame(keys, "_folder string, survey_name string")
    # Plain searches: a pattern over the path of every row costs more than the rest of a scan.
    start = (
        "CASE WHEN locate('://', _above) > 0 THEN locate('/', _above, locate('://', _above) + 3)"
        " WHEN locate(':/', _above) > 0 THEN locate(':/', _above) + 1 ELSE 1 END"
    )
    mark = f"/{PARTITION}="
    placed = files.withColumn("_above", F.substring_index("file", mark, 1)).withColumns(
        {
            "_folder": F.expr(f"substring(_above, {start})"),
            PARTITION: F.substring_index(F.expr(f"substring(file, char_length(_above) + {len(mark) + 1})"), "/", 1),
        }
    )
    return placed.join(F.broadcast(surveys), "_folder").select("survey_name", PARTITION, *columns)


def _all_wanted(spark: SparkSession, folders: dict[str, str], dates: dict[str, list[str]]) -> list[str]:
    return sorted({path for survey, folder in folders.items() for path in wanted_folders(spark, folder, dates[survey])})


def read_layers(
    spark: SparkSession, folders: dict[str, str], dates: dict[str, list[str]]
) -> DataFrame:
    """(survey_name, event_date, contact_record_id) of the Parquet layers of all surveys, their own dates each.

    One scan with a given schema, whatever the number of surveys: no file is
    looked at before. A file without the id column, or with one that is no
    text, fails the scan with an error that names the file.
    """
    named = ("contact_record_id",)
    empty = spark.createDataFrame([], f"survey_name string, {PARTITION} string, contact_record_id string")
    paths = _all_wanted(spark, folders, dates)
    if not paths:
        return empty
    # Spark fills the column with this default where a file does not have it.
    default = {key: f"'{_ABSENT}'" for key in ("EXISTS_DEFAULT", "CURRENT_DEFAULT")}
    schema = T.StructType([T.StructField("contact_record_id", T.StringType(), True, default)])
    rows = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
        .select(*named, F.col("_metadata.file_path").alias("file"))
    )
    no_column = F.raise_error(F.concat(F.lit(NO_COLUMN), F.col("file")))
    # A filter, so that counts look at the column as well.
    checked = rows.filter(
        F.when(F.col("contact_record_id") == _ABSENT, no_column.cast("boolean")).otherwise(True)
    )
    plain = checked.select(F.col("contact_record_id").cast("string").alias("contact_record_id"), "file")
    return _by_survey(spark, plain, folders, named)


def read_quarantines(
    spark: SparkSession, folders: dict[str, str], dates: dict[str, list[str]], fmt: str = "csv"
) -> DataFrame:
    """(survey_name, event_date, contact_record_id, removal_reason) of the quarantines of all surveys.

    CSV files are grouped by their header, which one job reads from all of
    them, and each group is read with the columns in its order.
    """
    columns = ("contact_record_id", "removal_reason")
    schema = ", ".join(f"{c} string" for c in ("survey_name", PARTITION, *columns))
    paths = _all_wanted(spark, folders, dates)
    if not paths:
        return spark.createDataFrame([], schema)
    found: list[DataFrame] = []
    if fmt == "parquet":
        found.append(
            spark.read.schema(", ".join(f"{c} string" for c in columns))
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .parquet(*paths)
            .select(*columns, F.col("_metadata.file_path").alias("file"))
        )
    elif fmt == "csv":
        for header, files in _headers(spark, paths).items():
            names = next(csv.reader([header]), [])
            lacking = [c for c in columns if c not in names]
            if lacking:
                raise ValueError(f"no column {lacking[0]} in {files[0]}")
            # Names that repeat or are blank are of no interest, only their places.
            places = [n if n in columns and n not in names[:at] else f"_{at}" for at, n in enumerate(names)]
            found.append(
                spark.read.schema(", ".join(f"`{n}` string" for n in places))
                .option("header", "true")
                .csv([unquote(f) for f in files])
                .select(*columns, F.col("_metadata.file_path").alias("file"))
            )
    else:
        raise ValueError("fmt is 'csv' or 'parquet'")
    if not found:
        return spark.createDataFrame([], schema)
    rows = reduce(lambda a, b: a.unionByName(b), found)
    return _by_survey(spark, rows, folders, columns)


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """First line of each file that is not blank -> files; one job, a row per file of the wanted dates."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    block = F.col("_metadata.file_block_start").alias("block")
    numbered = lines.select(F.col("_metadata.file_path").alias("file"), block, F.monotonically_increasing_id().alias("at"), "value")
    filled = numbered.filter(F.length(F.trim("value")) > 0)
    firsts = filled.groupBy("file").agg(F.min(F.struct("block", "at", "value")).alias("first"))
    found: dict[str, list[str]] = {}
    for row in firsts.select("file", "first.value").collect():
        found.setdefault(row["value"].removeprefix("\ufeff"), []).append(row["file"])
    return found


def read_raw_surveys(
    spark: SparkSession, folder: str, dates: Iterable[str] | None = None, files: list[str] | None = None
) -> DataFrame:
    """(raw_survey_name, contact_record_id, invitation_date, event_date, is_broken).

    One read over all files of all dates (or the given files below the folder)
    with a given schema. ``is_broken`` marks one row per file (or record) that
    is not readable as JSON.
    """
    fields = ", ".join(f"`{name}` string" for name in RAW_FIELDS)
    schema = f"{fields}, _broken string, {PARTITION} string"
    paths = files if files is not None else wanted_folders(spark, folder, dates)
    df = spark.createDataFrame([], schema) if not paths else _load_or_empty(
        spark,
        lambda: spark.read.schema(schema)
        .option("basePath", folder)
        .option("multiLine", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_broken")
        .option("pathGlobFilter", "*.json")
        .json(paths),
        schema,
    )
    if dates is not None:
        df = df.filter(F.col(PARTITION).isin(list(dates)))
    return df.select(
        *[F.col(f"`{name}`").alias(short) for name, short in RAW_FIELDS.items()],
        PARTITION,
        F.col("_broken").isNotNull().alias("is_broken"),
    )


def ledger_entries(spark: SparkSession, path: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Every entry of the ledger with the time of its commit; of the folders of the given dates only."""
    schema = T.StructType([*LEDGER.schema.fields, T.StructField(COMMITTED, T.StringType())])
    paths = wanted_folders(spark, path, dates)
    if not paths:
        return spark.createDataFrame([], schema)
    return _load_or_empty(
        spark, lambda: spark.read.schema(schema).option("basePath", path).parquet(*paths), schema
    )


def newest_entries(entries: DataFrame) -> DataFrame:
    """The entry of last commit per date and survey, ``COMMITTED`` included."""
    keys = ("event_date", "survey_type")
    rest = [c for c in LEDGER.names if c not in keys]
    newest = entries.groupBy(*keys).agg(F.max(F.struct(COMMITTED, *rest)).alias("_entry"))
    return newest.select(*keys, "_entry.*").select(*LEDGER.names, COMMITTED)


def read_ledger(spark: SparkSession, path: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Finished work, one row per date and survey; empty before the first run.

    With ``dates`` only their folders are listed and read.
    """
    return newest_entries(ledger_entries(spark, path, dates)).drop(COMMITTED)


def child_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders one level below, whatever lies in them; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory())


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Files of one folder that a reader takes; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isFile()]
    return [f"{folder}/{name}" for name in sorted(names) if name[0] not in "._"]


def date_folders(spark: SparkSession, folder: str) -> list[str]:
    """Dates of a layer, sorted, from one listing of its folder: no file is looked at."""
    start = f"{PARTITION}="
    return [n.removeprefix(start) for n in child_folders(spark, folder) if n.startswith(start)]


def list_event_dates(spark: SparkSession, folder: str) -> DataFrame:
    """``date_folders`` as rows; other folders do not count."""
    dates = [(d,) for d in date_folders(spark, folder)]
    return spark.createDataFrame(dates, f"{PARTITION} string").coalesce(1).orderBy(PARTITION)


def wanted_folders(spark: SparkSession, folder: str, dates: Iterable[str] | None) -> list[str]:
    """Paths to read: the folder itself, or its folders of the given dates that are there."""
    if dates is None:
        return [folder]
    here = set(date_folders(spark, folder))
    return [f"{folder}/{PARTITION}={d}" for d in sorted(set(dates)) if d in here]


def latest_event_dates(files: DataFrame, key: str = "survey_name") -> DataFrame:
    """Latest date per survey (lexical order, which is date order for ISO dates)."""
    return files.groupBy(key).agg(F.max(PARTITION).alias(PARTITION)).dropna(subset=[PARTITION])


def partition_has_data(df: DataFrame) -> bool:
    return not df.limit(1).isEmpty()
