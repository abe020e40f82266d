"""Job: many JSON files with differing nested keys to one flat CSV data set."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.operators.flatten_json import Leaf, column_names, csv_lines, find_leaves, flatten_records, sparse_records
from lakeledger.sinks.tables import write_csv, write_single_csv
from lakeledger.sources.json import count_files, read_json_records


@dataclass(frozen=True)
class FlattenResult:
    status: str  # OK, NO_FILES or NO_RECORDS
    files: int
    rows: int = 0
    skipped: int = 0
    columns: tuple[str, ...] = ()
    path: str | None = None


@dataclass(frozen=True)
class RecordShape:
    leaves: list[Leaf]
    rows: int
    skipped: int


def record_shape(records: DataFrame, order: str = "first_seen") -> RecordShape:
    """Columns and counts of an input: one pass for the counts, one per level of nesting."""
    tally = records.agg(
        F.count_if(~F.col("is_broken")).alias("rows"), F.count_if("is_broken").alias("skipped")
    ).first()
    leaves = find_leaves(records, order) if tally["rows"] else []
    return RecordShape(leaves, tally["rows"], tally["skipped"])


def flatten_json(
    records: DataFrame, sep: str = "_", order: str = "first_seen", on_collision: str = "raise", sparse: bool = False
) -> DataFrame:
    """Flat text table of the usable records (see ``read_json_records``).

    ``sparse`` keeps the filled columns of a row in a map instead (``sparse_records``).
    """
    shape = record_shape(records, order)
    usable = records.filter(~F.col("is_broken"))
    if sparse:
        return sparse_records(usable, shape.leaves, sep, on_collision)
    return flatten_records(usable, shape.leaves, sep, on_collision)


def flatten_json_to_csv(
    spark: SparkSession,
    source: str,
    destination: str,
    run_ts: datetime,
    lines: bool = False,
    sep: str = "_",
    order: str = "first_seen",
    on_collision: str = "raise",
    single_file: bool = False,
) -> FlattenResult:
    """The shape of the input first, then one pass for the write.

    The result is a folder of part files, or with ``single_file`` one file with
    one header and the records in the order of the input.
    """
    files = count_files(spark, source, lines)
    if files == 0:
        return FlattenResult("NO_FILES", 0)
    records = read_json_records(spark, source, lines)
    shape = record_shape(records, order)
    if shape.rows == 0:
        return FlattenResult("NO_RECORDS", files, skipped=shape.skipped)
    usable = records.filter(~F.col("is_broken"))
    if single_file:
        columns, _ = column_names(shape.leaves, sep, on_collision)
        header, lines = csv_lines(usable, shape.leaves, sep, on_collision)
        path = write_single_csv(header, lines, destination, run_ts)
    else:
        flat = flatten_records(usable, shape.leaves, sep, on_collision)
        columns, path = flat.columns, write_csv(flat, destination, run_ts)
    return FlattenResult("OK", files, shape.rows, shape.skipped, tuple(columns), path)
