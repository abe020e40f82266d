"""Table writers. Targets are Parquet paths, or catalog tables with ``table=True``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions import run_stamp


def overwrite_table(df: DataFrame, target: str, table: bool = False) -> None:
    """Full refresh in one job."""
    writer = df.write.mode("overwrite").format("parquet")
    writer.saveAsTable(target) if table else writer.save(target)


def append_table(df: DataFrame, target: str, table: bool = False) -> None:
    writer = df.write.mode("append").format("parquet")
    writer.saveAsTable(target) if table else writer.save(target)


def write_partitions(
    df: DataFrame, path: str, keys: Sequence[str] = ("survey_name", "event_date"),
    fmt: str = "parquet", row_per_key: bool = False, **options: str,
) -> None:
    """Replace exactly the partitions that ``df`` holds; others stay.

    Rows are first brought together by partition, so that each partition gets
    few files. ``rebalance`` lets adaptive execution split a hot partition over
    several tasks. It goes by bytes, though, and would give all partitions of
    a report with one row each to one task: ``row_per_key`` spreads those over
    tasks by key.
    """
    columns = [F.col(k) for k in keys]
    if row_per_key:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        gathered = df.repartition(tasks, *columns)
    else:
        gathered = df.hint("rebalance", *columns)
    (
        gathered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*keys)
        .format(fmt)
        .save(path)
    )


def write_staged(df: DataFrame, path: str, keys: Sequence[str] = ("survey_name", "event_date")) -> int:
    """Write staged survey rows by partition and return their number.

    The number is observed during the write, the plan is not run twice.
    """
    seen = Observation()
    write_partitions(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, keys)
    return seen.get["rows"]


def write_csv(df: DataFrame, destination: str, run_ts) -> str:
    """A CSV data set with header in a new folder named after the run.

    Null, missing and empty values are empty cells; blanks around a value are
    kept. An existing folder is never overwritten.
    """
    path = f"{destination.rstrip('/')}/combined_{run_stamp(run_ts)}"
    df.write.mode("errorifexists").options(
        header="true",
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)
    return path


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move one file to a place where nothing is yet; its folder is made if it has to be."""
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(target)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    if files.exists(path) or not files.rename(hadoop.fs.Path(source), path):
        raise FileExistsError(f"could not move {source} to {target}")


def delete_files(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete files or folders; what is gone already is no error."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Bytes that are copied at a time where files have to be joined by copying.
_COPY = 4 << 20


def join_files(spark: SparkSession, folder: str, target: str, head: bytes = b"") -> None:
    """One file of ``head`` and the part files of ``folder`` in their order; the folder goes.

    The parts were written in parallel. A file system that can (HDFS) joins
    them in place, without moving a byte; on others the driver streams them
    through a buffer of fixed size, so only its bandwidth is needed, not its
    memory. The target appears by a rename when it is complete, and an
    existing one is never overwritten.
    """
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(target)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        raise FileExistsError(f"ALREADY_EXISTS: {target}")
    found = files.listStatus(hadoop.fs.Path(folder))
    parts = sorted(
        (s.getPath() for s in found if s.isFile() and s.getLen() and s.getPath().getName().startswith("part-")),
        key=lambda p: p.getName(),
    )
    whole = hadoop.fs.Path(folder, "_joined")

    def start():
        out = files.create(whole, True)
        out.write(bytearray(head))
        return out

    start().close()
    try:
        sources = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(parts))
        for at, part in enumerate(parts):
            sources[at] = part
        if parts:
            files.concat(whole, sources)
    except UnsupportedOperationException:
        out = start()
        try:
            for part in parts:
                data = files.open(part)
                try:
                    hadoop.io.IOUtils.copyBytes(data, out, _COPY, False)
                finally:
                    data.close()
        finally:
            out.close()
    if not files.rename(whole, path):
        raise OSError(f"could not rename {whole.toString()} to {target}")
    files.delete(hadoop.fs.Path(folder), True)


def write_single_csv(header: str, lines: DataFrame, destination: str, run_ts) -> str:
    """One CSV file named after the run, from rendered lines in the order of (file, block, position).

    Lines are sorted by range and written in parallel; ``join_files`` puts the
    header and the parts together.
    """
    path = f"{destination.rstrip('/')}/combined_{run_stamp(run_ts)}.csv"
    folder = f"{destination.rstrip('/')}/_parts_{run_stamp(run_ts)}"
    ordered = lines.orderBy("file", "block", "position").select("line")
    ordered.write.mode("overwrite").text(folder)
    join_files(lines.sparkSession, folder, path, f"{header}\n".encode())
    return path


# Partitions that one statement adds.
_ADDED = 100


def register_partitions(
    spark: SparkSession, table: str, partitions: Sequence[dict[str, str]] | None = None
) -> None:
    """Make partitions that were written to a table's folder visible to its readers.

    ``partitions`` names those of the run, each as column to value; they are
    added by name, and nothing else of the table is looked at. Without names
    the whole folder is searched.
    """
    if partitions is None:
        spark.catalog.recoverPartitions(table)
        return

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    specs = [
        f"PARTITION ({', '.join(f'`{column}` = {text(value)}' for column, value in key.items())})"
        for key in partitions
    ]
    for start in range(0, len(specs), _ADDED):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[start : start + _ADDED])}")
