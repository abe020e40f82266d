"""What the text operators share: durable intermediate results, word rules, table access."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every word and line rule here (fixed values).
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
# Rows that a Python worker gets at a time.
BATCH_ROWS = 1000


def durable_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share.

    It is the one that spark.checkpoint.dir names. Only a local session that
    names none (tests) gets a temporary one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if base is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="lakeledger-checkpoint-")
        context.setCheckpointDir(base)
    return context.getCheckpointDir().rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, lineage cut."""
    durable_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: durable, and in less room than a checkpoint."""
    path = f"{durable_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver has found it, and take texts in small batches.

    The path serves sessions on one machine and clusters that share the
    folder; elsewhere the package is installed, or submitted with --py-files.
    Texts are long: Spark's 10,000 rows a batch are tens of megabytes, several
    times over in a worker. A smaller number of the session is kept.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in no fold."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def words_of(text: str) -> Column:
    """The words of a text in order; none for null or blank texts."""
    bare = F.btrim(F.col(text), F.lit(SPACES))
    return F.when(F.length(bare) > 0, F.split(bare, SPACE_RUN, -1)).otherwise(
        F.array().cast("array<string>")
    )


def barrier(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that is computed once per row.

    A plain projection may be folded into the lambdas that use the column and
    so be computed once per element; the optimizer does not move it through
    this one-row generator.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
