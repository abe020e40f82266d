"""Registry of test queries: a Spark function and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_text(column: str):
    return F.col(column).cast("date").cast("string")


def write_array_files(texts: DataFrame, path: str, key: str, rows_per_file: int) -> None:
    """JSON files that each hold one array: a hash group of the JSON texts in ``value``.

    The groups are as many as the rows need, and ``key`` differs from row to
    row, so that a group holds about ``rows_per_file`` rows.
    """
    groups = texts.count() // rows_per_file + 1
    arrays = (
        texts.withColumn("part", F.pmod(F.xxhash64(key), F.lit(groups)))
        .groupBy("part")
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    )
    # The CSV writer is the text writer that lets the file extension be chosen.
    arrays.write.partitionBy("part").options(
        header="false", sep="\u0001", quote="\u0002", extension="json"
    ).csv(path)
