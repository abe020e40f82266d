"""Reader for a CSV file whose quoted cells may hold line ends, by all tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_csv_records(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Text columns of one CSV file with a header, as ``write_single_csv`` makes it.

    Spark reads a file in one task if cells may hold line ends. Here its lines
    are read in splits. A line is a record's first if an even number of quotes
    stands before it; each split counts its records for both cases, and one
    row per split tells which it is and how many records came before.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    in_split = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        lines.withColumn("odd", F.pmod(quotes, F.lit(2)))
        .withColumn("even_before", (F.sum("odd").over(in_split) - F.col("odd")) % 2 == 0)
        .withColumn("if_closed", F.count_if("even_before").over(in_split))
        .withColumn("if_open", F.count_if(~F.col("even_before")).over(in_split))
    )
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        counted.groupBy("block")
        .agg(F.sum("odd").alias("odds"), F.max("if_closed").alias("closed"), F.max("if_open").alias("open"))
        .withColumn("is_open", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2 == 1)
        .withColumn("before", F.coalesce(F.sum(F.when(F.col("is_open"), F.col("open")).otherwise(F.col("closed"))).over(earlier), F.lit(0)))
        .select("block", "is_open", "before")
    )
    own = F.when(F.col("is_open"), F.col("if_open")).otherwise(F.col("if_closed"))
    # What a split holds of a record that began earlier has the number of that record.
    texts = (
        counted.join(F.broadcast(splits), "block")
        .groupBy((F.col("before") + own).alias("number"))
        .agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("lines"))
        .select("number", F.array_join("lines.value", "\n").alias("text"))
    )
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in columns)
    row = F.from_csv("text", schema, {"escape": '"', "multiLine": "true"})
    # The first record is the header; blank lines are no records.
    return texts.filter("number > 1 AND text != ''").select(row.alias("row")).select("row.*")
