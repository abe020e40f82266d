"""Whole-frame projections driven by the schema."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions.columns import clean_label


def trim_text_columns(df: DataFrame) -> DataFrame:
    """Right-trim every text column."""
    return df.select(
        *[
            F.rtrim(f"`{f.name}`").alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def clean_label_column(df: DataFrame, column: str = "intent") -> DataFrame:
    """Cut the courtesy suffix; a frame without the column is returned as it is."""
    if column not in df.columns:
        return df
    return df.withColumn(column, clean_label(F.col(column)))


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def flatten_columns(df: DataFrame, sep: str = "_", on_collision: str = "raise") -> DataFrame:
    """Nested structs to one level of columns (``a.b`` -> ``a_b``), arrays to JSON text.

    Empty structs give no column. When two leaves get the same name, ``raise``
    stops and ``last`` keeps the later one.
    """

    def leaves(struct: T.StructType, parent: Column | None, prefix: str):
        for f in struct.fields:
            name = f"{prefix}{sep}{f.name}" if prefix else f.name
            value = F.col(f"`{f.name}`") if parent is None else parent.getField(f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, value, name)
            elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
                yield name, F.to_json(value)
            else:
                yield name, value

    found = list(leaves(df.schema, None, ""))
    twice = sorted(n for n, count in Counter(n for n, _ in found).items() if count > 1)
    if twice and on_collision == "raise":
        raise ValueError(f"flattened names collide: {twice}")
    return df.select(*[value.alias(name) for name, value in dict(found).items()])


def unnest(df: DataFrame, column: str, keep: Sequence[str], value: str) -> DataFrame:
    """(*keep, pos, value): one row per array element; null and empty arrays give none.

    Written as an outer explode whose blank rows are dropped. For an inner
    explode the optimizer adds a filter on the array's size below the explode,
    and the expression that makes the array would be computed twice per row.
    """
    return df.select(*keep, F.posexplode_outer(column).alias("pos", value)).filter(
        F.col("pos").isNotNull()
    )
