"""Data quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.operators.versions import maybe_in


def populated_share(df: DataFrame, group: Sequence[str], column: str) -> DataFrame:
    """Share of non-null values per group."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(column).alias("populated_count"),
        (F.count(column) / F.count(F.lit(1))).alias("populated_share"),
    )


def date_coverage(
    df: DataFrame, group: Sequence[str], date_column: str, start=None, end=None
) -> DataFrame:
    """Days of the expected span on which a group has no record.

    The span is the group's own first to last day unless given. Only distinct
    (group, day) pairs are shuffled.
    """
    days = df.select(*group, F.col(date_column).cast("date").alias("day")).distinct()
    first = F.lit(start).cast("date") if start is not None else F.min("day")
    last = F.lit(end).cast("date") if end is not None else F.max("day")
    spans = days.groupBy(*group).agg(
        F.min(first).alias("first") if start is not None else first.alias("first"),
        F.max(last).alias("last") if end is not None else last.alias("last"),
    )
    expected = spans.filter(F.col("first") <= F.col("last")).select(
        *group, F.explode(F.sequence("first", "last")).alias("day")
    )
    marked = expected.withColumn("_seen", F.lit(False)).unionByName(
        days.withColumn("_seen", F.lit(True))
    )
    return (
        marked.groupBy(*group, "day")
        .agg(F.bool_or("_seen").alias("_seen"))
        .filter(~F.col("_seen"))
        .select(*group, F.col("day").alias("missing_date"))
    )


def key_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def key_orphans(
    child: DataFrame, parent: DataFrame, child_key: Sequence[str], parent_key: Sequence[str]
) -> DataFrame:
    """Child keys without a parent row, with their number of child rows.

    One aggregate over both tables: a key that many rows share is one row
    before it is shuffled. A key with a null part refers to nothing.
    """
    children = child.dropna(subset=list(child_key)).select(
        *child_key, F.lit(1).alias("_child"), F.lit(False).alias("_parent")
    )
    parents = parent.select(
        *[F.col(p).alias(c) for p, c in zip(parent_key, child_key, strict=True)],
        F.lit(0).alias("_child"),
        F.lit(True).alias("_parent"),
    )
    return (
        children.unionByName(parents)
        .groupBy(*child_key)
        .agg(F.sum("_child").alias("row_count"), F.bool_or("_parent").alias("_parent"))
        .filter(~F.col("_parent"))
        .drop("_parent")
    )


# --- checks of what a load has appended ------------------------------------


def key_duplicates_after(
    before: DataFrame, appended: DataFrame, stored: DataFrame, key: Sequence[str]
) -> DataFrame:
    """``key_duplicates`` of ``stored`` and ``appended`` together, from the report before the load.

    ``before`` is the report on ``stored``. Only keys of the appended rows can
    have changed: a filter of them leaves about their stored rows, which alone
    are shuffled; all other lines of the report stay. Keys with null parts are
    keys like others, as in the full check; the filter knows none, so their
    stored rows are taken by the null, if a load brings any.
    """
    keys = list(key)
    fresh = appended.select(*keys)
    old = stored.select(*keys)
    has_null = _any_null(keys)
    candidates = maybe_in(old, fresh, keys).unionByName(old.filter(has_null))
    counted = (
        fresh.withColumn("_new", F.lit(1))
        .unionByName(candidates.withColumn("_new", F.lit(0)))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"), F.max("_new").alias("_new"))
        .filter((F.col("_new") == 1) & (F.col("row_count") > 1))
        .drop("_new")
    )
    # A key only gains rows, so the larger of both lines is the newer one.
    lines = before.select(*keys, "row_count").unionByName(counted)
    return lines.groupBy(*keys).agg(F.max("row_count").alias("row_count"))


def key_orphans_after(
    before: DataFrame,
    appended: DataFrame,
    parent: DataFrame,
    child_key: Sequence[str],
    parent_key: Sequence[str],
) -> DataFrame:
    """``key_orphans`` after a load, from the report before it and the appended child rows.

    ``parent`` is the parent table after the load. Stored child rows are not
    read: a key that is in neither the report nor the load has its parent
    already, and neither table loses rows. A filter of the keys in question
    leaves about their parent rows, which alone are shuffled.
    """
    keys = list(child_key)
    counted = (
        before.select(*keys, "row_count")
        .unionByName(appended.select(*keys).withColumn("row_count", F.lit(1).cast("long")))
        .dropna(subset=keys)
    )
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_key, child_key, strict=True)])
    near = maybe_in(parents, counted, keys).withColumn("row_count", F.lit(None).cast("long"))
    return (
        counted.withColumn("_parent", F.lit(False))
        .unionByName(near.withColumn("_parent", F.lit(True)))
        .groupBy(*keys)
        .agg(F.sum("row_count").alias("row_count"), F.bool_or("_parent").alias("_parent"))
        .filter(~F.col("_parent"))
        .drop("_parent")
    )


def _any_null(columns: Sequence[str]) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | F.col(c).isNull()
    return found
