"""Comparison of record ids across layers: what is missing, and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP = ("survey_name", "event_date")
ID = "contact_record_id"
UNACCOUNTED = "UNACCOUNTED"
NO_REASON = "NONE"


def layer_counts(layer: DataFrame, name: str) -> DataFrame:
    """Plain row count per survey and date."""
    return layer.groupBy(*GROUP).agg(F.count(F.lit(1)).alias(name))


def missing_ids(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key rows of ``left`` that ``right`` lacks; nulls are equal.

    One tagged union and one aggregate with fixed-width state: each side is
    read once, repeated keys are reduced in memory before the shuffle, and a
    hot key is no hot partition.
    """
    tagged = left.select(*keys, F.lit(False).alias("_right")).unionByName(
        right.select(*keys, F.lit(True).alias("_right"))
    )
    return (
        tagged.groupBy(*keys)
        .agg(F.bool_or("_right").alias("_right"))
        .filter(~F.col("_right"))
        .select(*keys)
    )


def missing_records(
    curated: DataFrame, sentiment: DataFrame, quarantine: DataFrame
) -> DataFrame:
    """(survey_name, event_date, contact_record_id, accounted, removal_reason).

    One row per distinct curated id that the sentiment layer lacks. An id with
    any quarantine row is accounted for, also when its reason is null; of
    several reasons the lowest is taken; an id without one is UNACCOUNTED.
    The reasons meet the missing ids only, not the whole layers.
    """
    keys = (*GROUP, ID)
    missing = missing_ids(curated, sentiment, keys).withColumns(
        {"_missing": F.lit(True), "removal_reason": F.lit(None).cast("string")}
    )
    # Repeated reasons go by hash before the minimum, which sorts.
    known = quarantine.select(*keys, F.lit(False).alias("_missing"), "removal_reason").distinct()
    per_id = (
        missing.unionByName(known)
        .groupBy(*keys)
        .agg(
            F.bool_or("_missing").alias("_missing"),
            F.bool_or(~F.col("_missing")).alias("accounted"),
            F.min("removal_reason").alias("_reason"),
        )
    )
    reason = F.when(F.col("accounted"), F.col("_reason")).otherwise(F.lit(UNACCOUNTED))
    return per_id.filter("_missing").select(*keys, "accounted", reason.alias("removal_reason"))


def unexplained_records(missing: DataFrame) -> DataFrame:
    return missing.filter(~F.col("accounted")).select(*GROUP, ID)


def reason_counts(missing: DataFrame) -> DataFrame:
    """(survey_name, event_date, removal_reason, record_count, unaccounted_count)."""
    return missing.groupBy(*GROUP, "removal_reason").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(~F.col("accounted")).alias("unaccounted_count"),
    )


def reason_list(reasons: DataFrame) -> DataFrame:
    """Per survey and date: totals and the sorted list of (reason, count).

    ``reasons`` holds one row per reason, so the list is as long as the number
    of different reasons, not of records.
    """
    entry = F.struct("removal_reason", "record_count")
    return reasons.groupBy(*GROUP).agg(
        F.sum("record_count").alias("removed_count"),
        F.sum("unaccounted_count").alias("unaccounted_count"),
        F.array_sort(F.collect_list(entry)).alias("reasons"),
    )


def reason_text(reasons: Column) -> Column:
    """``DEDUP: 4, UNACCOUNTED: 1``, or ``NONE`` for an empty or absent list."""
    shown = F.array_join(
        F.transform(
            reasons,
            lambda r: F.concat(
                F.coalesce(r["removal_reason"], F.lit("None")),
                F.lit(": "),
                r["record_count"].cast("string"),
            ),
        ),
        ", ",
    )
    return F.coalesce(F.nullif(shown, F.lit("")), F.lit(NO_REASON))
