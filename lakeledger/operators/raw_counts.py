"""Raw record counts per survey and date.

A raw folder of one date collects several deliveries, each with a rolling
window of about a week. A record counts for the date it carries itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.functions import normalise_name


def anchor_to_partition(raw: DataFrame, date_column: str = "invitation_date") -> DataFrame:
    """Keep records whose own date is the date of the folder they lie in."""
    own = F.trim(F.col(date_column))
    return raw.filter((own != "") & (F.substring(own, 1, 10) == F.col("event_date")))


def raw_counts(
    raw: DataFrame,
    dedup: bool = True,
    all_whitespace: bool = False,
    by: Sequence[str] = ("event_date",),
) -> DataFrame:
    """(event_date, raw_survey_name, raw_count) from anchored raw records.

    ``dedup`` counts each contact id once per date, for the lowest survey name
    it appears under; all records without an id count as one. Re-delivered
    records go by hash first; only different (id, name) rows meet the minimum,
    which sorts.
    """
    records = anchor_to_partition(raw).select(
        *by,
        "contact_record_id",
        normalise_name(F.col("raw_survey_name"), all_whitespace).alias("raw_survey_name"),
    )
    if dedup:
        # The deliveries are asked for once more above, as the optimizer drops a
        # plain distinct below a minimum and would sort all records instead.
        different = records.groupBy(*by, "contact_record_id", "raw_survey_name").agg(
            F.count(F.lit(1)).alias("_deliveries")
        )
        records = (
            different.groupBy(*by, "contact_record_id")
            .agg(
                F.min("raw_survey_name").alias("raw_survey_name"),
                F.sum("_deliveries").alias("_deliveries"),
            )
            .filter("_deliveries > 0")
        )
    return records.groupBy(*by, "raw_survey_name").agg(F.count(F.lit(1)).alias("raw_count"))


def raw_counts_with_broken(
    raw: DataFrame, dedup: bool = True, all_whitespace: bool = False
) -> DataFrame:
    """``raw_counts`` by (event_date, is_broken), so one pass also finds unreadable files.

    A broken row stands for a file that could not be read; it has no date of
    its own and is counted under the date of its folder.
    """
    own = F.when(F.col("is_broken"), F.col("event_date")).otherwise(F.col("invitation_date"))
    return raw_counts(
        raw.withColumn("invitation_date", own),
        dedup,
        all_whitespace,
        by=("event_date", "is_broken"),
    )
