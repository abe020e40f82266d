"""Append-only tables whose rows are identified by key and version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.operators.joins import anti_join


def of_version(final: DataFrame, run_version, version: str = "updated_on") -> DataFrame:
    """Stored rows of one run: Parquet statistics skip what other runs have written."""
    return final.filter(F.col(version) == F.lit(run_version).cast("timestamp_ntz"))


# Bits of a key filter. Broadcast as bitmaps of 4 KB: 8 MB at most, whatever the batch.
FILTER_BITS = 1 << 26


def _bit(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(bits)) + 1


def key_filter(batch: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """(bucket, bitmap): a bit for the hash of every key of ``batch``; bits / 32,768 rows at most."""
    marked = batch.dropna(subset=list(keys)).select(_bit(keys, bits).alias("_bit"))
    return marked.groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bitmap")
    )


def maybe_in(rows: DataFrame, batch: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose key may be in ``batch``: all whose key is, and few others. ``rows`` are not shuffled.

    The share of others is that of the bits in use, a seventh for ten million
    keys; a batch that fills the filter lets everything pass. A null key is in
    no batch.
    """
    at = F.bitmap_bit_position(F.col("_bit"))
    octet = F.col("_bitmap").substr(F.floor(at / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(octet), 16, 10).cast("bigint")
    return (
        rows.dropna(subset=list(keys))
        .withColumn("_bit", _bit(keys, bits))
        .withColumn("_bucket", F.bitmap_bucket_number("_bit"))
        .join(F.broadcast(key_filter(batch, keys, bits)), "_bucket")
        .filter(F.getbit(value, (at % 8).cast("int")) == 1)
        .select(rows.columns)
    )


def of_batch(
    final: DataFrame,
    batch: DataFrame,
    primary_key: Sequence[str],
    version: str = "updated_on",
    bits: int = FILTER_BITS,
) -> DataFrame:
    """Stored rows that rows of ``batch`` could equal in key and version, for runs of unknown version.

    The span of the batch's versions is pushed into the scan, whose statistics
    skip older and newer files; a filter of the batch's keys then leaves about
    the rows that match, so the final table is never shuffled as a whole. The
    keys of the batch are read twice more for it.
    """
    span = batch.agg(F.min(version).alias("first"), F.max(version).alias("last")).first()
    if span["first"] is None:
        return final.limit(0)
    inside = final.filter(F.col(version).between(F.lit(span["first"]), F.lit(span["last"])))
    return maybe_in(inside, batch, [*primary_key, version], bits)


def dedup_batch(
    work: DataFrame, primary_key: Sequence[str], version: str = "updated_on"
) -> DataFrame:
    """The smallest row per key and version; rows with a null key stay as they are."""
    keys = [*primary_key, version]
    rest = [c for c in work.columns if c not in keys]
    has_null = F.greatest(*[F.col(k).isNull() for k in keys])
    # A row with a null key is a group of its own, so that one pass serves both kinds.
    marked = work.withColumn("_alone", F.when(has_null, F.monotonically_increasing_id()))
    if not rest:
        return marked.distinct().select(work.columns)
    smallest = marked.groupBy(*keys, "_alone").agg(F.min(F.struct(*rest)).alias("_row"))
    return smallest.select(*keys, "_row.*").select(work.columns)


def unseen_rows(
    work: DataFrame,
    final: DataFrame,
    primary_key: Sequence[str],
    version: str = "updated_on",
    dedup_within_batch: bool = False,
) -> DataFrame:
    """Rows of ``work`` whose key and version are not yet in ``final``.

    Equal rows inside one batch are all kept unless ``dedup_within_batch``.
    """
    fresh = anti_join(work, final, [*primary_key, version])
    return dedup_batch(fresh, primary_key, version) if dedup_within_batch else fresh


def latest_version(
    df: DataFrame, primary_key: Sequence[str], version: str = "updated_on"
) -> DataFrame:
    """The newest row per key: an aggregate, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in (*primary_key, version)]
    return (
        df.groupBy(*primary_key)
        .agg(F.max(F.struct(version, *rest)).alias("_row"))
        .select(*primary_key, "_row.*")
        .select(df.columns)
    )
