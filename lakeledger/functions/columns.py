"""Column helpers that are more than one built-in call. All run JVM-side."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three text date formats of the report source and the
# courtesy suffix that is cut from labels.
DATE_TIME_12H = "M/d/yyyy h:mm:ss a"
DATE_US = "M/d/yyyy"
DATE_ISO = "yyyy-M-d"
THANK_YOU_SUFFIX = r"(?i)-?\s*thank\s*you\s*$"


def try_number(c: Column) -> Column:
    """Text to NUMBER(38,0): invalid text becomes null, fractions round half up."""
    return c.try_cast("decimal(38,0)")


def try_timestamp_ntz(c: Column) -> Column:
    """Text to wall-clock time: invalid text becomes null, a zone suffix is dropped."""
    return c.try_cast("timestamp_ntz")


def parse_timestamp_ntz(c: Column, pattern: str, on_error: str = "raise") -> Column:
    """Text in ``pattern`` to wall-clock time, in any session zone.

    Text that does not fit fails the query, whether ANSI mode is on or not, or
    becomes null with ``on_error='null'``.
    """
    if on_error == "raise":
        message = F.concat(F.lit(f"cannot read as {pattern}: "), c)
        unreadable = F.when(c.isNotNull(), F.raise_error(message)).cast("timestamp_ntz")
        return F.coalesce(F.to_timestamp_ntz(c, F.lit(pattern)), unreadable)
    if on_error != "null":
        raise ValueError("on_error is 'raise' or 'null'")
    # The only lenient parser gives instants: the text is read as UTC and the
    # instant counted up from the epoch, so that the session zone (and its
    # daylight-saving gaps) never touches the value.
    instant = F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(f"{pattern} Z"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)


def flag_to_text(c: Column) -> Column:
    """false -> 'No', true -> 'true', null -> null."""
    return F.when(~c, F.lit("No")).otherwise(c.cast("string"))


def record_key(record_id: Column, position: Column) -> Column:
    """Reproducible key of an array element: md5 of ``<record id>-<0-based index>``."""
    return F.md5(F.concat(record_id, F.lit("-"), position.cast("string")))


def normalise_name(c: Column, all_whitespace: bool = False) -> Column:
    """Lower case without outer blanks (or without any outer white space)."""
    trimmed = F.regexp_replace(c, r"^\s+|\s+$", "") if all_whitespace else F.trim(c)
    return F.lower(trimmed)


def clean_label(c: Column) -> Column:
    return F.regexp_replace(c, THANK_YOU_SUFFIX, "")


def utc(moment: datetime) -> datetime:
    """Wall-clock time in UTC: zoned times are converted, times without a zone are taken as UTC."""
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


def iso_text(moment: datetime) -> str:
    return moment.isoformat()


def run_stamp(moment: datetime) -> str:
    """Compact UTC name part, e.g. 20260731T120000Z."""
    return utc(moment).strftime("%Y%m%dT%H%M%SZ")


def run_time(load_ts: datetime) -> Column:
    """One load time per run, in UTC and to the second."""
    return F.lit(utc(load_ts).replace(microsecond=0).isoformat(" ")).cast("timestamp_ntz")
