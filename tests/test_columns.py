from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeledger.functions import (
    clean_label_column,
    flag_to_text,
    iso_text,
    normalise_name,
    parse_timestamp_ntz,
    record_key,
    run_stamp,
    try_number,
    try_timestamp_ntz,
)
from lakeledger.functions.columns import DATE_ISO, DATE_TIME_12H, DATE_US


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r["v"] for r in df.select("i", column(F.col("c")).alias("v")).orderBy("i").collect()]


def test_labels(spark):
    cases = {
        "Delivery-Thankyou": "Delivery",
        "RefundRequestThankYou": "RefundRequest",
        "NewAddress-ThankYou": "NewAddress",
        "MeterReading": "MeterReading",
        "Parcel Tracking": "Parcel Tracking",
        "A - Thank You ": "A ",
        "ThankYou": "",
        None: None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, intent string")
    got = [r["intent"] for r in clean_label_column(df).orderBy("i").collect()]
    assert got == list(cases.values())
    other = df.withColumnRenamed("intent", "label")
    assert clean_label_column(other) is other


def test_numbers(spark):
    got = values(spark, ["7", "1.5", "-2.5", "x", "", None, " 3 "], try_number)
    assert got == [Decimal(7), Decimal(2), Decimal(-3), None, None, None, Decimal(3)]


def test_times(spark):
    texts = ["2026-07-31T12:34:56Z", "2026-07-31 12:34:56+05:00", "not a time", None]
    want = datetime(2026, 7, 31, 12, 34, 56)
    assert values(spark, texts, try_timestamp_ntz) == [want, want, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_text_dates(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The first time does not exist in New York.
        got = values(
            spark,
            ["03/08/2026 02:30:00 AM", "08/16/2026 01:02:03 PM", "8/6/2026 12:00:00 AM", None],
            lambda c: parse_timestamp_ntz(c, DATE_TIME_12H),
        )
        assert got == [
            datetime(2026, 3, 8, 2, 30), datetime(2026, 8, 16, 13, 2, 3), datetime(2026, 8, 6), None,
        ]
        got = values(
            spark,
            ["03/08/2026 02:30:00 AM", "08/16/2026 01:02:03 pm", "soon"],
            lambda c: parse_timestamp_ntz(c, DATE_TIME_12H, "null"),
        )
        assert got == [datetime(2026, 3, 8, 2, 30), datetime(2026, 8, 16, 13, 2, 3), None]
        got = values(spark, ["08/16/2026", None], lambda c: parse_timestamp_ntz(c, DATE_US))
        assert got == [datetime(2026, 8, 16), None]
        got = values(spark, ["2026-08-16"], lambda c: parse_timestamp_ntz(c, DATE_ISO))
        assert got == [datetime(2026, 8, 16)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bad_text_dates(spark):
    bad = ["13/45/2026", "08/16/2026 01:02:03", ""]
    assert values(spark, bad, lambda c: parse_timestamp_ntz(c, DATE_US, "null")) == [None] * 3
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="13/45/2026"):
                values(spark, bad[:1], lambda c: parse_timestamp_ntz(c, DATE_US))
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_flag(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, f boolean")
    got = [r[0] for r in df.orderBy("i").select(flag_to_text(F.col("f"))).collect()]
    assert got == ["true", "No", None]


def test_names_keys_and_run_values(spark):
    assert values(spark, [" IVR Survey ", "\tx"], normalise_name) == ["ivr survey", "\tx"]
    assert values(spark, ["\tX \n"], lambda c: normalise_name(c, True)) == ["x"]
    assert values(spark, ["C1", None], lambda c: record_key(c, F.lit(0))) == [
        "f873e470132ba0f6fe2fb3e3f8eb7ed9", None,
    ]
    moment = datetime(2026, 7, 31, 12, 0, 5)
    assert (iso_text(moment), run_stamp(moment)) == ("2026-07-31T12:00:05", "20260731T120005Z")
