import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeledger.contracts import CONVERSATION, DOCUMENT_CONTRACTS, INQUIRY_INTENT, NEVER_STORED
from lakeledger.functions import run_time, trim_text_columns
from lakeledger.operators.documents import inquiries, shred_documents
from lakeledger.operators.joins import anti_join
from lakeledger.operators.versions import latest_version, of_version, unseen_rows
from lakeledger.plans.ingest import ingest, land_raw, load_versioned

RUN = datetime(2026, 8, 12, 10, 0, 0, 123456)
DOCUMENTS = [
    {
        "message_id": "m1",
        "sequence_number": "7",
        "json_body": {
            "conversation_id": "C1",
            "generated_at": "2026-07-31T12:34:56Z",
            "model_version": "v1",
            "token_usage": {"prompt_tokens": 10, "completion_tokens": 5, "total_tokens": 15},
            "summary": {
                "inquiries": [
                    {
                        "inquiry_number": "1",
                        "inquiry_role": "primary",
                        "inquiry_parent_number": None,
                        "classification": "billing  ",
                        "status": "open",
                        "member_id": "X",
                        "member_name": "Someone",
                        "intents": [{"id": 11, "label": "a"}, {"id": "bad", "label": "b"}],
                        "key_points": ["k1", "k2"],
                        "topics_covered": ["t1"],
                    },
                    {"inquiry_number": "2", "intents": [], "key_points": None},
                ]
            },
        },
    },
    {
        "message_id": "m2",
        "sequence_number": "x",
        "json_body": {"conversation_id": "C2", "generated_at": "not a time", "summary": {}},
    },
    {"message_id": "m3", "json_body": {"summary": {"inquiries": [{"inquiry_number": "9"}]}}},
]
FIRST = "f873e470132ba0f6fe2fb3e3f8eb7ed9"
SECOND = "1c5490ec93351645b3320998ebfe6b1a"


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "docs.json").write_text(json.dumps(DOCUMENTS[:2], indent=2))
    (folder / "one.JSON").write_text(json.dumps(DOCUMENTS[2]))
    (folder / "other.txt").write_text("ignored")
    return str(folder)


def test_landing_splits_outer_arrays(spark, source, folder):
    raw = land_raw(spark, source, f"{folder}/raw", RUN)
    assert raw.count() == 3
    assert [r[0] for r in raw.select("load_ts").distinct().collect()] == [RUN.replace(microsecond=0)]
    again = land_raw(spark, source, f"{folder}/raw", RUN)
    assert again.count() == 3


def test_landing_of_lines(spark, tmp_path, folder):
    folder_in = tmp_path / "lines"
    folder_in.mkdir()
    rows = [json.dumps(DOCUMENTS[0]), "", json.dumps(DOCUMENTS[1:])]
    (folder_in / "docs.jsonl").write_text("\n".join(rows))
    assert land_raw(spark, str(folder_in), f"{folder}/raw", RUN, lines=True).count() == 3
    (folder_in / "cut.jsonl").write_text('[{"a":')
    with pytest.raises(Exception, match="not JSON"):
        land_raw(spark, str(folder_in), f"{folder}/raw", RUN, lines=True)


def test_shredding(spark, source, folder):
    raw = land_raw(spark, source, f"{folder}/raw", RUN)
    work = shred_documents(raw, run_time(RUN))
    stamp = RUN.replace(microsecond=0)
    n = Decimal
    got = sorted(tuple(r) for r in work["conversation"].collect())
    assert got == [
        ("C1", "m1", n(7), datetime(2026, 7, 31, 12, 34, 56), "v1", n(10), n(5), n(15), stamp, stamp),
        ("C2", "m2", None, None, None, None, None, None, stamp, stamp),
    ]
    inquiries = {r["inquiry_id"]: r for r in work["inquiry"].collect()}
    assert set(inquiries) == {FIRST, SECOND}
    assert inquiries[FIRST]["classification"] == "billing  "
    assert inquiries[FIRST]["inquiry_parent_number"] is None
    trimmed = {r["inquiry_id"]: r for r in trim_text_columns(work["inquiry"]).collect()}
    assert trimmed[FIRST]["classification"] == "billing"
    intents = sorted((tuple(r)[:3] for r in work["inquiry_intent"].collect()), key=str)
    assert intents == [(FIRST, None, "b"), (FIRST, n(11), "a")] or intents == [
        (FIRST, n(11), "a"), (FIRST, None, "b"),
    ]
    points = sorted(tuple(r)[:3] for r in work["inquiry_key_point"].collect())
    assert points == [(FIRST, n(1), "k1"), (FIRST, n(2), "k2")]
    assert [tuple(r)[:3] for r in work["inquiry_topic"].collect()] == [(FIRST, n(1), "t1")]
    for name, df in work.items():
        assert df.columns == DOCUMENT_CONTRACTS[name].names
        assert not set(df.columns) & set(NEVER_STORED)


def test_shredding_has_no_shuffle_and_reads_only_named_fields(spark, source, folder):
    raw = land_raw(spark, source, f"{folder}/raw", RUN)
    for df in shred_documents(raw, run_time(RUN)).values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan
        # The document is read as its named parts, not as one VARIANT.
        assert "ReadSchema: struct<record_content:struct<0:" in plan
    inquiries(raw).write.parquet(f"{folder}/staged")
    staged = spark.read.parquet(f"{folder}/staged")
    topics = shred_documents(raw, run_time(RUN), staged)["inquiry_topic"]
    plan = topics._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<inquiry_id:string,topics:array<string>>" in plan


def test_an_odd_element_does_not_cost_its_list(spark):
    text = json.dumps(
        {"json_body": {"conversation_id": "C", "summary": {"inquiries": [
            {"intents": [5, {"id": 1}], "key_points": ["a", {"b": 1}, None, 7]}, "odd"]}}}
    )
    raw = spark.createDataFrame([(text,)], "t string").select(
        F.parse_json("t").alias("record_content")
    )
    work = shred_documents(raw, run_time(RUN))
    assert work["inquiry"].count() == 2
    assert [r["intent_id"] for r in work["inquiry_intent"].collect()] == [None, Decimal(1)]
    points = [(int(r[1]), r[2]) for r in work["inquiry_key_point"].collect()]
    assert points == [(1, "a"), (2, '{"b":1}'), (3, None), (4, "7")]


def test_ingest_twice_adds_nothing(spark, source, folder):
    good = f"{folder}/final"
    args = (spark, source, f"{folder}/raw", good, RUN)
    log = ingest(*args, rejects=f"{folder}/rejects")
    assert [r["step"] for r in log.collect()][:3] == ["land raw", "stage inquiries", "load conversation"]
    counts = {n: spark.read.parquet(f"{good}/{n}").count() for n in DOCUMENT_CONTRACTS}
    assert counts == {
        "conversation": 2, "inquiry": 2, "inquiry_intent": 1, "inquiry_key_point": 2,
        "inquiry_topic": 1,
    }
    bad = spark.read.parquet(f"{folder}/rejects/inquiry_intent").collect()
    assert [r["broken_rules"] for r in bad] == [["intent_id: null"]]
    ingest(*args, rejects=f"{folder}/rejects")
    assert spark.read.parquet(f"{folder}/rejects/inquiry_intent").count() == 1
    again = {n: spark.read.parquet(f"{good}/{n}").count() for n in DOCUMENT_CONTRACTS}
    assert again == counts
    later = datetime(2026, 8, 13)
    ingest(spark, source, f"{folder}/raw", good, later, rejects=f"{folder}/rejects")
    final = spark.read.parquet(f"{good}/inquiry")
    assert final.count() == 4
    newest = latest_version(final, ["inquiry_id"]).collect()
    assert {r["updated_on"] for r in newest} == {later} and len(newest) == 2
    # Children refer to stored parents.
    parents = spark.read.parquet(f"{good}/inquiry").select("inquiry_id")
    for child in ("inquiry_intent", "inquiry_key_point", "inquiry_topic"):
        rows = spark.read.parquet(f"{good}/{child}")
        assert rows.join(parents, "inquiry_id", "left_anti").count() == 0


def test_contract_breach_fails_the_load(spark, source, folder):
    raw = land_raw(spark, source, f"{folder}/raw", RUN)
    work = shred_documents(raw, run_time(RUN))["inquiry_intent"]
    with pytest.raises(Exception, match="inquiry_intent.intent_id: null"):
        load_versioned(spark, work, f"{folder}/intents", INQUIRY_INTENT)
    long_id = shred_documents(raw, run_time(RUN))["conversation"].withColumn(
        "conversation_id", F.repeat("conversation_id", 60)
    )
    with pytest.raises(Exception, match="conversation.conversation_id: longer than 100"):
        load_versioned(spark, long_id, f"{folder}/conversations", CONVERSATION)


def versions(spark, rows):
    return spark.createDataFrame(rows, "k string, updated_on timestamp_ntz, v int")


def test_versioned_append_cases(spark):
    one, two = datetime(2026, 1, 1), datetime(2026, 1, 2)
    final = versions(spark, [("a", one, 1), ("a", one, 1), (None, one, 5)])
    work = versions(
        spark, [("a", one, 9), ("a", two, 2), ("b", one, 3), ("b", one, 4), (None, one, 6)]
    )
    got = sorted((tuple(r) for r in unseen_rows(work, final, ["k"]).collect()), key=str)
    assert got == sorted(
        [("a", two, 2), ("b", one, 3), ("b", one, 4), (None, one, 6)], key=str
    )
    got = unseen_rows(work, final, ["k"], dedup_within_batch=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        [("a", two, 2), ("b", one, 3), (None, one, 6)], key=str
    )


def test_known_run_version_is_pushed_into_the_scan_of_the_final_table(spark, folder):
    one, two = datetime(2026, 1, 1), datetime(2026, 1, 2)
    versions(spark, [("a", one, 1)]).write.parquet(f"{folder}/final")
    final = spark.read.parquet(f"{folder}/final")
    work = versions(spark, [("a", two, 2)])
    fresh = unseen_rows(work, of_version(final, "2026-01-02 00:00:00"), ["k"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(updated_on,2026-01-02T00:00)" in plan
    assert "LeftAnti" in plan and "ReadSchema: struct<k:string,updated_on:timestamp_ntz>" in plan
    assert [tuple(r) for r in fresh.collect()] == [("a", two, 2)]


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A third of the rows has one key; the join must be able to split it."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, 1, 8)
        left = rows.select(
            F.when(F.col("id") < 100_000, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
        )
        right = rows.select((F.col("id") * 2).alias("k"))
        got = anti_join(left, right, ["k"])
        assert got.count() == 100_000 + 100_000
        got = anti_join(left, right, ["k"]).select("id")
        got.write.format("noop").mode("overwrite").save()
        joined = anti_join(left, right, ["k"])
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
