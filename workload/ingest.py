"""Documents made of whole conversation turns and whole texts, shredded and loaded."""

from __future__ import annotations

import functools
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.contracts import (
    ColumnSpec,
    Contract,
    split_rejects,
    violation_counts,
    with_load_ts,
)
from lakeledger.functions import run_time, trim_text_columns
from lakeledger.operators.documents import (
    inquiries,
    shred_conversation,
    shred_inquiry,
    shred_intent,
    shred_key_point,
    shred_topic,
)
from lakeledger.operators.versions import latest_version, unseen_rows
from lakeledger.plans.ingest import ingest, land_raw, load_versioned
from lakeledger.session import scratch_path
from workload.base import query, table, write_array_files

RUN = datetime(2026, 8, 12)

DOCUMENTS = Contract(
    "documents",
    (
        ColumnSpec("doc_id", "bigint", nullable=False),
        ColumnSpec("description", length=4000),
        ColumnSpec("lang", length=2),
        ColumnSpec("quality", "int", nullable=False),
    ),
)


def _inquiry(line: Column, i: Column, role: Column) -> Column:
    return F.struct(
        (i + 1).cast("string").alias("inquiry_number"),
        role.alias("inquiry_role"),
        F.concat(role, F.lit("  ")).alias("classification"),
        line.alias("description"),
        F.when(line != "", F.lit("open")).alias("status"),
        F.lit("private").alias("member_id"),
        F.lit("private").alias("member_name"),
        F.array(
            F.struct(F.length(line).cast("string").alias("id"), role.alias("label")),
            F.struct(F.lit("n/a").alias("id"), F.lit("line").alias("label")),
        ).alias("intents"),
        F.split(line, r"\. ").alias("key_points"),
        F.split(line, " ").alias("topics_covered"),
    )


def _document_text(message: Column, number: Column, record: Column, role: Column, text: Column):
    """JSON text of one document. Its inquiries are the lines of ``text``, its key
    points their sentences, its topics their words."""
    user = role == "user"
    return F.to_json(
        F.struct(
            message.alias("message_id"),
            F.when(user, number.cast("string")).otherwise("no number").alias("sequence_number"),
            F.struct(
                F.when(role != "system", record).alias("conversation_id"),
                F.when(user, F.concat(F.lit("2026-03-01T10:"), F.lpad(number.cast("string"), 2, "0"),
                                      F.lit(":00Z")))
                .otherwise("not a time")
                .alias("generated_at"),
                role.alias("model_version"),
                F.struct(
                    F.length(text).alias("prompt_tokens"),
                    F.size(F.split(text, " ")).cast("string").alias("completion_tokens"),
                    F.concat(number.cast("string"), F.lit(".5")).alias("total_tokens"),
                ).alias("token_usage"),
                F.struct(
                    F.transform(
                        F.split(text, "\n"), lambda line, i: _inquiry(line, i, role)
                    ).alias("inquiries")
                ).alias("summary"),
            ).alias("json_body"),
        )
    )


def conversation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    record = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return turns.select(
        "role",
        _document_text(
            F.concat(F.lit("m"), record), F.col("turn"), record, F.col("role"), F.col("text")
        ).alias("value"),
    )


def conversation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_texts(spark, sf_dir).select(
        F.parse_json("value").alias("record_content"), run_time(RUN).alias("load_ts")
    )


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    record = F.col("doc_id").cast("string")
    return docs.select(
        F.parse_json(
            _document_text(record, F.col("doc_id"), record, F.col("lang"), F.col("text"))
        ).alias("record_content"),
        run_time(RUN).alias("load_ts"),
    )


def _whole(df: DataFrame, *names: str) -> DataFrame:
    """Number columns as bigint, for the comparison."""
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


# The turns as records, and their inquiries, on the SQL side.
_TURNS = """
turns AS (
  SELECT conv_id || ':' || turn AS id, turn, role, text FROM conversations
), lines AS (
  SELECT id, role, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM turns WHERE role <> 'system'
), inquiries AS (
  SELECT md5(id || '-' || pos) AS inquiry_id, * FROM lines
)"""


@query(
    "conversation_header",
    f"""
WITH {_TURNS}
SELECT id AS conversation_id, 'm' || id AS message_id,
       CASE WHEN role = 'user' THEN turn END AS sequence_number,
       CASE WHEN role = 'user'
            THEN TIMESTAMP '2026-03-01 10:00:00' + to_minutes(turn) END AS generated_at,
       role AS model_version, length(text)::BIGINT AS prompt_tokens,
       len(string_split(text, ' '))::BIGINT AS completion_tokens,
       (turn + 1)::BIGINT AS total_tokens
FROM turns WHERE role <> 'system'""",
)
def conversation_header(spark, sf_dir):
    header = shred_conversation(conversation_documents(spark, sf_dir), run_time(RUN))
    return _whole(
        header, "sequence_number", "prompt_tokens", "completion_tokens", "total_tokens"
    ).drop("updated_on", "load_ts")


@query(
    "inquiry_shred",
    f"""
WITH {_TURNS}
SELECT inquiry_id, id AS conversation_id, (pos + 1)::VARCHAR AS inquiry_number,
       role AS inquiry_role, role || '  ' AS classification, line AS description,
       CASE WHEN line <> '' THEN 'open' END AS status
FROM inquiries""",
)
def inquiry_shred(spark, sf_dir):
    rows = shred_inquiry(inquiries(conversation_documents(spark, sf_dir)), run_time(RUN))
    return rows.select(
        "inquiry_id",
        "conversation_id",
        "inquiry_number",
        "inquiry_role",
        "classification",
        "description",
        "status",
    )


@query(
    "intent_shred",
    f"""
WITH {_TURNS}
SELECT inquiry_id, length(line)::BIGINT AS intent_id, role AS intent_label FROM inquiries
UNION ALL
SELECT inquiry_id, NULL, 'line' FROM inquiries""",
)
def intent_shred(spark, sf_dir):
    rows = shred_intent(inquiries(conversation_documents(spark, sf_dir)), run_time(RUN))
    return _whole(rows, "intent_id").drop("updated_on", "load_ts")


@query(
    "key_point_shred",
    f"""
WITH {_TURNS}
SELECT inquiry_id, generate_subscripts(string_split(line, '. '), 1)::BIGINT AS key_point_seq,
       unnest(string_split(line, '. ')) AS key_point_text
FROM inquiries""",
)
def key_point_shred(spark, sf_dir):
    rows = shred_key_point(inquiries(conversation_documents(spark, sf_dir)), run_time(RUN))
    return _whole(rows, "key_point_seq").drop("updated_on", "load_ts")


@query(
    "topic_shred",
    f"""
WITH {_TURNS}
SELECT inquiry_id, generate_subscripts(string_split(line, ' '), 1)::BIGINT AS topic_seq,
       unnest(string_split(line, ' ')) AS topic_text
FROM inquiries""",
)
def topic_shred(spark, sf_dir):
    rows = shred_topic(inquiries(conversation_documents(spark, sf_dir)), run_time(RUN))
    return _whole(rows, "topic_seq").drop("updated_on", "load_ts")


@query(
    "document_inquiry_shred",
    """
WITH lines AS (
  SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents
)
SELECT md5(doc_id || '-' || pos) AS inquiry_id, doc_id::VARCHAR AS conversation_id,
       lang AS inquiry_role, line AS description
FROM lines""",
)
def document_inquiry_shred(spark, sf_dir):
    rows = shred_inquiry(inquiries(text_documents(spark, sf_dir)), run_time(RUN))
    return rows.select("inquiry_id", "conversation_id", "inquiry_role", "description")


_LANDED = """
SELECT 'm' || conv_id || ':' || turn AS message_id,
       CASE WHEN role <> 'system' THEN conv_id || ':' || turn END AS conversation_id,
       len(string_split(text, chr(10)))::BIGINT AS inquiries,
       TIMESTAMP '2026-08-12 00:00:00' AS load_ts
FROM conversations"""


def _landed(raw):
    doc = "record_content"
    return raw.select(
        F.variant_get(doc, "$.message_id", "string").alias("message_id"),
        F.variant_get(doc, "$.json_body.conversation_id", "string").alias("conversation_id"),
        F.size(F.variant_get(doc, "$.json_body.summary.inquiries", "array<variant>"))
        .cast("bigint")
        .alias("inquiries"),
        "load_ts",
    )


@query("raw_landing", _LANDED)
def raw_landing(spark, sf_dir):
    """Lines that hold an object (user turns) or an array around it (all others)."""
    texts = conversation_texts(spark, sf_dir).select(
        F.when(F.col("role") == "user", F.col("value"))
        .otherwise(F.concat(F.lit("["), F.col("value"), F.lit("]")))
        .alias("value")
    )
    source = scratch_path(spark, "documents")
    texts.write.text(source)
    return _landed(land_raw(spark, source, scratch_path(spark, "raw"), RUN, lines=True))


@query("raw_landing_files", _LANDED)
def raw_landing_files(spark, sf_dir):
    """Files that each hold one array of documents: a hash group of about a thousand."""
    texts = conversation_texts(spark, sf_dir)
    source = scratch_path(spark, "document-files")
    write_array_files(texts, source, key="value", rows_per_file=1_000)
    return _landed(land_raw(spark, source, scratch_path(spark, "raw"), RUN))


# Every stored column, written out, so that one too many would show.
_STORED = {
    "conversation": (
        "conversation_id message_id sequence_number generated_at model_version prompt_tokens"
        " completion_tokens total_tokens updated_on load_ts"
    ),
    "inquiry": (
        "inquiry_id conversation_id inquiry_number inquiry_role inquiry_parent_number"
        " classification description resolution status inquiry_summary meme_ck updated_on load_ts"
    ),
    "inquiry_intent": "inquiry_id intent_id intent_label updated_on load_ts",
    "inquiry_key_point": "inquiry_id key_point_seq key_point_text updated_on load_ts",
    "inquiry_topic": "inquiry_id topic_seq topic_text updated_on load_ts",
}
# relation -> (key, number, text) on the Spark side.
_SHOWN = {
    "conversation": ("conversation_id", "prompt_tokens", ("message_id", "model_version")),
    "inquiry": (
        "inquiry_id",
        "inquiry_number",
        ("conversation_id", "inquiry_role", "classification", "description", "status"),
    ),
    "inquiry_intent": ("inquiry_id", "intent_id", ("intent_label",)),
    "inquiry_key_point": ("inquiry_id", "key_point_seq", ("key_point_text",)),
    "inquiry_topic": ("inquiry_id", "topic_seq", ("topic_text",)),
}


def _stored_rows(spark, folder: str) -> DataFrame:
    """All stored rows of the five relations: relation, stored columns, key, number, text."""
    parts = []
    for name, (key, number, texts) in _SHOWN.items():
        rows = spark.read.parquet(f"{folder}/{name}")
        parts.append(
            rows.select(
                F.lit(name).alias("relation"),
                F.lit(" ".join(c for c in rows.columns if c not in ("broken_rules", "run"))).alias("stored_columns"),
                F.col(key).alias("row_key"),
                F.col(number).cast("bigint").alias("row_number"),
                F.concat_ws("|", *texts).alias("row_text"),
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


_JOB_ROWS = f"""
WITH {_TURNS}, stored AS (
SELECT 'conversation' AS relation, id AS row_key, length(text)::BIGINT AS row_number,
       'm' || id || '|' || role AS row_text
FROM turns WHERE role <> 'system'
UNION ALL SELECT 'inquiry', inquiry_id, (pos + 1)::BIGINT,
       concat_ws('|', id, role, role, trim(line), CASE WHEN line <> '' THEN 'open' END) FROM inquiries
UNION ALL SELECT 'inquiry_intent', inquiry_id, length(line)::BIGINT, role FROM inquiries
UNION ALL SELECT 'inquiry_key_point', inquiry_id, generate_subscripts(string_split(line, '. '), 1)::BIGINT,
       trim(unnest(string_split(line, '. '))) FROM inquiries
UNION ALL SELECT 'inquiry_topic', inquiry_id, generate_subscripts(string_split(line, ' '), 1)::BIGINT,
       trim(unnest(string_split(line, ' '))) FROM inquiries
), named(relation, stored_columns) AS (
  VALUES {", ".join(f"('{name}', '{columns}')" for name, columns in _STORED.items())}
)"""


@query("ingest_job", f"{_JOB_ROWS} SELECT * FROM stored JOIN named USING (relation)")
def ingest_job(spark, sf_dir):
    """The whole job, run twice: the second run finds everything already stored."""
    source = scratch_path(spark, "documents")
    conversation_texts(spark, sf_dir).select("value").write.text(source)
    landing, finals = scratch_path(spark, "raw"), scratch_path(spark, "final")
    rejects = scratch_path(spark, "rejects")
    for _ in range(2):
        ingest(spark, source, landing, finals, RUN, lines=True, rejects=rejects)
    return _stored_rows(spark, finals)


@query(
    "ingest_steps",
    """
SELECT unnest(['land raw', 'stage inquiries', 'load conversation', 'load inquiry', 'load inquiry_intent',
               'load inquiry_key_point', 'load inquiry_topic']) AS step, true AS in_utc,
       (SELECT sum(len(string_split(text, chr(10)))) FROM conversations WHERE role <> 'system')::BIGINT AS rejected""",
)
def ingest_steps(spark, sf_dir):
    """The log of a run as rows, and how many intents without a number it rejected."""
    source = scratch_path(spark, "documents")
    conversation_texts(spark, sf_dir).select("value").write.text(source)
    rejects = scratch_path(spark, "rejects")
    log = ingest(
        spark, source, scratch_path(spark, "raw"), scratch_path(spark, "final"), RUN, True, rejects
    )
    rejected = spark.read.parquet(f"{rejects}/inquiry_intent").count()
    return log.select(
        "step", F.col("started_at").endswith("Z").alias("in_utc"), F.lit(rejected).alias("rejected")
    )


@query(
    "rejects_of_a_repaired_run",
    """
SELECT 'first' AS run, count(*) FILTER (length(text) <= 4000) AS stored,
       count(*) FILTER (length(text) > 4000) AS rejected FROM documents
UNION ALL SELECT 'repaired', count(*), 0 FROM documents""",
)
def rejects_of_a_repaired_run(spark, sf_dir):
    """Texts that are too long are rejected; the run is repeated with those replaced by a digest."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("description"), "lang", F.lit(1).alias("quality"),
        run_time(RUN).alias("updated_on"),
    )
    contract = Contract(
        "documents", (*DOCUMENTS.columns, ColumnSpec("updated_on", "timestamp_ntz")), ("doc_id",)
    )
    repaired = docs.withColumn(
        "description",
        F.when(F.length("description") > 4000, F.sha2("description", 256)).otherwise(F.col("description")),
    )
    target, rejects = scratch_path(spark, "docs"), scratch_path(spark, "docs-rejects")
    found = []
    for name, work in (("first", docs), ("repaired", repaired)):
        load_versioned(spark, work, target, contract, RUN, rejects)
        stored, rejected = (spark.read.parquet(path).count() for path in (target, rejects))
        found.append((name, stored, rejected))
    return spark.createDataFrame(found, "run string, stored bigint, rejected bigint")


@query(
    "versioned_append_single",
    """
WITH work AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS order_id,
         o_orderdate AS updated_on, o_custkey, o_totalprice, o_orderstatus
  FROM orders
), final AS (SELECT * FROM work WHERE o_orderstatus = 'F')
SELECT w.* FROM work w
LEFT JOIN final t ON t.order_id = w.order_id AND t.updated_on = w.updated_on
WHERE t.order_id IS NULL""",
)
def versioned_append_single(spark, sf_dir):
    work = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("order_id"),
        F.col("o_orderdate").alias("updated_on"),
        "o_custkey",
        "o_totalprice",
        "o_orderstatus",
    )
    return unseen_rows(work, work.filter("o_orderstatus = 'F'"), ["order_id"])


@query(
    "versioned_append_composite",
    """
WITH work AS (
  SELECT l_orderkey::VARCHAR AS order_id,
         CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS line_seq,
         l_shipdate AS updated_on, l_partkey, l_quantity
  FROM lineitem
), final AS (
  SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS line_seq, l_shipdate AS updated_on
  FROM lineitem WHERE l_linestatus = 'F'
)
SELECT w.* FROM work w
LEFT JOIN (SELECT DISTINCT * FROM final) t
  ON t.order_id = w.order_id AND t.line_seq = w.line_seq AND t.updated_on = w.updated_on
WHERE t.order_id IS NULL""",
)
def versioned_append_composite(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    padded = F.rpad(F.col("l_orderkey").cast("string"), 20, " ").alias("order_id")
    work = trim_text_columns(
        lines.select(
            padded,
            F.when(F.col("l_returnflag") != "N", F.col("l_linenumber")).alias("line_seq"),
            F.col("l_shipdate").alias("updated_on"),
            "l_partkey",
            "l_quantity",
        )
    )
    final = trim_text_columns(
        lines.filter("l_linestatus = 'F'").select(
            padded,
            F.col("l_linenumber").alias("line_seq"),
            F.col("l_shipdate").alias("updated_on"),
        )
    )
    return unseen_rows(work, final, ["order_id", "line_seq"])


@query(
    "versioned_append_dedup",
    """
SELECT l_orderkey, l_linenumber, l_shipdate AS updated_on, min(l_partkey) AS l_partkey
FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem f
                  WHERE f.l_linestatus = 'F' AND f.l_orderkey = l.l_orderkey
                    AND f.l_linenumber = l.l_linenumber AND f.l_shipdate = l.l_shipdate)
GROUP BY 1, 2, 3""",
)
def versioned_append_dedup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "updated_on")
    columns = ["l_orderkey", "l_linenumber", "updated_on", "l_partkey"]
    return unseen_rows(
        lines.select(*columns),
        lines.filter("l_linestatus = 'F'").select(*columns),
        ["l_orderkey", "l_linenumber"],
        dedup_within_batch=True,
    )


ORDERS = Contract(
    "orders_final",
    (
        ColumnSpec("o_orderkey", "bigint", nullable=False),
        ColumnSpec("o_orderstatus", length=1),
        ColumnSpec("o_totalprice", "double"),
        ColumnSpec("updated_on", "timestamp_ntz", nullable=False),
    ),
    primary_key=("o_orderkey",),
)


@query(
    "final_after_two_runs",
    """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS updated_on FROM orders""",
)
def final_after_two_runs(spark, sf_dir):
    work = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "updated_on")
    target = scratch_path(spark, "orders-final")
    for part in (work.filter("o_orderstatus = 'F'"), work, work):
        load_versioned(spark, part, target, ORDERS)
    return spark.read.parquet(target)


LINES = Contract(
    "lines_final",
    (
        ColumnSpec("l_orderkey", "bigint", nullable=False),
        ColumnSpec("l_linenumber", "bigint", nullable=False),
        ColumnSpec("l_quantity", "double"),
        ColumnSpec("updated_on", "timestamp_ntz", nullable=False),
        ColumnSpec("load_ts", "timestamp_ntz", nullable=False),
    ),
    primary_key=("l_orderkey", "l_linenumber"),
)


@query(
    "versioned_append_unknown_version",
    """
WITH l AS (
  SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_shipdate AS updated_on, l_linestatus
  FROM lineitem
), f AS (SELECT * FROM l WHERE l_linestatus = 'F'),
b AS (
  SELECT * REPLACE (updated_on + INTERVAL 1 DAY AS updated_on) FROM f
  UNION ALL SELECT * FROM l WHERE l_linestatus <> 'F' AND updated_on >= TIMESTAMP '1997-01-01'
)
SELECT * EXCLUDE (l_linestatus), TIMESTAMP '2026-01-01' AS load_ts FROM f
UNION ALL
SELECT * EXCLUDE (l_linestatus), TIMESTAMP '2026-01-02' FROM b
WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.l_orderkey = b.l_orderkey
                  AND f.l_linenumber = b.l_linenumber AND f.updated_on = b.updated_on)""",
)
def versioned_append_unknown_version(spark, sf_dir):
    """Batches whose rows carry many versions; the second holds stored rows, later versions of them and new rows.

    The load time is the column's default: batches that lack it get that of
    their run.
    """
    lines = table(spark, sf_dir, "lineitem").withColumn("updated_on", F.col("l_shipdate").cast("timestamp_ntz"))
    first = lines.filter("l_linestatus = 'F'")
    later = first.withColumn("updated_on", F.col("updated_on") + F.expr("interval 1 day"))
    second = first.unionByName(later).unionByName(lines.filter("l_linestatus <> 'F' and l_shipdate >= '1997-01-01'"))
    target = scratch_path(spark, "lines-final")
    for day, batch in ((1, first), (2, second), (2, second)):
        load_versioned(spark, with_load_ts(batch, run_time(datetime(2026, 1, day))), target, LINES)
    return spark.read.parquet(target)


@query(
    "latest_version",
    """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
WHERE rn = 1""",
)
def latest_version_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"
    )
    return latest_version(orders, ["o_custkey"], version="o_orderdate")


@query(
    "char_trim",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def char_trim(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return trim_text_columns(
        customers.select(
            "c_custkey",
            F.concat("c_name", F.repeat(F.lit(" "), F.col("c_nationkey"))).alias("c_name"),
            F.rpad("c_mktsegment", 15, " ").alias("c_mktsegment"),
        )
    )


def _labelled_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("text", "description")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query(
    "contract_violations",
    """
WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'doc_id: null' AS rule, sum(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END)::BIGINT AS violations FROM d
UNION ALL
SELECT 'description: longer than 4000', sum(CASE WHEN length(text) > 4000 THEN 1 ELSE 0 END) FROM d
UNION ALL
SELECT 'lang: longer than 2', sum(CASE WHEN length(lang) > 2 THEN 1 ELSE 0 END) FROM d
UNION ALL
SELECT 'quality: null', sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) FROM d""",
)
def contract_violations(spark, sf_dir):
    return violation_counts(_labelled_documents(spark, sf_dir), DOCUMENTS)


@query(
    "contract_rejects",
    """
WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id,
       concat_ws(', ', CASE WHEN length(text) > 4000 THEN 'description: longer than 4000' END,
                       CASE WHEN quality IS NULL THEN 'quality: null' END) AS broken_rules
FROM d WHERE length(text) > 4000 OR quality IS NULL""",
)
def contract_rejects(spark, sf_dir):
    _, bad = split_rejects(_labelled_documents(spark, sf_dir), DOCUMENTS)
    return bad.select("doc_id", F.array_join("broken_rules", ", ").alias("broken_rules"))
