"""Shredding of nested documents into five related row sets.

Everything is a projection: no shuffle. The header reads its own fields of the
documents. The four other relations come from one typed frame of inquiries,
which a job can store once, so that each relation then reads its own columns
and the documents are parsed a single time. The member fields of an inquiry
are never named here, so they cannot reach a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.functions import record_key, try_number, try_timestamp_ntz, unnest

CONVERSATION_ID = "$.json_body.conversation_id"
INQUIRIES = "$.json_body.summary.inquiries"


def text_at(variant: str | Column, path: str) -> Column:
    """Value at a path as text; missing paths and JSON nulls are null."""
    return F.variant_get(variant, path, "string")


def elements_at(variant: str | Column, path: str) -> Column:
    """Array at a path; anything that is not an array is null (no rows when exploded)."""
    return F.try_variant_get(variant, path, "array<variant>")


def _stamp(df: DataFrame, load_ts: Column) -> DataFrame:
    """One run time for all five relations of a run."""
    return df.withColumn("updated_on", load_ts).withColumn("load_ts", load_ts)


def shred_conversation(raw: DataFrame, load_ts: Column) -> DataFrame:
    doc = "record_content"
    header = raw.select(
        text_at(doc, CONVERSATION_ID).alias("conversation_id"),
        text_at(doc, "$.message_id").alias("message_id"),
        try_number(text_at(doc, "$.sequence_number")).alias("sequence_number"),
        try_timestamp_ntz(text_at(doc, "$.json_body.generated_at")).alias("generated_at"),
        text_at(doc, "$.json_body.model_version").alias("model_version"),
        *[
            try_number(text_at(doc, f"$.json_body.token_usage.{name}")).alias(name)
            for name in ("prompt_tokens", "completion_tokens", "total_tokens")
        ],
    ).filter(F.col("conversation_id").isNotNull())
    return _stamp(header, load_ts)


INQUIRY_FIELDS = (
    "inquiry_number",
    "inquiry_role",
    "inquiry_parent_number",
    "classification",
    "description",
    "resolution",
    "status",
    "inquiry_summary",
    "meme_ck",
)


def inquiries(raw: DataFrame) -> DataFrame:
    """One typed row per inquiry: keys, text fields, and its three inner lists.

    The key is on the position of the inquiry in its document. Elements are
    taken one by one, so that an odd one does not cost the whole list.
    """
    record = text_at("record_content", CONVERSATION_ID)
    documents = raw.select(
        record.alias("conversation_id"),
        # A document without an id has no inquiries.
        F.when(record.isNotNull(), elements_at("record_content", INQUIRIES)).alias("items"),
    )
    items = unnest(documents, "items", ["conversation_id"], "item")

    def texts(path: str) -> Column:
        return F.transform(elements_at("item", path), lambda e: text_at(e, "$"))

    return items.select(
        record_key(F.col("conversation_id"), F.col("pos")).alias("inquiry_id"),
        "conversation_id",
        *[text_at("item", f"$.{name}").alias(name) for name in INQUIRY_FIELDS],
        F.transform(
            elements_at("item", "$.intents"),
            lambda e: F.struct(text_at(e, "$.id").alias("id"), text_at(e, "$.label").alias("label")),
        ).alias("intents"),
        texts("$.key_points").alias("key_points"),
        texts("$.topics_covered").alias("topics"),
    )


def shred_inquiry(rows: DataFrame, load_ts: Column) -> DataFrame:
    return _stamp(rows.select("inquiry_id", "conversation_id", *INQUIRY_FIELDS), load_ts)


def shred_intent(rows: DataFrame, load_ts: Column) -> DataFrame:
    intents = unnest(rows, "intents", ["inquiry_id"], "intent").select(
        "inquiry_id",
        try_number(F.col("intent.id")).alias("intent_id"),
        F.col("intent.label").alias("intent_label"),
    )
    return _stamp(intents, load_ts)


def _shred_texts(rows: DataFrame, load_ts: Column, column: str, name: str) -> DataFrame:
    texts = unnest(rows, column, ["inquiry_id"], f"{name}_text").select(
        "inquiry_id",
        (F.col("pos") + 1).cast("decimal(38,0)").alias(f"{name}_seq"),
        f"{name}_text",
    )
    return _stamp(texts, load_ts)


def shred_key_point(rows: DataFrame, load_ts: Column) -> DataFrame:
    return _shred_texts(rows, load_ts, "key_points", "key_point")


def shred_topic(rows: DataFrame, load_ts: Column) -> DataFrame:
    return _shred_texts(rows, load_ts, "topics", "topic")


def shred_documents(
    raw: DataFrame, load_ts: Column, rows: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The five relations, parents first. ``rows`` are stored ``inquiries``, if there are any."""
    rows = inquiries(raw) if rows is None else rows
    return {
        "conversation": shred_conversation(raw, load_ts),
        "inquiry": shred_inquiry(rows, load_ts),
        "inquiry_intent": shred_intent(rows, load_ts),
        "inquiry_key_point": shred_key_point(rows, load_ts),
        "inquiry_topic": shred_topic(rows, load_ts),
    }
