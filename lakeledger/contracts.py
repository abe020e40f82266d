"""Table contracts: column names, order, types, declared lengths, keys.

Spark's own Parquet tables enforce neither NOT NULL nor keys. ``enforce`` puts
the NOT NULL and length checks into the projection that feeds the write, so
they cost no extra pass; ``split_rejects`` routes bad rows aside instead.
Key checks need a shuffle and live in ``operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = "decimal(38,0)"
TIMESTAMP = "timestamp_ntz"
TEXT = "string"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = TEXT
    length: int | None = None
    nullable: bool = True


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        fields = ", ".join(f"`{c.name}` {c.type}" for c in self.columns)
        return T.StructType.fromDDL(fields)


def _text(name: str, length: int | None = None, nullable: bool = True) -> ColumnSpec:
    return ColumnSpec(name, TEXT, length, nullable)


_VERSION_COLUMNS = (
    ColumnSpec("updated_on", TIMESTAMP, nullable=False),
    ColumnSpec("load_ts", TIMESTAMP, nullable=False),
)
_TO_INQUIRY = (ForeignKey(("inquiry_id",), "inquiry", ("inquiry_id",)),)

RAW = Contract(
    "raw",
    (
        ColumnSpec("record_content", "variant", nullable=False),
        ColumnSpec("load_ts", TIMESTAMP, nullable=False),
    ),
)

CONVERSATION = Contract(
    "conversation",
    (
        _text("conversation_id", 100, nullable=False),
        _text("message_id", 100),
        ColumnSpec("sequence_number", NUMBER),
        ColumnSpec("generated_at", TIMESTAMP),
        _text("model_version", 100),
        ColumnSpec("prompt_tokens", NUMBER),
        ColumnSpec("completion_tokens", NUMBER),
        ColumnSpec("total_tokens", NUMBER),
        *_VERSION_COLUMNS,
    ),
    primary_key=("conversation_id",),
)

INQUIRY = Contract(
    "inquiry",
    (
        _text("inquiry_id", 32, nullable=False),
        _text("conversation_id", 100, nullable=False),
        _text("inquiry_number", 100),
        _text("inquiry_role", 50),
        _text("inquiry_parent_number", 100),
        _text("classification", 200),
        _text("description", 4000),
        _text("resolution", 4000),
        _text("status", 50),
        _text("inquiry_summary", 4000),
        _text("meme_ck", 100),
        *_VERSION_COLUMNS,
    ),
    primary_key=("inquiry_id",),
    foreign_keys=(ForeignKey(("conversation_id",), "conversation", ("conversation_id",)),),
)

INQUIRY_INTENT = Contract(
    "inquiry_intent",
    (
        _text("inquiry_id", 32, nullable=False),
        ColumnSpec("intent_id", NUMBER, nullable=False),
        _text("intent_label", 200),
        *_VERSION_COLUMNS,
    ),
    primary_key=("inquiry_id", "intent_id"),
    foreign_keys=_TO_INQUIRY,
)

INQUIRY_KEY_POINT = Contract(
    "inquiry_key_point",
    (
        _text("inquiry_id", 32, nullable=False),
        ColumnSpec("key_point_seq", NUMBER, nullable=False),
        _text("key_point_text", 4000),
        *_VERSION_COLUMNS,
    ),
    primary_key=("inquiry_id", "key_point_seq"),
    foreign_keys=_TO_INQUIRY,
)

INQUIRY_TOPIC = Contract(
    "inquiry_topic",
    (
        _text("inquiry_id", 32, nullable=False),
        ColumnSpec("topic_seq", NUMBER, nullable=False),
        _text("topic_text", 500),
        *_VERSION_COLUMNS,
    ),
    primary_key=("inquiry_id", "topic_seq"),
    foreign_keys=_TO_INQUIRY,
)

# Parents before children: the order in which the final tables are loaded.
DOCUMENT_CONTRACTS = {
    c.name: c for c in (CONVERSATION, INQUIRY, INQUIRY_INTENT, INQUIRY_KEY_POINT, INQUIRY_TOPIC)
}

# Privacy rule of the documents: these fields are never stored.
NEVER_STORED = ("member_id", "member_suffix", "member_name")

LAYER = Contract("layer", (_text("contact_record_id"), _text("event_date")))
QUARANTINE = Contract(
    "quarantine", (_text("contact_record_id"), _text("removal_reason"), _text("event_date"))
)
LEDGER = Contract(
    "ledger",
    (
        ColumnSpec("raw_count", "bigint"),
        ColumnSpec("curated_count", "bigint"),
        ColumnSpec("sentiment_count", "bigint"),
        ColumnSpec("removed_count", "bigint"),
        ColumnSpec("unaccounted_count", "bigint"),
        ColumnSpec("raw_curated_mismatch", "boolean"),
        _text("pipeline_status"),
        _text("report_path"),
        _text("generated_at"),
        _text("event_date", nullable=False),
        _text("survey_type", nullable=False),
    ),
    primary_key=("event_date", "survey_type"),
)
SURVEY_CONFIG = Contract(
    "survey_config",
    (
        _text("survey_name", nullable=False),
        _text("raw_survey_name", nullable=False),
        _text("curated_folder"),
        _text("sentiment_folder"),
        _text("quarantine_folder"),
        ColumnSpec("sentiment_pipeline_active", "boolean", nullable=False),
    ),
    primary_key=("survey_name",),
)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns by name, in contract order, cast to contract types."""
    given = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in contract.schema.fields}
    return df.select(
        *[
            name
            if given.get(name) == wanted[name]
            else F.col(name).cast(wanted[name]).alias(name)
            for name in contract.names
        ]
    )


def with_load_ts(df: DataFrame, load_ts: Column) -> DataFrame:
    """Column default for the load time: added only where it is absent."""
    return df if "load_ts" in df.columns else df.withColumn("load_ts", load_ts)


def violations(contract: Contract) -> dict[str, Column]:
    """Rule name -> condition that is true for a violating row."""
    rules: dict[str, Column] = {}
    for c in contract.columns:
        if not c.nullable:
            rules[f"{c.name}: null"] = F.col(c.name).isNull()
        if c.length is not None:
            rules[f"{c.name}: longer than {c.length}"] = F.coalesce(
                F.length(c.name) > c.length, F.lit(False)
            )
    return rules


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """``conform`` plus a check that fails the job at the first bad row."""

    def checked(c: ColumnSpec) -> Column | str:
        if c.nullable and c.length is None:
            return c.name
        value = F.col(c.name)
        bad = None if c.nullable else value.isNull()
        problem = f"{contract.name}.{c.name}: null"
        if c.length is not None:
            too_long = f"{contract.name}.{c.name}: longer than {c.length}"
            value = F.when(F.length(c.name) > c.length, F.raise_error(F.lit(too_long))).otherwise(
                value
            )
        if bad is not None:
            value = F.when(bad, F.raise_error(F.lit(problem))).otherwise(value)
        return value.alias(c.name)

    return conform(df, contract).select(*[checked(c) for c in contract.columns])


def mark_broken(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns and ``broken_rules``, the names of the rules that a row breaks."""
    rules = violations(contract)
    broken = F.array_compact(
        F.array(*[F.when(cond, F.lit(rule)) for rule, cond in rules.items()])
    ) if rules else F.array().cast("array<string>")
    return conform(df, contract).withColumn("broken_rules", broken)


def split_rejects(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract, rejected rows with their broken rules)."""
    marked = mark_broken(df, contract)
    good = marked.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return good, marked.filter(F.size("broken_rules") > 0)


def violation_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, violations): every rule counted in one pass over the table."""
    rules = violations(contract)
    counts = conform(df, contract).agg(
        *[F.count(F.when(cond, True)).alias(f"r{i}") for i, cond in enumerate(rules.values())]
    )
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))
