"""Job: land nested documents, shred them, append what is new to the final tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeledger.contracts import DOCUMENT_CONTRACTS, RAW, Contract, conform, enforce, mark_broken
from lakeledger.functions import run_stamp, run_time, trim_text_columns, utc
from lakeledger.operators.documents import inquiries, shred_documents
from lakeledger.operators.versions import dedup_batch, of_batch, of_version, unseen_rows
from lakeledger.sinks.tables import append_table, overwrite_table
from lakeledger.sources.json import read_documents


def land_raw(
    spark: SparkSession, source: str, target: str, load_ts: datetime, lines: bool = False
) -> DataFrame:
    """Replace the landing table by the documents under ``source``; the files stay."""
    documents = read_documents(spark, source, run_time(load_ts), lines)
    overwrite_table(enforce(documents, RAW), target)
    return spark.read.parquet(target)


def _final_table(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    try:
        return spark.read.schema(contract.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], contract.schema)
        raise


def load_versioned(
    spark: SparkSession,
    work: DataFrame,
    target: str,
    contract: Contract,
    run_version: datetime | None = None,
    rejects: str | None = None,
    dedup_within_batch: bool = False,
) -> None:
    """Trim, check the contract, append rows whose key and version are new.

    A row that breaks the contract fails the load, or goes to ``rejects`` when
    that path is given: into a folder of the run, which a repeated run replaces
    also when it has no such row, or appended when ``run_version`` is not
    known. The good rows are written first, and that write counts the bad ones;
    the plan runs a second time only if there are any. Repeating a load adds nothing, so a
    run that stopped half-way is completed by running it again. One writer per
    target at a time. ``run_version`` is the one version that all rows of this
    run carry, when it is known; only stored rows of that version are read.
    Otherwise the span of the batch's versions and a filter of its keys keep
    the rest of the target out of the join (``of_batch``).
    """
    trimmed = trim_text_columns(work)
    seen = Observation()
    if rejects is None:
        fresh = enforce(trimmed, contract)
    else:
        is_bad = F.size("broken_rules") > 0
        marked = mark_broken(trimmed, contract)
        bad = marked.filter(is_bad)
        counted = marked.observe(seen, F.count_if(is_bad).alias("bad"))
        fresh = counted.filter(~is_bad).drop("broken_rules")
    final = _final_table(spark, target, contract)
    if run_version is not None:
        final = of_version(final, utc(run_version).replace(microsecond=0).isoformat(" "))
    # Usually nothing of this run is stored yet: then there is nothing to join
    # with, and the new rows need no shuffle.
    if not final.limit(1).isEmpty():
        if run_version is None:
            final = of_batch(final, conform(trimmed, contract), contract.primary_key)
        fresh = unseen_rows(fresh, final, contract.primary_key)
    if dedup_within_batch:
        fresh = dedup_batch(fresh, contract.primary_key)
    append_table(fresh, target)
    if rejects is None:
        return
    found = seen.get["bad"] > 0
    if run_version is not None:
        none = spark.createDataFrame([], bad.schema)
        overwrite_table(bad if found else none, f"{rejects}/run={run_stamp(run_version)}")
    elif found:
        append_table(bad, rejects)


def ingest(
    spark: SparkSession,
    source: str,
    landing: str,
    finals: str,
    load_ts: datetime,
    lines: bool = False,
    rejects: str | None = None,
    work: str | None = None,
) -> DataFrame:
    """The whole job. Returns the run log: one (step, started_at) row per step, in UTC.

    What several relations share is staged under ``work`` (default: a folder
    beside the final tables that readers of them do not see), which every run
    overwrites.
    """
    log: list[tuple[str, str]] = []

    def step(name: str) -> None:
        log.append((name, f"{datetime.now(UTC).replace(tzinfo=None).isoformat(timespec='seconds')}Z"))

    step("land raw")
    raw = land_raw(spark, source, landing, load_ts, lines)
    step("stage inquiries")
    staged = f"{work or f'{finals}/_work'}/inquiries"
    overwrite_table(inquiries(raw), staged)
    work = shred_documents(raw, run_time(load_ts), spark.read.parquet(staged))
    for name, contract in DOCUMENT_CONTRACTS.items():
        step(f"load {name}")
        load_versioned(
            spark,
            work[name],
            f"{finals}/{name}",
            contract,
            run_version=load_ts,
            rejects=f"{rejects}/{name}" if rejects else None,
        )
    return spark.createDataFrame(log, "step string, started_at string")
