"""Document ingest, typed reports, survey counts and layer reconciliation on Spark."""

from lakeledger.session import build_session, scratch_path  # noqa: F401
