"""Test queries on the given tables, with their SQL oracles."""

from workload import ingest, json_files, quality, report, surveys  # noqa: F401
from workload.base import ORACLES, QUERIES  # noqa: F401
