"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package assumes; sizes are left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A scan of a VARIANT column extracts only the fields that are asked for.
    "spark.sql.variant.pushVariantIntoScan": "true",
    # A repeated key in a JSON object: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(
    app_name: str = "lakeledger",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Scratch folder of a local session that has none configured.
_local_base: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Every executor must see it, so a machine-local folder is only used when
    Spark itself runs on this one machine and nothing is configured.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_base:
            _local_base.append(tempfile.mkdtemp(prefix="lakeledger-"))
        base = _local_base[0]
    return f"{base.rstrip('/')}/lakeledger/{name}-{uuid.uuid4().hex}"
