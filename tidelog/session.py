"""Session settings the library relies on, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Wall-clock columns are TIMESTAMP_NTZ in UTC; a repeated JSON key keeps its
# last value, as JSON readers in other languages do.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_local_base: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may do without that setting: it gets one temporary
    folder per process. A cluster session without it is refused, because a
    folder on one machine would be lost with that machine.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):  # local-cluster is one
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="tidelog-")
        base = _local_base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
