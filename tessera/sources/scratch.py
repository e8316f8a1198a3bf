"""The folder that driver and executors share, for tables between steps of one application."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir. Where that is unset a local session gets a temporary folder, and a cluster, whose machines share none, an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = _own.get(app) or _own.setdefault(app, "file://" + tempfile.mkdtemp(prefix="tessera-"))
    return f"{found.rstrip('/')}/{app}/{name}-{uuid.uuid4().hex}"
