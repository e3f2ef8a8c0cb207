"""Session settings and the shared folder used for tables a query has to write."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LIBRARY_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Load ids such as "1995" must stay text when a raw folder is read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "stratafold", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; the cluster's own values come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**LIBRARY_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), "stratafold")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one; nothing is ever reused or cleared."""
    return f"{shared_folder(spark)}/{label}_{uuid.uuid4().hex[:12]}"
