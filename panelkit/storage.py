"""The shared working folder, and tables written there to cut lineage.

On a cluster the folder is the one named by `spark.checkpoint.dir`, which every executor can
reach, so a lost executor never takes a stage boundary with it. Where that setting is absent a
temporary folder is made for a local master (tests), and removed when Python ends; any other master
needs the setting.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        _local_folder[app] = tempfile.mkdtemp(prefix="panelkit-")
        atexit.register(shutil.rmtree, _local_folder[app], ignore_errors=True)
    return _local_folder[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/panelkit/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back: lineage is cut and Catalyst knows the real size."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
