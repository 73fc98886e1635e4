"""Spark sessions with the settings that the engine's semantics need."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Civil time without a zone, strict casts, run-time re-planning, touched partitions alone overwritten.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(name: str = "trackloom", master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; `more` holds further settings, with '__' for '.'.

    `master` is set only where given, so that spark-submit's own choice stands on a cluster.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master).config("spark.driver.host", "127.0.0.1").config("spark.local.dir", os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()))
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, wherever the driver was started.

    Workers of a local session read it where it lies; those of a cluster get it as an archive from the driver, once a
    context. Where it is installed on all machines that changes nothing.
    """
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.master == "local" or context.master.startswith("local["):
        context.environment.setdefault("PYTHONPATH", str(root))
    elif not getattr(context, "_trackloom_shipped", False) and root.is_dir():
        made = tempfile.mkdtemp(prefix="trackloom-")  # the driver serves the file from here, also to executors that start later
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        shutil.copytree(root / "trackloom", Path(made) / "trackloom", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(Path(made) / "trackloom-package"), "zip", made, "trackloom"))
        context._trackloom_shipped = True
