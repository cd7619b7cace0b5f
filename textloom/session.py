"""Session construction for local runs; clusters bring their own session."""

from __future__ import annotations

import os
import sys
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int = 8, app: str = "textloom", memory: str = "8g", shuffle_partitions: int | None = None) -> SparkSession:
    """A local[cores] session with the settings the tests and the bench use."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    root = str(Path(__file__).resolve().parents[1])
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
