"""What the engine needs of a session."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> None:
    """Puts the session clock to UTC, and this package on the path of Python workers that see the same folders as the driver.

    Executors elsewhere need the package as usual, by ``--py-files`` or installed.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    folder, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if folder not in known:
        environment["PYTHONPATH"] = os.pathsep.join([folder, *filter(None, known)])
