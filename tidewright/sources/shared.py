"""The folder that all executors share, and tables written there once."""

from __future__ import annotations

import re
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; unset on one machine, as in tests, a temporary one. A cluster has to name it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="shared-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The table, written once; whatever reads it plans from there."""
    shared_folder(df.sparkSession)
    importable(df.sparkSession)
    return df.checkpoint()


def importable(spark: SparkSession) -> None:
    """Puts the folder that holds this library on the Python path of the workers, wherever the driver was started."""
    paths = spark.sparkContext.environment
    here = str(Path(__file__).resolve().parents[2])
    if here not in paths.get("PYTHONPATH", "").split(":"):
        paths["PYTHONPATH"] = ":".join(x for x in (paths.get("PYTHONPATH"), here) if x)
