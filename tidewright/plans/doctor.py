"""Whether a cluster can run what is here: checks on the driver and on executors, as rows."""

from __future__ import annotations

import platform
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators.rules import severity
from tidewright.sources.shared import shared_folder

ORDER = ("pass", "warn", "fail")
NEEDED = ("numpy", "pandas", "pyarrow")


def _versions() -> str:
    import importlib.metadata as m

    return ",".join([platform.python_version(), *(f"{n}={m.version(n)}" for n in NEEDED)])


def checks(spark: SparkSession, least_free_gb: float = 40.0) -> DataFrame:
    """check, status (pass, warn or fail), detail: versions alike on all executors, scratch space, the shared folder, settings."""
    own = _versions()

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in frames:
            yield pd.DataFrame([(platform.node(), _versions(), shutil.disk_usage(".").free / 1e9)], columns=["host", "versions", "free"])

    n = spark.sparkContext.defaultParallelism
    seen = spark.range(n, numPartitions=n).mapInPandas(look, "host string, versions string, free double")
    hosts = seen.groupBy("host").agg(F.min("free").alias("free"), F.count_if(F.col("versions") != own).alias("unlike")).orderBy("host").limit(10_000).collect()
    rows = [("versions", "fail" if any(h["unlike"] for h in hosts) else "pass", own)]
    rows += [(f"free:{h['host']}", "pass" if h["free"] >= least_free_gb else "warn", f"{h['free']:.1f} GB") for h in hosts]
    try:
        folder = shared_folder(spark)
        spark.range(1).write.mode("overwrite").parquet(f"{folder}/doctor")
        rows.append(("shared_folder", "pass" if spark.read.parquet(f"{folder}/doctor").count() == 1 else "fail", "written and read"))
    except Exception as x:  # noqa: BLE001  whatever it is, it is the finding
        rows.append(("shared_folder", "fail", type(x).__name__))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    rows.append(("adaptive_execution", "pass" if adaptive else "warn", str(adaptive).lower()))
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows.append(("time_zone", "pass" if zone in ("UTC", "Etc/UTC", "Z") else "warn", zone))
    return spark.createDataFrame(rows, "check string, status string, detail string")


def overall(found: DataFrame) -> str:
    """The worst status."""
    return ORDER[found.agg(severity(F.col("status"), ORDER).alias("worst")).first()[0]]
