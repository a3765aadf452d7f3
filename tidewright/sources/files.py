"""File listings with content hashes, and canonical JSON written atomically by the driver."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """path, name, size, sha256, kind of every file: source for .wav in any case, else unexpected_file_type.

    Files are listed by Spark and hashed block by block where they lie, whatever their size.
    """
    from tidewright.sources.recordings import file_sha256

    @F.pandas_udf("string")
    def digest(paths: pd.Series) -> pd.Series:
        return paths.map(file_sha256)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.when(F.lower(name).endswith(".wav"), "source").otherwise("unexpected_file_type")
    return files.select("path", name.alias("name"), F.col("length").alias("size"), digest("path").alias("sha256"), kind.alias("kind"))


def canonical_json(document: Any) -> str:
    """Sorted keys, two spaces, no NaN, a newline at the end."""
    return json.dumps(document, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n"


def sync_folder(folder: str) -> None:
    """Brings a folder's entries to disk, so that a rename in it outlives a loss of power."""
    handle = os.open(folder, os.O_RDONLY)
    try:
        os.fsync(handle)
    finally:
        os.close(handle)


def write_json(path: str, document: Any) -> str:
    """Writes beside the target, syncs and renames, so that readers see the old file or the new one. Returns its sha256."""
    data = canonical_json(document).encode()
    folder = os.path.dirname(os.path.abspath(path))
    handle, temporary = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, path)
        sync_folder(folder)
    except BaseException:
        os.unlink(temporary)
        raise
    return hashlib.sha256(data).hexdigest()
