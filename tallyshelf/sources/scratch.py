"""A folder all executors can reach, for tables written between two steps."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``.

    Where the setting is missing a session in one process gets a temporary
    folder, the same one for all calls, which goes when the process ends. A
    cluster, ``local-cluster`` included, gets an error, since its executors do
    not share one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _process_folder().name
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@cache
def _process_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="tallyshelf-")
