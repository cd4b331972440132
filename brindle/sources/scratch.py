"""Folders for intermediate files, which all machines of a session see."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``; where that is unset, a local master gets a temporary folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share: intermediate files go there")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="brindle-"))
            atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
        base = _local[0]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
