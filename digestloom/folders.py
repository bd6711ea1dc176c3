"""Folders that the driver and all executors see."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which must be mounted here too; where that is unset (tests), a
    temporary one. It goes when this process ends: what must last is written elsewhere."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        place = urlsplit(root)
        if place.scheme not in ("", "file"):
            raise OSError(f"{root}: files for other programs need a mounted folder in spark.checkpoint.dir")
        path = f"{unquote(place.path).rstrip('/')}/digestloom-work-{uuid.uuid4().hex}"
        os.makedirs(path)
    else:
        path = tempfile.mkdtemp(prefix="digestloom-work-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path
