"""Folders for files between two steps, which the driver and all executors see."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, as a plain path; on a local master without one, a temporary folder that
    goes when the driver ends."""
    top = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if top:
        place = f"{top.removeprefix('file://').rstrip('/')}/scratch-{uuid.uuid4().hex}"
        os.makedirs(place)
        return place
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    place = tempfile.mkdtemp(prefix="scratch-")
    atexit.register(shutil.rmtree, place, True)
    return place
