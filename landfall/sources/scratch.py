"""A folder all executors can reach, for tables that one query writes and reads back."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

from landfall.sources.files import remove

_MADE: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, or gives its context.

    Only a session that runs in one process may do without.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.gettempdir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no other query uses. It lies in a folder of the application, which ends with the driver."""
    folder = f"{scratch_root(spark)}/landfall-{spark.sparkContext.applicationId}"
    if folder not in _MADE:
        _MADE.add(folder)
        atexit.register(_remove, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, folder: str) -> None:
    """Only while the application still runs; a cluster's own clean-up of that folder takes the rest."""
    with contextlib.suppress(Py4JError):
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            remove(spark, folder)
