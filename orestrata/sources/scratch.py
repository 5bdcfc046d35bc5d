"""Written intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from orestrata.sources import paths

# The folder of the run that the caller is in.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


@lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application_id}-")


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session, or the context's checkpoint folder.

    Only a local master, whose tasks all run on this machine, may fall back to a
    temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    return _local_folder(context.applicationId)


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[str]:
    """Everything written to the shared folder inside goes when the scope ends, also by an error.

    What is computed inside must be written elsewhere, or collected, before that.
    """
    folder = f"{_RUN.get() or shared_folder(spark)}/run-{uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        paths.remove(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder, or in that of the run, that nothing else uses."""
    return f"{_RUN.get() or shared_folder(spark)}/{label}-{uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write `df` once and return a scan of the written table.

    Later passes read columns of the file instead of running the plan again, always see
    the same rows, and do not depend on the executors that computed them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
