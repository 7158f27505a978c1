"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What every job here relies on. Anything about sizes (shuffle partitions, split size,
# memory) belongs to the cluster and is left alone; README.md says how to choose it.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",  # day buckets depend on the session zone
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "changeflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` wins over them.

    Keyword names use ``__`` for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Of the tables that are written and read again: smaller than Spark's default, for little more time.
CODEC = "zstd"

# Bytes of files a task reads whose rows it sorts: in memory they take some thirty times as much.
SORTED_SPLIT = 24 << 20
_SPLIT = "spark.sql.files.maxPartitionBytes"


def bound_splits(spark: SparkSession, most: int = SORTED_SPLIT) -> str:
    """Let a task of this session read at most so many bytes of files, so that sorting them needs no
    disk; returns the setting before. A session that reads less already stays as it is."""
    before = spark.conf.get(_SPLIT)
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if bytes_of(before) > most:
        spark.conf.set(_SPLIT, str(most))
    return before


@contextmanager
def bounded_splits(spark: SparkSession, most: int = SORTED_SPLIT) -> Iterator[None]:
    """:func:`bound_splits` for a while: a stream of files reads by the session it was made in."""
    before = bound_splits(spark, most)
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of this machine: on a
    cluster the executors could not see it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="changeflow-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
