"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that suit wide report rows; none of them changes a result. The number of shuffle
# partitions is left to the cluster: AQE merges small ones.
RECOMMENDED_SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Java does not compile methods over 64 KB and does not optimise those over 8000 bytes. Whole-stage code of the
    # 80 report columns is larger: it would be made, refused and made again in pieces. Rows as wide as
    # these go through expressions that are compiled one by one, narrower ones through whole-stage code.
    "spark.sql.codegen.maxFields": "60",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Column calls are many here, and recording a Python stack trace for each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Shuffle files of a finished statement are deleted at once. By default they stay until the driver's garbage collector
# happens to find their statement, so a run of several writes holds the shuffles of all of them.
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}


def tune(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Adds the recommended settings to a session builder."""
    for key, value in RECOMMENDED_SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def prepare(spark: SparkSession) -> SparkSession:
    """Applies the recommended settings to a running session, as far as they can still change."""
    for key, value in RECOMMENDED_SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for some statements."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="billweave-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; nothing is written there yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
