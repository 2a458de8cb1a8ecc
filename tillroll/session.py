"""Session settings that the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

# Run-time settings. Memory and cores stay with whoever starts the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, even where the split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the run-time options above on an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# A shuffle of a whole input is cut so that a partition stands for this much of it, within a bound
# that the driver's book-keeping can carry. AQE merges the partitions that turn out small.
INPUT_BYTES_PER_PARTITION = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 32_768
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Reading tasks take larger pieces of a larger input, up to a gigabyte, to stay near this number.
READ_TASKS = 100_000
LARGEST_READ = 1024 * 1024 * 1024
READ_FLOOR = 128 * 1024 * 1024
READ_BYTES = "spark.sql.files.maxPartitionBytes"

# Broadcasts are planned by the sizes of files, in which a column of keys may take a twentieth of its rows in memory.
# Over an input from this size on files count so many times; AQE still broadcasts what turns out small.
FILES_MISLEAD_FROM = 64 * 1024 * 1024
FILE_FACTOR, IN_MEMORY = "spark.sql.sources.fileCompressionFactor", 20.0


def fit_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Raise shuffle partitions, read sizes and what files count in planning to suit the input; they are never lowered."""
    shuffles = min(MAX_SHUFFLE_PARTITIONS, input_bytes // INPUT_BYTES_PER_PARTITION + 1)
    current = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get(
        "spark.sql.shuffle.partitions"
    )
    if shuffles > int(current):
        spark.conf.set(INITIAL_PARTITIONS, str(shuffles))
    read_bytes = min(LARGEST_READ, input_bytes // READ_TASKS)
    if read_bytes > READ_FLOOR and spark.conf.get(READ_BYTES) in (f"{READ_FLOOR}b", str(READ_FLOOR)):
        spark.conf.set(READ_BYTES, f"{read_bytes}b")
    if input_bytes >= FILES_MISLEAD_FROM and float(spark.conf.get(FILE_FACTOR)) < IN_MEMORY:
        spark.conf.set(FILE_FACTOR, str(IN_MEMORY))


# Whether the shuffle files of a query go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs inside; afterwards it is as it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextlib.contextmanager
def fitted_partitions(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """`fit_partitions` for the jobs inside; afterwards the session's settings are as they were."""
    before = {key: spark.conf.get(key, None) for key in (INITIAL_PARTITIONS, READ_BYTES, FILE_FACTOR)}
    fit_partitions(spark, input_bytes)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def object_store_conf(
    endpoint: str, access_key: str, secret_key: str, tls: bool = False
) -> dict[str, str]:
    """Builder options for an S3-compatible store with path-style addresses."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared checkpoint folder of the session.

    Without that setting a local master uses the warehouse folder; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def at_once(spark: SparkSession, calls: Iterable[Callable[[], Result]]) -> list[Result]:
    """The calls' results. Their jobs run side by side, so the last tasks of one do not keep the cluster waiting.

    The calls must not depend on each other. All are ended when the first error, if any, is raised.
    """
    own = [inheritable_thread_target(spark)(call) for call in calls]  # jobs keep the caller's group and properties
    with ThreadPoolExecutor(max(1, len(own))) as pool:
        jobs = [pool.submit(call) for call in own]
    return [job.result() for job in jobs]
