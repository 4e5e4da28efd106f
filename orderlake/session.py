"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Only settings that differ from Spark's defaults and that the operators rely on.
# Shuffle partitions stay with the caller; AQE coalesces and splits them.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Replaced output partitions only; re-running one month leaves the others alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Window state for many keys belongs outside the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "orderlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Rows of a backfill for each state partition: a trailing window of twelve steps holds each
# up to twelve times.
STATE_ROWS = 100_000

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one. Only a local master, as in tests, gets a fresh
    temporary folder when the setting is missing.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="orderlake-")
    return _local_roots[context.applicationId]


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


# For work that writes table after table: a query's shuffle files go when it ends, not with some
# later garbage collection. A task that writes few folders keeps their files open side by side;
# sorting its wide rows by folder would spill them. Beyond so many folders it sorts the rest.
BULK_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


@contextmanager
def bulk_settings(spark: SparkSession) -> Iterator[None]:
    """The session with ``BULK_CONF``, and as it was afterwards."""
    before = {key: spark.conf.get(key, None) for key in BULK_CONF}
    for key, value in BULK_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def streaming_session(spark: SparkSession, backfill_rows: int = 0) -> SparkSession:
    """A session of the same application for stateful streams.

    State partitions are fixed by the checkpoint and never coalesced, so there are
    no more of them than cores; batch queries keep the caller's setting. A backfill taken
    as one batch is known in size: it gets as many as keep a task's rows below a bound.
    """
    session = spark.newSession()
    zone = "spark.sql.session.timeZone"
    partitions = "spark.sql.shuffle.partitions"
    session.conf.set(zone, spark.conf.get(zone))
    cores = spark.sparkContext.defaultParallelism
    own = min(cores, int(spark.conf.get(partitions)))
    session.conf.set(partitions, str(max(own, -(-backfill_rows // STATE_ROWS))))
    # One bound for all state stores of an executor, however many partitions it holds.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    return session
