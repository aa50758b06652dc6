"""Session defaults and the shared work folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "clicktrail", **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, skew joins)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local-mode session without it
    gets a temporary folder; on a cluster a machine-local folder would be
    invisible to the other executors, so its absence is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_folder(spark.sparkContext.applicationId)
    return "/".join([base.rstrip("/"), "clicktrail", *parts, uuid.uuid4().hex])


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"clicktrail-{application}-")


@contextlib.contextmanager
def stateful_stream_conf(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """Settings that a stateful query freezes into its checkpoint when it starts.

    State lives in RocksDB, off the JVM heap. ``state_partitions`` fixes the
    number of state shards for the life of the checkpoint; by default it is
    the session's shuffle width. How many cores the session has just now does
    not matter: executors may still be coming.
    """
    if state_partitions is None:
        state_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = {
        "spark.sql.shuffle.partitions": str(state_partitions),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
