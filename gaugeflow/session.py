"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    master: str | None = None,
    app_name: str = "gaugeflow",
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the library is tuned for.

    Cluster sizes (master, memory, shuffle partitions) are left to the deployment
    unless given. Shuffle partitions work best as a multiple of a table's bucket
    count: see ``functions.keys.hash_bucket``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.fieldId.read.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="gaugeflow-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables, streams and checkpoints that a job owns.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/gaugeflow/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str):
    """Set SQL options (``__`` stands for a dot) and restore them on leaving."""
    names = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def environment_options(prefix: str) -> dict[str, str]:
    """Connection options from environment variables, so no login sits in code.

    ``GAUGEFLOW_KAFKA_BOOTSTRAP_SERVERS=h:1`` read with prefix ``GAUGEFLOW_KAFKA_``
    gives ``{"bootstrap.servers": "h:1"}``.
    """
    return {
        name[len(prefix):].lower().replace("_", "."): value
        for name, value in os.environ.items()
        if name.startswith(prefix)
    }
