"""Session construction and the few session-level settings the operators rely on.

Library functions never create a session; they take the caller's.  Only tests,
``bench.py`` and command-line use go through :func:`build_session`.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    master: str = "local[*]",
    app_name: str = "floe",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session configured the way the operators expect.

    * AQE on: coalesces small shuffle partitions, splits skewed join partitions
      and turns joins into broadcasts only when the runtime size is known small.
    * Session time zone UTC, so TIMESTAMP <-> TIMESTAMP_NTZ casts in the
      streaming path are exact and epoch-aligned windows agree with batch.
    * No web UI.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLOE_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, replay files and stream sinks.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system every executor can reach); a cluster session without it is an
    error, never a machine-local folder.  Only a ``local[...]`` session with
    nothing set (tests) gets a fresh temporary folder, registered so later
    calls in the same session agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a shared folder (checkpoints, replay files and stream sinks go there)"
            )
        root = tempfile.mkdtemp(prefix="floe-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique location under the checkpoint root."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set runtime SQL confs for the duration of a block, then restore them."""
    previous = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)

