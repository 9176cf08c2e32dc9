"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings that change results, not only speed:
# timestamps are UTC instants, and a repeated JSON key keeps its last value.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session."""
    for name, value in REQUIRED_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings for what runs or starts inside; the session's own come back."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def local_session(cores: str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # Plans are built from many small column calls; call-site capture costs seconds.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Where that is unset, a session of one machine uses a folder that goes with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@functools.cache
def _own_folder() -> str:
    root = tempfile.mkdtemp(prefix="tallyline-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root
