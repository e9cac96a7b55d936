"""Session and scratch-folder helpers shared by jobs, the bench and the tests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Left to the optimizer on purpose: it broadcasts a side only below the measured
# size threshold, splits skewed sort-merge partitions and merges small ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("retailspark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Rows dealt to the folders of kept and dropped ones go to two open files, without being sorted by folder first.
LONG_STEPS = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


@contextmanager
def long_steps(spark: SparkSession) -> Iterator[None]:
    """The session with ``LONG_STEPS``, and as it was afterwards."""
    before = {key: spark.conf.get(key, None) for key in LONG_STEPS}
    for key, value in LONG_STEPS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Pieces of work whose Spark jobs are in the queue at once: while one's last tasks run, the next one's fill the other cores.
AT_ONCE = 4


def together(pieces: Iterable[Callable[[], object]]) -> list:
    """Results of independent pieces of work, in their order; the first failure in that order is raised once all are
    done. The cluster runs as many tasks at a time as ever."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        running = [pool.submit(piece) for piece in pieces]
    return [piece.result() for piece in running]


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting may fall back to a temporary
    folder of this machine; elsewhere no other executor could read it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="retailspark-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def portable(function: Callable) -> Callable:
    """``function`` of one argument for use in tasks, which find this package where the driver found it even if it is not
    on their path."""
    from pyspark import cloudpickle

    payload, root = cloudpickle.dumps(function), str(Path(__file__).resolve().parents[1])

    def call(argument):
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from pyspark import cloudpickle

        return cloudpickle.loads(payload)(argument)

    return call
