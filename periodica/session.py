"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession


def shuffle_partitions(input_bytes: int, target_bytes: int = 512 << 20) -> int:
    """Partitions that keep a shuffle of the whole input near the target size each."""
    return max(200, -(-input_bytes // target_bytes))


def build_session(
    app: str = "periodica", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with adaptive execution, UTC and skew handling switched on.

    ``input_bytes`` sizes shuffles for the largest table: a job over 100 TB starts
    with some 200,000 partitions, which adaptive execution merges where a stage
    turns out smaller. Pass ``spark_sql_shuffle_partitions="8"`` for a local run.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if input_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings.update({k.replace("_", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset and all
    work is done in this one process, as in local tests, a new folder is made and set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="periodica-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def forget(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK, _INSIDE = Lock(), {}


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """What is run in here removes what it shuffled when it is done.

    Otherwise that stays on the disks until the driver happens to collect the plan as
    garbage, and a job of many writes keeps the shuffles of all of them. A frame that is
    run a second time shuffles again.
    """
    session = spark._jsparkSession.hashCode()
    with _LOCK:
        count, before = _INSIDE.get(session, (0, None))
        if not count:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _INSIDE[session] = count + 1, before
    try:
        yield
    finally:
        with _LOCK:
            count, before = _INSIDE.pop(session)
            if count > 1:
                _INSIDE[session] = count - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)
