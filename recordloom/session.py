"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the package is written for; all of them can be changed at runtime.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for stage tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="recordloom-"))
    return sc.getCheckpointDir().rstrip("/")


# Scratch paths of each application, in the order they were handed out.
_handed_out: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """How many scratch paths were handed out so far, for :func:`clear_scratch`."""
    return len(_handed_out.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> int:
    """Remove the scratch tables made since a mark, but for some; the number of those that were there.

    Frames that still read from them fail afterwards, so call it when what they
    were made for is written.
    """
    paths = _handed_out.get(spark.sparkContext.applicationId, [])
    gone = [path for path in paths[since:] if path not in keep]
    paths[since:] = [path for path in paths[since:] if path in keep]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for path in gone:
        where = jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(where.getFileSystem(conf).delete(where, True))
    return removed
