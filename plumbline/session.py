"""Session set-up and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Spark's setting that removes the shuffle files of a query at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "plumbline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator expects.

    Adaptive execution sizes shuffle partitions and splits skewed joins at run time, the
    session time zone is UTC so that dates do not move, and ANSI mode stays on: malformed
    values are handled by ``try_*`` functions, never by switching errors off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: ``spark.checkpoint.dir``, which every executor can reach.

    Only a session in one process (``local`` or ``local[n]``) may fall back to a temporary
    folder, one for the session; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="plumbline-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


#: Scratch paths handed out since the outermost ``scratch_scope`` began.
_handed_out: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside, once the results inside are written.

    Frames are lazy: a frame made inside must not be read after the scope.
    """
    start = len(_handed_out)
    try:
        yield
    finally:
        made = _handed_out[start:]
        del _handed_out[start:]
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    For frames that several steps read, and where a later step must see exactly the rows
    an earlier step saw even when an executor is lost in between. Readers of the table
    still get column pruning and filter pushdown, which an RDD checkpoint does not give.
    """
    path = scratch_path(df.sparkSession, "cut")
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove the shuffle files of each query inside when it ends, not when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def fix_partitions(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``, which also keeps its partitions and their row order."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
