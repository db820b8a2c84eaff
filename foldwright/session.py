"""Session settings and the shared folder for cut lineages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: staged tables of this process that have not been removed
_staged: list[str] = []


def build_session(app: str = "foldwright", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Only settings that change results or skew handling are fixed here; sizes
    (memory, shuffle partitions) belong to whoever submits the job.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # building wide plans is much faster without call-site capture
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    session without it is refused, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current is not None:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="foldwright-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and drop its lineage (iterative operators)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a fitted or intermediate table to the shared folder and read it back.

    Used for tables that several parts of a plan read. A written table survives
    the loss of executors, and its true size lets Spark choose the joins.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    _staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of ``rows`` rows at most for jobs that run inside the block.

    For maps over whole texts: a batch is held by the executor and by its Python
    worker at once, and ten thousand texts are tens of megabytes for each.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    # less than one row stands for no limit
    spark.conf.set(name, rows if int(before) < 1 else min(int(before), rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the tables that were staged inside it.

    For jobs that write their result inside the block: what an operator returns
    may still read its staged tables, so these cannot go any earlier.
    """
    first = len(_staged)
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in _staged[first:]:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        del _staged[first:]
