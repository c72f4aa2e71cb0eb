"""What the operators ask of the session: a shared folder, lineage cuts, size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in bytes of its rows as text, that may be sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session, as in tests, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tallyworks-")


_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's own folder below the shared one.

    That folder is marked to be deleted when the driver's process ends, with all results that were only passed on through it.
    """
    context = spark.sparkContext
    root = _scratch.get(context.applicationId)
    if root is None:
        root = f"{shared_dir(spark).rstrip('/')}/tallyworks-{context.applicationId}"
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        store = path.getFileSystem(context._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _scratch[context.applicationId] = root
    return f"{root}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of executors and is computed once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether all rows of ``df`` together stay under ``max_bytes``.

    Rows are counted first, so that a side that is plainly too long is never rendered;
    both checks are distributed aggregates that return one row.
    """
    rows = df.count()
    if rows * 8 * len(df.columns) > max_bytes:
        return False
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()
    return (size["bytes"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when the measured size allows it; otherwise the join shuffles both sides."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def spread(df: DataFrame) -> DataFrame:
    """A scan that gives fewer tasks than there are cores, dealt out to all of them.

    Meant ahead of costly work per row on inputs that cannot be split, such as a gzip file or one
    large row group. A scan with enough tasks, as any large one has, stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
