"""Session helpers: shared folders, table loading, size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session: ``spark.checkpoint.dir``, or one that the context already has.

    Only a local master, whose tasks share the driver's disk, gets a temporary folder where none is set; a
    cluster without a shared folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="fernwick-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, for tables written between two jobs."""
    return f"{_SCOPES[-1] if _SCOPES else checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


_SCOPES: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables that are written by ``scratch_path`` inside the block are deleted at its end, so results must have
    been written elsewhere by then. Checkpoints go with ``spark.cleaner.referenceTracking.cleanCheckpoints``."""
    folder = f"{checkpoint_dir(spark)}/scope-{uuid.uuid4().hex}"
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def same_keys_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the keys appear once."""
    renamed = right.select(*[F.col(c).alias(f"_key_{c}" if c in keys else c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_key_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_key_{k}" for k in keys])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table below the checkpoint folder: for long rows, of which a checkpoint takes many times the space."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; partitions are read one after the other until
    that is decided."""
    return len(df.select(F.lit(1)).take(max_rows + 1)) <= max_rows


# A dictionary up to this many rows (a few MB of keys and values) is sent to every task.
BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after a look at the number of rows; larger tables are joined by shuffle.

    A table that is broadcast is written to the reliable checkpoint first, so it is computed once.
    """
    return F.broadcast(cut_lineage(df)) if fits(df, max_rows) else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of an input with fewer splits than cores out by key; larger inputs stay as they are.

    Meant for inputs of a single small file in front of costly per-row work. Only the columns that
    are used later take part in the shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
