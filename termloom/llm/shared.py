"""Folders, tables and checkpoints that all executors share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of rows that are handed to a Python worker at once
BATCH_BYTES = 8 << 20
#: buckets of a table at most
MOST_BUCKETS = 10_000


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (dots as double underscores) that hold inside the block only."""
    was = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of Arrow batches to BATCH_BYTES, so that a worker's memory does not depend on how long texts are.

    It stays lowered, for results are lazy and read the setting when they run; a smaller limit is left as it is.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    said = spark.conf.get(key, None) or "0"
    now = int(said.rstrip("b")) if said.rstrip("b").lstrip("-").isdigit() else 0
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def give_back() -> None:
    """Returns memory that a worker no longer uses to the system, for workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.

    Where the session names none, one is made if all runs on this machine (tests); on a cluster that is an error, for executors
    elsewhere could not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shared"))
    return sc._jsc.sc().getCheckpointDir().get()


def _save(spark: SparkSession, df: DataFrame, path: str) -> None:
    # a finished write needs its shuffle files no more
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.option("compression", "zstd").parquet(path)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder; it survives lost executors and cuts the lineage."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _save(spark, df, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def buckets_for(df: DataFrame) -> int:
    """Buckets for tables made of df: the session's shuffle partitions, but few for inputs that Spark knows to be small."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return n if size >= 64 << 20 else min(n, 4 + size // (2 << 20))


def bucketed(spark: SparkSession, df: DataFrame, name: str, by: str, buckets: int | None = None) -> DataFrame:
    """df as a table in the shared folder in buckets by a column, sorted by it: joins and groups on that column need no shuffle.

    There are as many buckets as the session has shuffle partitions, unless said otherwise.
    """
    n = min(MOST_BUCKETS, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{shared_folder(spark)}/{table}"
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.repartition(n, F.col(by)).write.bucketBy(n, by).sortBy(by).option("compression", "zstd").option("path", path).saveAsTable(table, format="parquet")
    out = spark.table(table)
    out.stored_at, out.stored_as = path, table
    return out


def discard(spark: SparkSession, *frames: DataFrame | None) -> None:
    """Deletes tables of `written` and `bucketed` that nothing reads any more."""
    for df in frames:
        own = {} if df is None else vars(df)
        if path := own.get("stored_at"):
            if table := own.get("stored_as"):
                spark.sql(f"drop table if exists {table}")
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
