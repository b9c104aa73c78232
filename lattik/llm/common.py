"""Helpers shared by the training-data operators: shared-folder tables, size-checked joins, text batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import lattik.llm as _package

# Functions that run on executors travel by value, so that workers need not have this package on their path. What is broadcast
# does not: broadcasts hold plain tuples, bytes and arrays only.
cloudpickle.register_pickle_by_value(_package)

#: Rows of a key-only side (16 bytes a row or less) up to which it is broadcast; larger sides are shuffled.
BROADCAST_KEYS = 1_000_000
#: Rows in an Arrow batch, at most: a batch of texts is held by the JVM and by Python at once, in and out.
BATCH_ROWS = 1_000


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is missing, a local session (as in tests) gets a temporary folder; on a cluster that is an error, as
    executors couldn't see it. The folder is deleted when the driver's JVM ends.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not known:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        known = "file://" + tempfile.gettempdir()
    folder = f"{known.rstrip('/')}/lattik-{context.applicationId}"
    if folder not in _FOLDERS:
        where = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
        _FOLDERS.add(folder)
    return folder


_FOLDERS: set[str] = set()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``materialize`` has written and that no plan reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/lattik-" in path and "/table-" in path:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def semi_join_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids``: by broadcast up to ``BROADCAST_KEYS`` keys, by shuffle beyond."""
    n = ids.limit(BROADCAST_KEYS + 1).count()
    return df.join(F.broadcast(ids) if n <= BROADCAST_KEYS else ids, key, "left_semi")


def anti_join_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``ids`` (null keys stay): by broadcast up to ``BROADCAST_KEYS`` keys, by shuffle beyond."""
    known = materialize(ids.select(key).distinct())
    n = known.count()
    return df.join(F.broadcast(known) if n <= BROADCAST_KEYS else known, key, "left_anti").select(*df.columns)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` whose per-batch function is made once for each task by ``make``.

    Workers are reused by later stages, so a task gives its memory back to the system when it ends. The session's Arrow
    batches are held to ``BATCH_ROWS`` rows from here on, as Spark reads that setting when the plan runs.
    """
    rows, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(rows)) <= BATCH_ROWS:
        conf.set(rows, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        batch = part = None
        try:
            for batch in batches:
                for part in by_bytes(batch):
                    yield f(part)
        finally:
            f = batch = part = None
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory of this process to the system, as far as the platform's allocator can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def by_bytes(batch: pa.RecordBatch, most: int = 4_000_000) -> Iterable[pa.RecordBatch]:
    """Slices of a batch, each of about ``most`` bytes or of one row, so that a few long texts don't add up."""
    n, size = batch.num_rows, max(1, batch.nbytes)
    step = max(1, min(n, n * most // size)) if n else 1
    for i in range(0, n, step):
        yield batch.slice(i, step)
