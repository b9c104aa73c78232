"""Fixpoints over DataFrames: transitive closure and joint closure of rules, by semi-naive rounds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rounds after which a fixpoint is given up; each round at least doubles the length of paths that are known.
MOST_ROUNDS = 64


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir``; deleted when the driver's JVM ends.

    Where the setting is missing, a local session (as in tests) gets a temporary folder; on a cluster that is an error.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not known:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        known = "file://" + tempfile.gettempdir()
    folder = f"{known.rstrip('/')}/lattik-rounds-{context.applicationId}"
    if folder not in _FOLDERS:
        where = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
        _FOLDERS.add(folder)
    return folder


_FOLDERS: set[str] = set()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that the plan doesn't grow with the rounds."""
    path = f"{shared_dir(df.sparkSession)}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reach(edges: DataFrame, s: str = "s", o: str = "o") -> DataFrame:
    """Pairs joined by one or more edges; ends on cycles too. Paths double in length each round; only new pairs are extended."""
    known = cut(edges.select(F.col(s).alias("s"), F.col(o).alias("o")).where("s IS NOT NULL AND o IS NOT NULL").distinct())
    delta = known
    for _ in range(MOST_ROUNDS):
        left = delta.join(known.select(F.col("s").alias("o"), F.col("o").alias("e")), "o").select("s", F.col("e").alias("o"))
        right = known.join(delta.select(F.col("s").alias("o"), F.col("o").alias("e")), "o").select("s", F.col("e").alias("o"))
        delta = cut(left.union(right).distinct().join(known, ["s", "o"], "left_anti"))
        if delta.isEmpty():
            return known.select(F.col("s").alias(s), F.col("o").alias(o))
        known = cut(known.union(delta))
    raise RuntimeError(f"no fixpoint after {MOST_ROUNDS} rounds")


def fixpoint(base: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame], key: list[str]) -> DataFrame:
    """Rows of ``base`` and all that ``step(known, delta)`` derives from them, again and again until nothing is new."""
    known = cut(base.dropDuplicates(key))
    delta = known
    for _ in range(MOST_ROUNDS):
        delta = cut(_new(step(known, delta), known, key))
        if delta.isEmpty():
            return known
        known = cut(known.unionByName(delta))
    raise RuntimeError(f"no fixpoint after {MOST_ROUNDS} rounds")


def _new(rows: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """Distinct rows that aren't known; nulls in the key are equal."""
    old = known.select(*(F.col(k).alias(f"_{k}") for k in key))
    on = None
    for k in key:
        same = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = same if on is None else on & same
    return rows.dropDuplicates(key).join(old, on, "left_anti")


def list_members(triples: DataFrame) -> DataFrame:
    """``list, member``: what lists that are given as ``rdf:first`` and ``rdf:rest`` triples hold, by each of their cells as head."""
    first = triples.where("p = 'rdf:first'").select(F.col("s").alias("cell"), F.col("o").alias("member"))
    rest = triples.where("p = 'rdf:rest' AND o <> 'rdf:nil'").select("s", "o")
    steps = reach(rest).select(F.col("s").alias("list"), F.col("o").alias("cell"))
    return steps.unionByName(first.select(F.col("cell").alias("list"), "cell")).join(first, "cell").select("list", "member").distinct()
