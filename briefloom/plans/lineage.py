"""Cutting lineage through tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import logging
import os
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: All tables not yet removed; and, by thread, those of the queries that the thread builds.
_all: dict[str, SparkSession] = {}
_own = threading.local()
_log = logging.getLogger(__name__)


def _mine() -> list[str]:
    if not hasattr(_own, "paths"):
        _own.paths = []
    return _own.paths


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary one only where none is set and
    driver and executors are one process (tests).  A cluster without one is an error:
    its executors would write to their own disks."""
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not known:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="briefloom-")
        sc.setCheckpointDir(known)
    return known.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks that read the table,
    not the work that made it.  The files go when the driver ends, or with
    ``release`` as soon as nothing reads them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _all[path] = spark
    _mine().append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point in time of this thread for ``release``."""
    return len(_mine())


def release(since: int, *keep: DataFrame) -> None:
    """Remove the tables that this thread stored after ``since``, but for those that ``keep`` reads."""
    files = " ".join(f for df in keep for f in df.inputFiles())
    paths = _mine()
    for path in paths[since:]:
        if path.rsplit("/", 1)[-1] not in files:
            _delete(_all.pop(path), path)
            paths.remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _remove() -> None:
    while _all:
        path, spark = _all.popitem()
        here = path.removeprefix("file://")
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
            elif os.path.isdir(here):  # the session ended before
                shutil.rmtree(here)
            else:
                _log.warning("left in place: %s", path)
        except Exception as e:  # noqa: BLE001  the others are still to go
            _log.warning("not removed: %s (%s)", path, e)


def sequence_ids(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with a long ``name`` = 1, 2, 3, ... in ``order`` (columns; a total order).

    Rows are range-partitioned and numbered in their partitions; the offsets come
    from one count a partition, so no task sees all rows.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = stored(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()), name)
    counts = parts.groupBy(F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    heads = counts.select("__p", before.alias("__before"))
    inside = F.row_number().over(W.partitionBy("__part").orderBy(*order))
    out = parts.withColumn("__in", inside).join(F.broadcast(heads), F.col("__part") == F.col("__p"))  # a row a partition
    return out.withColumn(name, F.col("__before") + F.col("__in")).drop("__part", "__in", "__p", "__before")
