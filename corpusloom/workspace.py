"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Spark's setting by which a query's shuffle files are removed when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local: list[str] = []
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; on a cluster that is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="corpusloom-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once for each application, so that it need not be installed there."""
    sc = spark.sparkContext
    home = Path(__file__).resolve().parent
    if sc.applicationId in _shipped or not home.is_dir():
        return
    _shipped.add(sc.applicationId)
    folder = tempfile.mkdtemp(prefix="corpusloom-code-")  # only the driver reads it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(f"{folder}/corpusloom", "zip", home.parent, home.name))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores before work that is heavy on them; only an input that may lie in fewer parts than cores is shuffled.

    A plain scan says how many parts it has. After a shuffle that would have to be run first, so there the size of what is
    read decides: below one full part for each core, rows may come in fewer.
    """
    spark = df.sparkSession
    ship(spark)
    cores = spark.sparkContext.defaultParallelism
    query = df._jdf.queryExecution()
    if "Exchange" not in query.executedPlan().toString():
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
    leaves = query.optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    part = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.repartition(cores) if read < cores * part else df


class Workspace:
    """Writes tables that cut lineage, and removes those that are no longer read.

    What is left goes when the process ends, or at the end of a ``with`` block, after which nothing made from its tables can be read.
    """

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/corpusloom-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(self.close)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def table(self, df: DataFrame, name: str = "t") -> DataFrame:
        """``df`` as a written table. A lost executor costs only the rows it had not yet written."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        with self._shuffles_removed():
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._corpusloom_path = path
        return out

    @contextmanager
    def _shuffles_removed(self) -> Iterator[None]:
        """What is written here is not shuffled again, so its shuffle files go at once and not when the driver collects its garbage."""
        conf = self.spark.conf
        before = conf.get(_CLEANUP, None)
        conf.set(_CLEANUP, "true")
        try:
            yield
        finally:
            conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = getattr(df, "_corpusloom_path", None)
            if path:
                self._delete(path)

    def close(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # the session is gone
            pass
        atexit.unregister(self.close)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
