"""Warehouse, report and work tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite a partitioned table.

    Rows are first rebalanced by partition: Spark gathers small partitions into few files
    and splits a partition that holds much of the data over several tasks.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a Parquet table at ``path``. One that cannot be opened is an error."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def side_by_side(spark: SparkSession, *steps: Callable, at_once: int = 8) -> list:
    """Results of independent steps whose Spark jobs may overlap; the first failure is raised.

    The last tasks of one job then leave no executor idle while another has work.
    """
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(s)) for s in steps]]


class Workspace:
    """Intermediate tables of one run, written to shared storage and read back.

    They cut lineage: a lost executor costs a re-read, not a recomputation from the exports.
    The folder lies under ``spark.checkpoint.dir`` where the cluster names one, else under
    ``fallback``, and is new for each run.
    """

    def __init__(self, spark: SparkSession, fallback: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or fallback
        self.folder = f"{root.rstrip('/')}/wardbook-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self) -> None:
        """Delete the run's tables; nothing that reads them may run after it."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


_QUERY_TABLES: list[Workspace] = []


def query_workspace(spark: SparkSession) -> Workspace:
    """Work tables of a query whose result is still to be computed, as of all that are not the job's.

    They belong to the session: who has written the results calls ``release_query_tables``. Where
    no ``spark.checkpoint.dir`` is named, only a local session gets a temporary folder; the
    executors of a cluster would each write to their own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("work tables need spark.checkpoint.dir, a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wardbook-")
    _QUERY_TABLES.append(Workspace(spark, folder))
    return _QUERY_TABLES[-1]


def release_query_tables() -> None:
    """Delete the work tables of all queries so far; none of their results may be read after it."""
    while _QUERY_TABLES:
        _QUERY_TABLES.pop().delete()
