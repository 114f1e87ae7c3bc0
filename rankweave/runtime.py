"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """Size of the files that a DataFrame reads; 0 if it reads none, or parts of a checkpoint alone."""
    spark = df.sparkSession
    conf = spark._jsc.hadoopConfiguration()
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)) for file in df.inputFiles()]
    return sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths)


def shared_folder(spark: SparkSession) -> str:
    """Checkpoint folder that all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    one gets a temporary folder, since there driver and executors share a disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Write a DataFrame to the shared folder and cut its lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame as Parquet to the shared folder and read it back.

    Unlike a checkpoint it is compressed whatever the settings, and later reads
    take only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like ``stored``, in buckets by ``key``: joins and sums by it read the table in place, without an exchange.

    Rows are sorted by the key alone: sorting them by the number of the bucket first, which most rows of a task share, is
    slow. Only tables of the catalog have buckets. The data lies in the shared folder, and ``forget`` removes both.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{table}"
    df.sortWithinPartitions(key).write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(table)
    result = spark.table(table)
    result.stored_at, result.stored_as = path, table
    return result


def forget(table: DataFrame) -> None:
    """Remove a table that ``stored`` or ``bucketed`` wrote; nothing may read it any more."""
    spark = table.sparkSession
    if hasattr(table, "stored_as"):
        spark.sql(f"DROP TABLE IF EXISTS {table.stored_as}")
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of each job go when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
