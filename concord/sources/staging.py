"""Tables written to the cluster's shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local: list[str] = []
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only where the setting is absent, as in tests."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local:
        folder = tempfile.TemporaryDirectory(prefix="concord-")
        atexit.register(folder.cleanup)
        _local.append(folder.name)
    return _local[0]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    It stays for as long as its readers may need it; everything is below ``<checkpoint dir>/<application id>``, which
    can be deleted once the application has ended.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    # nothing reads this job's shuffles once the table is there
    before = spark.conf.get(SHUFFLES, "false")
    spark.conf.set(SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES, before)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def unstaged(table: DataFrame) -> None:
    """Delete a table that ``staged`` gave, once nothing reads it any more; other DataFrames are left alone."""
    path = _paths.pop(table, None)
    if path:
        spark = table.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
