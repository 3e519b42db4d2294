"""Tables written once per session and read by many queries.

A dashboard refresh asks some thirty questions of the same five case results. Recomputing
the joins for each would multiply the work; a cached frame would be lost with its executors.
A Parquet table in the shared folder survives them and keeps column and partition pruning.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_paths: dict[tuple[str, str], tuple[str, StructType]] = {}
_folders: dict[tuple[str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, or one in the warehouse, which it shares as well."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch").rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the files in a data folder and its tables, so that changed data is told apart."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    seen = []
    for status in system.listStatus(root) if system.exists(root) else []:
        inside = system.listStatus(status.getPath()) if status.isDirectory() else [status]
        seen += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in inside]
    return hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()[:16]


def staged_folder(spark: SparkSession, name: str, write: Callable[[str], None], of: str) -> str:
    """A folder of this name that ``write`` fills on first use in this application, and anew once the files of ``of`` change."""
    key = (spark.sparkContext.applicationId, f"{name}:{fingerprint(spark, of)}")
    if key not in _folders:
        path = scratch_folder(spark, "folder")
        write(path)
        _folders[key] = path
    return _folders[key]


def staged(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = (), of: str | None = None
) -> DataFrame:
    """Read back the table of this name, writing it on first use in this application.

    ``of`` is the data folder that the table is made from: once its files change, the table is written anew. It goes when
    the driver's JVM ends.
    """
    key = (spark.sparkContext.applicationId, name if of is None else f"{name}:{fingerprint(spark, of)}")
    if key not in _paths:
        path = scratch_folder(spark, "table")
        df = build()
        df.write.partitionBy(*partition_by).parquet(path, compression="zstd")
        _paths[key] = (path, df.schema)
    path, schema = _paths[key]
    return spark.read.schema(schema).parquet(path)
