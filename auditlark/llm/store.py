"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
_local: dict[str, str] = {}
_owners: list[str] = []
_written: list[tuple[str, str, str | None]] = []   # owner, path, name in the catalog


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session without one makes its own."""
    folder = spark.conf.get(KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{KEY} must name a folder that driver and executors share")
    if KEY not in _local:
        _local[KEY] = "file://" + tempfile.mkdtemp(prefix="auditlark-shared-")
    return _local[KEY]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there, and it survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _note(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As ``written``, bucketed by ``key`` so that a later join on it does not shuffle this side."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{table}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).format("parquet").saveAsTable(table)
    _note(path, table)
    return spark.table(table)


def _note(path: str, table: str | None = None) -> None:
    if _owners:
        _written.append((_owners[-1], path, table))


@contextlib.contextmanager
def owned(owner: str) -> Iterator[None]:
    """Tables written meanwhile belong to ``owner``, which may release them."""
    _owners.append(owner)
    try:
        yield
    finally:
        _owners.pop()


def release(owner: str, still_read: DataFrame) -> None:
    """Delete the owner's tables, except those that ``still_read`` reads."""
    spark = still_read.sparkSession
    live = still_read.inputFiles()
    for entry in [e for e in _written if e[0] == owner]:
        _, path, table = entry
        if any(path.removeprefix("file://") in f for f in live):
            continue
        _written.remove(entry)
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
