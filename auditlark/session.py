"""Session defaults and materialisation of shared intermediate results."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "auditlark", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small result once that several later plans read.

    With ``spark.checkpoint.dir`` it is checkpointed there, so it survives lost executors and no later plan repeats the scan behind it;
    without such a folder it is persisted at first use.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: the one of ``spark.checkpoint.dir``, else the warehouse of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return folder.rstrip("/")
