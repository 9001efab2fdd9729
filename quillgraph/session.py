"""Session helpers: settings, durable lineage cuts and input spreading."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Settings every plan relies on; all are run-time settings, so they can be set on a live session."""
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that lost executors cost no recomputation.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a session whose executors are threads of
    this machine's driver may do without: it gets a temporary folder, taken away when Python ends.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
                raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
            named = tempfile.mkdtemp(prefix="quillgraph-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Repartition a scan of few file splits before Python-heavy work; wide inputs are left as they are."""
    want = df.sparkSession.sparkContext.defaultParallelism * per_core
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
