"""Reading the tables of a data folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data folder, as Spark plans it: no columns are dropped, no rows are cut."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in `spark.checkpoint.dir`. Only where that is unset and the master is local, as in tests, a new
    temporary folder is taken; on a cluster each machine would write to its own disk, so it is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not folder and not re.fullmatch(r"local(?:\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    folder = folder or "file://" + tempfile.mkdtemp(prefix="spark-gristmill-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder and read back: cuts lineage, and survives the loss of an executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the shared checkpoint folder, read back by columns: for what is large and read more than once."""
    folder = f"{checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def spread(df: DataFrame, *columns: str, least: int = 1) -> DataFrame:
    """`df` in as many partitions as the session shuffles to, at least `least`: for few rows that mean much work each, which adaptive execution would put into one task."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), least), *columns)
