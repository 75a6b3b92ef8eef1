"""Cutting lineage on storage all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder the session names in spark.checkpoint.dir; where none is set, a temporary one in local mode, as in tests.

    On a cluster a machine's own folder would be lost with it, so there a missing setting raises.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="phonoloom-"))


def settle(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint: computed once, surviving the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_table(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a table written below the checkpoint folder, and its path for ``discard``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str | None) -> None:
    """Deletes a table of ``settle_table`` nothing reads any more."""
    if path:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
