"""Writes that are whole or absent, guarded appends, and fingerprints of their input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import settle


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """B2. Writes beside the table, then swaps by two renames; safe where ``df`` reads ``path``.

    A write that fails leaves the table as it was. The old rows are deleted last: a rename that fails puts them
    back and raises. Between the renames the path is absent for a moment; a reader never sees part of a table.
    """
    fs, Path = _fs(df.sparkSession, path)
    tag = uuid.uuid4().hex[:8]
    new, old = f"{path.rstrip('/')}.new-{tag}", f"{path.rstrip('/')}.old-{tag}"
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(new)
    except Exception:
        fs.delete(Path(new), True)
        raise
    was = fs.exists(Path(path))
    if was and not fs.rename(Path(path), Path(old)):
        fs.delete(Path(new), True)
        raise OSError(f"{path} can't be moved aside")
    if not fs.rename(Path(new), Path(path)):
        if was:
            fs.rename(Path(old), Path(path))
        fs.delete(Path(new), True)
        raise OSError(f"{path} can't be replaced; its old rows are back")
    if was:
        fs.delete(Path(old), True)


def _files(fs, Path, path: str) -> set[str]:
    """Data files directly in a folder."""
    return {f.getPath().toString() for f in fs.listStatus(Path(path)) if f.isFile()} if fs.exists(Path(path)) else set()


def guarded_append(df: DataFrame, path: str, key: str) -> int:
    """B4. Appends rows whose keys are new and returns their number; repeated keys in the batch or keys already in the table raise and nothing is written.

    The batch is settled once. A lock file beside the table lets one writer in, another raises. The rows are counted after the
    write; a count that doesn't add up takes the new files back and raises. For tables without partition folders.
    """
    spark = df.sparkSession
    fs, Path = _fs(spark, path)
    lock = Path(f"{path.rstrip('/')}.lock")
    batch = settle(df)
    if not batch.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated {key} in the batch")
    try:
        fs.create(lock, False).close()
    except Exception as e:
        raise RuntimeError(f"{path} is being appended to: {lock.toString()}") from e
    try:
        before, held = _files(fs, Path, path), 0
        if before:
            table = spark.read.parquet(path)
            if not batch.join(table.select(key), key, "left_semi").isEmpty():
                raise ValueError(f"a {key} of the batch is in the table already")
            held = table.count()
        n = batch.count()
        try:
            batch.write.mode("append").parquet(path)
            if spark.read.schema(batch.schema).parquet(path).count() != held + n:
                raise OSError(f"{path} does not hold {held} + {n} rows")
        except Exception:
            for f in _files(fs, Path, path) - before:
                fs.delete(Path(f), False)
            raise
        return n
    finally:
        fs.delete(lock, False)


def fingerprint(df: DataFrame) -> str:
    """J11. Digest of a table's rows whatever their order: count and two sums of row hashes over all columns by name."""
    cols = sorted(df.columns)
    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    r = df.select(F.xxhash64(text).alias("a"), F.crc32(text.cast("binary")).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("a"), F.sum(F.col("b").cast("decimal(38,0)")).alias("b")).first()
    return f"{r.n}-{int(r.a or 0) & 0xFFFFFFFFFFFFFFFF:016x}-{int(r.b or 0):x}"
