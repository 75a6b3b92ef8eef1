"""JSON lines with line numbers, strict and tolerant; tab-separated archive indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1), value of every line.

    Lines are counted per (file, split) and offset by the splits before, so no file is read by one task.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("m"))
    counts = raw.groupBy("file", "at").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    k = F.row_number().over(W.partitionBy("file", "at").orderBy("m"))
    return raw.withColumn("k", k).join(counts.select("file", "at", before.alias("off")), ["file", "at"]).select("file", (F.col("k") + F.col("off")).alias("line_no"), "value")


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, required: tuple[str, ...] = (), strict: bool = True) -> DataFrame:
    """file, line_no and the fields of ``schema`` of each non-blank line.

    Strict: a line that is no JSON object, or lacks a required field (null or empty), raises with the
    first such file and line. Tolerant: such lines are left out.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    full = StructType(list(schema.fields)).add("__bad", "string")
    rows = numbered_lines(spark, path).where(F.trim("value") != "")
    rows = rows.select("file", "line_no", F.from_json("value", full, {"columnNameOfCorruptRecord": "__bad", "mode": "PERMISSIVE"}).alias("j"), F.trim("value").alias("v"))
    wrong = F.col("j").isNull() | F.col("j.__bad").isNotNull() | ~F.col("v").startswith("{")
    for c in required:
        v = F.col("j")[c]
        wrong = wrong | v.isNull() | (v.cast("string") == "")
    if strict:
        first = rows.where(wrong).agg(F.min(F.struct("file", "line_no")).alias("x")).first().x
        if first is not None:
            raise ValueError(f"{first.file}:{first.line_no}: not a JSON object with {', '.join(required) or 'any fields'}")
    return rows.where(~wrong).select("file", "line_no", *[F.col("j")[f.name].alias(f.name) for f in schema.fields])


def first_lines(rows: DataFrame, n: int) -> DataFrame:
    """A2. The first ``n`` lines in file and line order; the limit is the feature."""
    return rows.orderBy("file", "line_no").limit(n)


def done_ids(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """A4. Distinct ids of a result file that may end in a torn line; a missing path gives none."""
    from pyspark.errors import AnalysisException

    try:
        return read_jsonl(spark, path, f"`{key}` string", (key,), strict=False).select(key).distinct()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], f"`{key}` string")
        raise


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """A11. member, offset, size of a tab-separated index; rows without exactly three fields are left out."""
    p = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(p) == 3).select(p[0].alias("member"), p[1].try_cast("long").alias("offset"), p[2].try_cast("long").alias("size"))
    return rows.where("offset is not null and size is not null")
