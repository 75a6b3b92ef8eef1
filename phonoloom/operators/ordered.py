"""Order-dependent operators that never sort a whole entity in one task.

A never-ending recording can hold a third of all rows, so a window over a bare entity would be one
unbounded task. Rows are put into buckets of a fixed stretch of the ordering value first; the work
is done per (entity, bucket), and only one summary row per bucket crosses bucket borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .lineage import settle


def millis(seconds: Column) -> Column:
    """Seconds as whole milliseconds; null for null, NaN and infinite values."""
    finite = seconds.isNotNull() & ~F.isnan(seconds) & (F.abs(seconds) < F.lit(1e15))
    return F.when(finite, F.round(seconds * 1000).cast("long"))


def bucket_of(ms: Column, width_ms: int) -> Column:
    """Number of the fixed stretch of ``width_ms`` that holds ``ms``."""
    return F.floor(ms / F.lit(width_ms)).cast("long")


def bucketed_rank(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], width: int, out: str) -> DataFrame:
    """Adds ``out``: the 1-based rank of a row among all rows of ``keys`` by (``order``, ``ties``).

    ``order`` is a non-null integer column. The rank is the row number inside the (keys, bucket)
    partition plus the rows in earlier buckets, of which one count per bucket is shuffled by key.
    """
    keys = list(keys)
    b = f"__b_{out}"
    df = df.withColumn(b, bucket_of(F.col(order), width))
    counts = df.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*keys).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*keys, b, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = W.partitionBy(*keys, b).orderBy(order, *ties)
    ranked = df.withColumn("__rn", F.row_number().over(inside)).join(offsets, [*keys, b])
    return ranked.withColumn(out, F.col("__rn") + F.col("__off")).drop("__rn", "__off", b)


def ranged_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Adds ``out``: the 1-based rank of every row of ``keys`` in ``order``, of any type and with as many ties as there are.

    Rows are parted by ranges of (keys, order), so a hot key or value spreads over tasks; a rank is the row number inside
    the range plus the rows of the key in earlier ranges, of which one count per range crosses. ``order`` should end in a unique column.
    """
    keys = list(keys)
    # settled: the number of a range must not change between the counts and the rows
    part = settle(df.repartitionByRange(*keys, *order).withColumn("__p", F.spark_partition_id()))
    before = W.partitionBy(*keys).orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    offsets = part.groupBy(*keys, "__p").agg(F.count(F.lit(1)).alias("__n")).select(*keys, "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = W.partitionBy(*keys, "__p").orderBy(*order)
    return part.withColumn("__rn", F.row_number().over(inside)).join(offsets, [*keys, "__p"]).withColumn(out, F.col("__rn") + F.col("__off")).drop("__rn", "__off", "__p")


def ranged_sum(df: DataFrame, order: str, amount: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``amount`` over all rows before this one in ``order``, 0 for the first; null amounts count 0.

    Rows are parted by ranges of ``order``; only one sum per range crosses. ``order`` should be unique, ties share no defined order.
    """
    part = settle(df.repartitionByRange(order).withColumn("__p", F.spark_partition_id()))
    sums = part.groupBy("__p").agg(F.coalesce(F.sum(amount), F.lit(0)).alias("__s"))
    # a row per range
    offsets = sums.select("__p", F.coalesce(F.sum("__s").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    inside = F.coalesce(F.sum(amount).over(W.partitionBy("__p").orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return part.withColumn("__in", inside).join(offsets, "__p").withColumn(out, F.col("__in") + F.col("__off")).drop("__in", "__off", "__p")


def carry_last(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the last non-null ``value`` at or before the row, across bucket borders.

    Rows must carry ``bucket``, which rises with ``order``.
    """
    keys = list(keys)
    inside = W.partitionBy(*keys, bucket).orderBy(*order)
    local = df.withColumn("__local", F.last(value, True).over(inside.rowsBetween(W.unboundedPreceding, 0)))
    ends = df.where(F.col(value).isNotNull()).groupBy(*keys, bucket).agg(F.max_by(value, F.struct(*order)).alias("__end"))
    # every bucket of the entity, so that those without a value pass the earlier one on
    spine = df.select(*keys, bucket).distinct().join(ends, [*keys, bucket], "left")
    before = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    carried = spine.select(*keys, bucket, F.last("__end", True).over(before).alias("__carried"))
    return local.join(carried, [*keys, bucket]).withColumn(out, F.coalesce("__local", "__carried")).drop("__local", "__carried")


def runs(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: str, first: Sequence[str], top: Sequence[str] = (), joined: Sequence[str] = ()) -> DataFrame:
    """Longest runs of equal ``value`` (null-safe) in ``order`` per ``keys``, across bucket borders.

    Returns keys, ``value``, ``n_rows`` and, for each column c of ``first``, ``first_c`` and
    ``last_c``; the greatest of each column of ``top``; and each string column of ``joined`` in
    ``order``, parted by a space, nulls left out (a run's text is one value, however long). Inner runs of a bucket are final as they are; only the first and the last run of a
    bucket (at most two rows) take part in the second pass over the entity.
    """
    keys = list(keys)
    inside = W.partitionBy(*keys, bucket).orderBy(*order)
    new = (~F.col(value).eqNullSafe(F.lag(value).over(inside))) | F.lag(F.lit(1)).over(inside).isNull()
    pos = F.struct(*[F.col(c) for c in order])

    def strung(c: str, *by: str) -> Column:
        held = F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(*by, F.col(c).alias("__text")))))
        return F.array_join(F.transform(held, lambda x: x["__text"]), " ")

    part = (
        df.withColumn("__new", new.cast("int"))
        .withColumn("__run", F.sum("__new").over(inside.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*keys, bucket, "__run")
        .agg(
            F.first(value).alias(value), F.count(F.lit(1)).alias("n_rows"),
            *[F.min_by(c, pos).alias(f"first_{c}") for c in first],
            *[F.max_by(c, pos).alias(f"last_{c}") for c in first],
            *[F.max(c).alias(c) for c in top], *[strung(c, *order).alias(c) for c in joined],
        )
    )
    last = F.max("__run").over(W.partitionBy(*keys, bucket))
    part = part.withColumn("__edge", (F.col("__run") == 1) | (F.col("__run") == last))
    cols = [*keys, value, "n_rows", *[f"first_{c}" for c in first], *[f"last_{c}" for c in first], *top, *joined]
    inner = part.where(~F.col("__edge")).select(*cols)
    over = W.partitionBy(*keys).orderBy(bucket, "__run")
    same = F.col(value).eqNullSafe(F.lag(value).over(over)) & (F.lag(bucket).over(over) < F.col(bucket))
    at = F.struct(bucket, "__run")
    joined = (
        part.where("__edge")
        .withColumn("__new", F.when(same, 0).otherwise(1))
        .withColumn("__isle", F.sum("__new").over(over.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*keys, "__isle")
        .agg(
            F.first(value).alias(value), F.sum("n_rows").alias("n_rows"),
            *[F.min_by(f"first_{c}", at).alias(f"first_{c}") for c in first],
            *[F.max_by(f"last_{c}", at).alias(f"last_{c}") for c in first],
            *[F.max(c).alias(c) for c in top], *[strung(c, bucket, "__run").alias(c) for c in joined],
        )
    )
    return inner.unionByName(joined.select(*cols))


def carry_max(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the largest ``value`` of all rows before this one in ``order`` per ``keys``; null for the first."""
    keys = list(keys)
    inside = W.partitionBy(*keys, bucket).orderBy(*order)
    local = df.withColumn("__local", F.max(value).over(inside.rowsBetween(W.unboundedPreceding, -1)))
    tops = df.groupBy(*keys, bucket).agg(F.max(value).alias("__top"))
    before = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    carried = tops.select(*keys, bucket, F.max("__top").over(before).alias("__carried"))
    return local.join(carried, [*keys, bucket]).withColumn(out, F.greatest("__local", "__carried")).drop("__local", "__carried")


def carry_previous(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Adds ``prev_<v>`` for each of ``values`` and ``has_prev``: the row before in ``order`` per ``keys``, across bucket borders."""
    keys, values = list(keys), list(values)
    row = F.struct(*values)
    inside = W.partitionBy(*keys, bucket).orderBy(*order)
    ends = df.groupBy(*keys, bucket).agg(F.max_by(row, F.struct(*order)).alias("__end"))
    carried = ends.select(*keys, bucket, F.lag("__end").over(W.partitionBy(*keys).orderBy(bucket)).alias("__carried"))
    got = df.withColumn("__prev", F.lag(row).over(inside)).join(carried, [*keys, bucket])
    got = got.withColumn("__prev", F.coalesce("__prev", "__carried"))
    return got.select(*df.columns, *[F.col("__prev")[v].alias(f"prev_{v}") for v in values], F.col("__prev").isNotNull().alias("has_prev"))
