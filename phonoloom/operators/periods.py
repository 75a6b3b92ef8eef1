"""P5: overlapping, nested, touching and gapped intervals per entity into periods and gaps.

Starts and ends of an entity are ranked independently. With k intervals begun and k ended the
entity is silent, so a gap lies between the k-th end and the (k+1)-th start exactly where the start
is later than the end. An end of rank k closes a period where only k starts come up to it, and a
start of rank k + 1 opens one where k ends come before it; the boundaries left over pair up in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .lineage import settle
from .ordered import bucket_of, millis

HOUR_MS = 3_600_000


def interval_rows(df: DataFrame, entity: Sequence[str], row_key: Sequence[str], start: str, end: str) -> DataFrame:
    """Valid intervals once each: entity, ``s`` and ``e`` in milliseconds.

    Rows with a null or blank entity part, a null, NaN or infinite time, or an end at or before the
    start are ignored; rows repeating ``row_key`` count once (the least (s, e) is kept).
    """
    named = F.lit(True)
    for c in entity:
        named = named & F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    keyed = df.where(named).select(*{*entity, *row_key}, F.struct(millis(F.col(start)).alias("s"), millis(F.col(end)).alias("e")).alias("__t"))
    keyed = keyed.where("__t.s is not null and __t.e > __t.s")
    # row_key's rows are equal in all that counts, so entity can ride in the key: one shuffle less
    once = keyed.groupBy(*dict.fromkeys([*entity, *row_key])).agg(F.min("__t").alias("__t"))
    return once.select(*entity, F.col("__t.s").alias("s"), F.col("__t.e").alias("e"))


def periods_and_gaps(df: DataFrame, entity: Sequence[str], bucket_ms: int = HOUR_MS) -> DataFrame:
    """From (entity, s, e) rows: entity, ``kind``, ``start_ms``, ``end_ms``, ``n`` (intervals; null for gaps).

    Empty input gives an empty result; touching intervals join; equal intervals count each. Boundaries are
    shuffled once, into buckets of an entity's time; ranks are counts inside a bucket plus those of the
    buckets before, and only a bucket's totals and its first boundary cross its border.
    """
    entity = list(entity)
    both = F.explode(F.array(F.struct(F.col("s").alias("t"), F.lit(0).alias("side")), F.struct(F.col("e").alias("t"), F.lit(1).alias("side")))).alias("x")
    ev = df.select(*entity, both).select(*entity, "x.t", "x.side").withColumn("__b", bucket_of(F.col("t"), bucket_ms)).repartition(*entity, "__b")
    # a start comes before an end of the same time: touching intervals join
    inside = W.partitionBy(*entity, "__b").orderBy("t", "side")
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    ranked = ev.withColumn("ks", F.sum(1 - F.col("side")).over(upto)).withColumn("ke", F.sum("side").over(upto))
    before = W.partitionBy(*entity).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    totals = ranked.groupBy(*entity, "__b").agg(F.max("ks").alias("ns"), F.max("ke").alias("ne"))
    earlier = totals.select(*entity, "__b", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("ns", "ne")])
    ranks = ranked.join(earlier, [*entity, "__b"]).select(*entity, "__b", "t", "side", (F.col("ks") + F.col("ns")).alias("ks"), (F.col("ke") + F.col("ne")).alias("ke"))
    # n: intervals ended by then
    bounds = settle(ranks.where("(side = 0 and ks = ke + 1) or (side = 1 and ke = ks)").select(*entity, "__b", "t", "side", F.col("ke").alias("n")))
    row = F.struct("t", "side", "n")
    after = bounds.groupBy(*entity, "__b").agg(F.min(row).alias("__first"))
    after = after.select(*entity, "__b", F.lead("__first").over(W.partitionBy(*entity).orderBy("__b")).alias("__after"))
    nxt = F.coalesce(F.lead(row).over(inside), F.col("__after"))
    # starts and ends alternate: an opening start is followed by its end, an end by the start after the gap
    pairs = bounds.join(after, [*entity, "__b"]).withColumn("__next", nxt).where("__next is not null")
    period = F.col("side") == 0
    return pairs.select(
        *entity, F.when(period, "period").otherwise("gap").alias("kind"), F.col("t").alias("start_ms"), F.col("__next.t").alias("end_ms"), F.when(period, F.col("__next.n") - F.col("n")).alias("n")
    )
