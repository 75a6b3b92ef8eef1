"""P8: records of several sources in target shares, by hierarchical budgets and seeded epochs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

BUCKETS = 4096


@dataclass
class Leaf:
    """A source: its place in the tree, share of the total, and the most tokens it can give."""

    path: tuple[str, ...]
    share: float
    most: float
    budget: float = field(default=0.0)


def budgets(leaves: Sequence[Leaf], total: float) -> None:
    """Sets every leaf's budget: its share of ``total``, at most what it can give.

    What a leaf lacks goes to its siblings in proportion to their shares while they can give more,
    what all of them lack to the next ancestor's other leaves, and so on to the root. Shares need not
    sum to one. If all leaves together can't reach their total, each gives what it can.
    """
    for x in leaves:
        x.budget = min(x.share * total, x.most)
    depth = max((len(x.path) for x in leaves), default=0)
    for level in range(depth - 1, -1, -1):
        nodes: dict[tuple[str, ...], list[Leaf]] = {}
        for x in leaves:
            nodes.setdefault(x.path[:level], []).append(x)
        for group in nodes.values():
            lack = sum(x.share for x in group) * total - sum(x.budget for x in group)
            while lack > 1e-6 * max(total, 1):
                able = [x for x in group if x.most - x.budget > 1e-9 * max(total, 1) and x.share > 0]
                if not able:
                    break
                weight = sum(x.share for x in able)
                given = 0.0
                for x in able:
                    more = min(x.most - x.budget, lack * x.share / weight)
                    x.budget += more
                    given += more
                lack -= given
                if given <= 0:
                    break


def leaf_sizes(sized: DataFrame) -> DataFrame:
    """(source, domain, language, size, documents): tokens of each source, and the domain and language most of them are in; ties go to the greatest name."""
    per = sized.where("source is not null").groupBy("source", F.coalesce("domain", F.lit("none")).alias("domain"), F.coalesce("language", F.lit("und")).alias("language")).agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    most = lambda c: per.groupBy("source", c).agg(F.sum("t").alias("t")).groupBy("source").agg(F.max_by(c, F.struct("t", c)).alias(c))
    return per.groupBy("source").agg(F.sum("t").alias("size"), F.sum("n").alias("documents")).join(most("domain"), "source").join(most("language"), "source")


def plan(sized: DataFrame, targets: DataFrame) -> list[tuple]:
    """Rows (source, domain, language, size, target_share, max_repeats, budget, short) of the sources in ``targets``.

    ``sized`` has source, domain, language and tokens; ``targets`` has a row per source and comes to the
    driver; sources that have no documents get size 0. A source is short if its budget, after all
    that was moved, stays below its share.
    """
    total = sized.agg(F.sum("tokens").alias("t")).first().t or 0
    rows = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).join(leaf_sizes(sized), "source", "left").orderBy("source").collect()
    leaves = [Leaf((r.domain or "none", r.language or "und", r.source), float(r.target_share or 0), float((r["size"] or 0) * (r.max_repeats or 0))) for r in rows]
    budgets(leaves, total)
    return [(r.source, x.path[0], x.path[1], int(r["size"] or 0), x.share, int(r.max_repeats or 0), x.budget, x.budget < x.share * total) for r, x in zip(rows, leaves)]


_PLAN = "source string, domain string, language string, size long, target_share double, max_repeats int, budget double, short boolean"


def select(spark: SparkSession, sized: DataFrame, planned: list[tuple], seed: int = 0) -> DataFrame:
    """(doc_id, source, tokens, times) of the documents used at all.

    A source is used in whole epochs, and the rest of its budget is the longest prefix of one more
    epoch in the order of a seeded hash. The prefix sum is taken over buckets of the hash, so a
    source of any size is never sorted in one task.
    """
    p = spark.createDataFrame(planned, _PLAN).select("source", F.when(F.col("size") > 0, F.floor(F.col("budget") / F.col("size"))).otherwise(0).cast("long").alias("epochs"), "size", "budget")
    p = p.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("size"))
    h = F.xxhash64(F.lit(seed), "epochs", "doc_id")
    d = sized.select("doc_id", "source", "tokens").where("doc_id is not null and source is not null and tokens is not null").join(F.broadcast(p), "source")  # a row per target source
    d = d.withColumn("h", h).withColumn("b", F.pmod(F.shiftright(F.col("h"), 40), F.lit(BUCKETS)))
    sums = d.groupBy("source", "b").agg(F.sum("tokens").alias("t"))
    over = W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("source", "b", F.coalesce(F.sum("t").over(over), F.lit(0)).alias("off"))
    inside = W.partitionBy("source", "b").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    run = d.withColumn("upto", F.sum("tokens").over(inside)).join(offsets, ["source", "b"]).withColumn("upto", F.col("upto") + F.col("off"))
    times = F.col("epochs") + (F.col("upto") <= F.col("rest")).cast("long")
    return run.select("doc_id", "source", "tokens", times.alias("times")).where("times > 0")


def report(spark: SparkSession, chosen: DataFrame, planned: list[tuple]) -> DataFrame:
    """Per source: domain, language, size, target_share, max_repeats, used tokens, actual_share, most_times and whether it falls short."""
    used = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("used"), F.max("times").alias("most_times"))
    r = spark.createDataFrame(planned, _PLAN).join(used, "source", "left").withColumn("used", F.coalesce("used", F.lit(0)))
    all_used = F.sum("used").over(W.partitionBy(F.lit(1)))  # one row per target source
    return r.select("source", "domain", "language", "size", "target_share", "max_repeats", "used", F.when(all_used > 0, F.col("used") / all_used).otherwise(0.0).alias("actual_share"), F.coalesce("most_times", F.lit(0)).alias("most_times"), "short")


def checked(spark: SparkSession, chosen: DataFrame, planned: list[tuple]) -> DataFrame:
    """source, within_repeats, within_budget, met: 1 where no document is used too often, the budget isn't exceeded, and all of it but less than the
    largest document of the source is used."""
    used = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("__used"), F.max("times").alias("__times"), F.max("tokens").alias("__big"))
    p = spark.createDataFrame(planned, _PLAN).join(used, "source", "left").na.fill(0, ["__used", "__times", "__big"])  # a row per target source
    big = chosen.agg(F.max("tokens").alias("__top"))  # one row
    near = F.col("__used") > F.col("budget") - F.greatest("__big", F.coalesce("__top", F.lit(0))) - 1
    return p.join(F.broadcast(big)).select(
        "source", (F.col("__times") <= F.col("max_repeats")).cast("int").alias("within_repeats"), (F.col("__used") <= F.col("budget") + 1e-6).cast("int").alias("within_budget"), near.cast("int").alias("met")
    )
