"""Keyed, interval and nearest joins. Interval joins meet in time bins of an equality key, never as a cross product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .lineage import settle
from .ordered import bucket_of, carry_last, carry_previous, ranged_rank

BIN = 60_000


def binned(df: DataFrame, s: str, e: str, width: int = BIN) -> DataFrame:
    """One row per time bin that [s, e) touches, in column ``bin``; an interval's rows are bounded by its length."""
    return df.withColumn("bin", F.explode(F.sequence(bucket_of(F.col(s), width), bucket_of(F.greatest(F.col(e) - 1, F.col(s)), width))))


def overlaps(a: DataFrame, b: DataFrame, keys: Sequence[str], width: int = BIN) -> DataFrame:
    """Pairs of overlapping intervals of equal ``keys``: a has as, ae, b has bs, be. Each pair once, in the bin where the overlap begins."""
    both = binned(a, "as", "ae", width).join(binned(b, "bs", "be", width), [*keys, "bin"])
    return both.where("as < be and bs < ae").where(F.col("bin") == bucket_of(F.greatest("as", "bs"), width)).drop("bin")


def iou(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """I13. Intersection over union of two intervals."""
    inter = F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))
    return inter / F.greatest(F.lit(1e-9), F.greatest(e1, e2) - F.least(s1, s2))


def best_overlap(members: DataFrame, shorts: DataFrame, least: float = 0.5) -> DataFrame:
    """D10. For each member (sid, a_idx, as, ae) the short (b_idx, bs, be) of the greatest IoU, the earliest at ties, where it reaches ``least``."""
    p = overlaps(members, shorts, ["sid"]).withColumn("iou", F.round(iou(F.col("as"), F.col("ae"), F.col("bs"), F.col("be")), 9))
    best = p.groupBy("sid", "a_idx").agg(F.max(F.struct("iou", (-F.col("bs")).alias("nb"), (-F.col("b_idx")).alias("ni"))).alias("x"))
    return best.where(F.col("x.iou") >= least).select("sid", "a_idx", (-F.col("x.ni")).alias("b_idx"), F.col("x.iou").alias("iou"))


def orphans(members: DataFrame, shorts: DataFrame, most: float = 0.1) -> DataFrame:
    """D11. Shorts of which less than ``most`` is overlapped by every single member."""
    p = overlaps(members, shorts, ["sid"]).withColumn("part", (F.least("ae", "be") - F.greatest("as", "bs")) / (F.col("be") - F.col("bs")))
    return shorts.join(p.where(F.col("part") >= most).select("sid", "b_idx").distinct(), ["sid", "b_idx"], "left_anti")


def nearest_label(segs: DataFrame, label: str) -> DataFrame:
    """D12. Fills a null label from the labelled segment with the nearest midpoint, the earlier at ties: sid, idx, label, source.

    Looks back and ahead in midpoint order through hour buckets; a recording without labels keeps null.
    """
    d = segs.select("sid", "idx", ((F.col("s") + F.col("e"))).alias("mid2"), label).withColumn("hour", bucket_of(F.col("mid2"), 7_200_000))
    d = d.withColumn("back", F.when(F.col(label).isNotNull(), F.struct("mid2", label)))
    d = carry_last(d, ["sid"], "hour", ["mid2", "idx"], "back", "before")
    d = d.withColumn("nmid", -F.col("mid2")).withColumn("nidx", -F.col("idx")).withColumn("nhour", -F.col("hour"))
    d = carry_last(d, ["sid"], "nhour", ["nmid", "nidx"], "back", "after")
    db, da = F.col("mid2") - F.col("before.mid2"), F.col("after.mid2") - F.col("mid2")
    near = F.when(F.col("after").isNull() | (db <= da), F.col(f"before.{label}")).otherwise(F.col(f"after.{label}"))
    return d.select("sid", "idx", F.coalesce(F.col(label), near).alias("label"), F.when(F.col(label).isNotNull(), "own").when(near.isNotNull(), "nearest").alias("source"))


def filled_labels(segs: DataFrame, label: str, containers: DataFrame) -> DataFrame:
    """D12. ``nearest_label``, and where a recording has no label at all the only language its container (sid, languages) declares: sid, idx, label, source
    (own, nearest, container; null where no rung gives one)."""
    one = containers.where("size(languages) = 1").groupBy("sid").agg(F.min(F.col("languages")[0]).alias("__one"))
    d = nearest_label(segs, label).join(one, "sid", "left")
    sole = F.col("label").isNull() & F.col("__one").isNotNull()
    return d.select("sid", "idx", F.coalesce("label", "__one").alias("label"), F.when(sole, "container").otherwise(F.col("source")).alias("source"))


def conflicts(frames: DataFrame, over_ms: int = 2000, part: float = 0.4) -> DataFrame:
    """D14. Overlapping frame pairs in the order (start, -end, idx), and which side is dropped: overlap above ``over_ms`` or ``part`` of it."""
    a = frames.select("sid", F.col("idx").alias("a"), F.col("s").alias("as"), F.col("e").alias("ae"))
    b = frames.select("sid", F.col("idx").alias("b"), F.col("s").alias("bs"), F.col("e").alias("be"))
    p = overlaps(a, b, ["sid"]).where(F.struct("as", -F.col("ae"), "a") < F.struct("bs", -F.col("be"), "b"))
    over = F.least("ae", "be") - F.greatest("as", "bs")
    hit = lambda s, e: ((over > over_ms) | (over > part * (F.col(e) - F.col(s)))).cast("int")
    return p.select("sid", "a", "b", over.alias("over_ms"), hit("as", "ae").alias("drop_a"), hit("bs", "be").alias("drop_b"))


def broken_gaps(segs: DataFrame, breaks: DataFrame) -> DataFrame:
    """D15. Gaps between a segment and the one before (sid, idx, gap_s, gap_e) that a pause intersects."""
    d = carry_previous(segs.withColumn("hour", bucket_of(F.col("s"), 3_600_000)), ["sid"], "hour", ["s", "idx"], ["e"])
    gaps = d.where("has_prev and s > prev_e").select("sid", "idx", F.col("prev_e").alias("as"), F.col("s").alias("ae"))
    hit = overlaps(gaps, breaks.where("hi > lo").select("sid", F.col("lo").alias("bs"), F.col("hi").alias("be")), ["sid"])
    return hit.select("sid", "idx", F.col("as").alias("gap_s"), F.col("ae").alias("gap_e")).distinct()


def at_point(points: DataFrame, segs: DataFrame) -> DataFrame:
    """D13. For each point (sid, p, t) the shortest segment that contains it (ends included), the lowest idx at ties."""
    a = points.select("sid", "p", F.col("t").alias("as"), (F.col("t") + 1).alias("ae"))
    b = segs.select("sid", F.col("idx").alias("b"), F.col("s").alias("bs"), (F.col("e") + 1).alias("be"))
    got = overlaps(a, b, ["sid"])
    return got.groupBy("sid", "p").agg(F.min_by("b", F.struct(F.col("be") - F.col("bs"), "b")).alias("idx"))


def at_or_nearest(points: DataFrame, segs: DataFrame) -> DataFrame:
    """D13. ``at_point`` for points inside a segment; any other point takes the segment with the nearest endpoint, the lowest idx
    at ties: sid, p, idx, source (inside, nearest). Points of recordings without segments give no row.

    Endpoints before and after are carried through hour buckets.
    """
    inside = settle(at_point(points, segs))
    ends = segs.select("sid", F.explode(F.array("s", "e")).alias("t"), "idx").groupBy("sid", "t").agg(F.min("idx").alias("i"))
    ends = ends.select("sid", "t", F.lit(None).cast(points.schema["p"].dataType).alias("p"), F.struct("t", "i").alias("end"))
    gaps = points.join(inside, ["sid", "p"], "left_anti").select("sid", "t", "p", F.lit(None).cast(ends.schema["end"].dataType).alias("end"))
    d = settle(ends.unionByName(gaps).withColumn("hour", bucket_of(F.col("t"), 3_600_000)))
    before = carry_last(d, ["sid"], "hour", ["t"], "end", "before").where("p is not null").select("sid", "p", "t", "before")
    d = d.withColumn("nt", -F.col("t")).withColumn("nhour", -F.col("hour"))
    after = carry_last(d, ["sid"], "nhour", ["nt"], "end", "after").where("p is not null").select("sid", "p", "after")
    d = before.join(after, ["sid", "p"]).where("before is not null or after is not null")
    # nulls are left out by the least
    near = F.least(*[F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("t") - F.col(c)["t"]).alias("far"), F.col(c)["i"].alias("i"))) for c in ("before", "after")])
    return inside.withColumn("source", F.lit("inside")).unionByName(d.select("sid", "p", near["i"].alias("idx"), F.lit("nearest").alias("source")))


def merged(base: DataFrame, stage: DataFrame, key: str, partial: bool = True) -> DataFrame:
    """D1. Left 1:1 join of a stage's results onto its input; repeated keys on either side, results for unknown
    keys, or (unless ``partial``) missing results raise before any row is returned."""
    for name, side in (("input", base), ("stage", stage)):
        if not side.groupBy(key).count().where("count > 1").isEmpty():
            raise ValueError(f"repeated {key} in the {name}")
    if not stage.join(base, key, "left_anti").isEmpty():
        raise ValueError(f"results for an unknown {key}")
    if not partial and not base.join(stage, key, "left_anti").isEmpty():
        raise ValueError(f"a {key} without result")
    return base.join(stage, key, "left")


def divided(units: DataFrame, facts: DataFrame, unit: Sequence[str], member: Sequence[str]) -> DataFrame:
    """D8. Units all of whose members have a fact (relational division); counts of members."""
    flagged = units.join(facts.select(*member).distinct().withColumn("hit", F.lit(1)), list(member), "left")
    g = flagged.groupBy(*unit).agg(F.count(F.lit(1)).alias("members"), F.count("hit").alias("hits"))
    return g.where("members = hits").select(*unit, "members")


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """H2. One row per key: the first in ``order`` (not whichever arrives)."""
    rest = [c for c in df.columns if c not in key]
    g = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return g.select(*key, *[F.col("__r")[c].alias(c) for c in rest])


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A3, H3. One row per key: the last in ``order``."""
    rest = [c for c in df.columns if c not in key]
    g = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return g.select(*key, *[F.col("__r")[c].alias(c) for c in rest])


def applied_delta(base: DataFrame, changes: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """B5. ``base`` with rows replaced by id and removed by id; ids absent from the base raise."""
    for d in (changes, removed):
        if not d.join(base, key, "left_anti").isEmpty():
            raise ValueError(f"the delta names a {key} that the base doesn't have")
    kept = base.join(removed.select(key), key, "left_anti").join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes)


def gathered(parts: Sequence[DataFrame], base: DataFrame, key: str) -> DataFrame:
    """H8. The rows of all parts, each with ``position``, its key's place in the order of keys; unless the parts hold exactly the keys of ``base``, each once, it raises.

    The order is taken over ranges of the key, not in one task.
    """
    got = parts[0]
    for p in parts[1:]:
        got = got.unionByName(p)
    got = settle(got)
    whole = got.groupBy(key).count().where("count > 1").isEmpty() and got.join(base, key, "left_anti").isEmpty() and base.join(got, key, "left_anti").isEmpty()
    if not whole:
        raise ValueError(f"the parts don't hold every {key} of the input once")
    return ranged_rank(got, [], [F.asc(key)], "position")


def checked_delta(base: DataFrame, changes: DataFrame, removed: DataFrame, key: str, expected: str | None = None, result: str | None = None) -> tuple[DataFrame, int, int]:
    """B5. ``applied_delta`` behind checks: (rows, number in, number out).

    ``expected`` and ``result`` are fingerprints (``sinks.fingerprint``) the base must have and the result must come to. A
    repeated key in the base, in the changes or among the removed, a key both changed and removed, or numbers that don't add up raise.
    """
    from ..sources.sinks import fingerprint

    base = settle(base)
    for name, d in (("base", base), ("changes", changes), ("removals", removed)):
        if not d.groupBy(key).count().where("count > 1").isEmpty():
            raise ValueError(f"repeated {key} in the {name}")
    if not changes.join(removed, key, "left_semi").isEmpty():
        raise ValueError(f"a {key} is both changed and removed")
    if expected and fingerprint(base) != expected:
        raise ValueError("the base is not the one the delta was made for")
    out = settle(applied_delta(base, changes, removed, key))
    before, after = base.count(), out.count()
    if after != before - removed.count():
        raise ValueError(f"{before} rows became {after}")
    if result and fingerprint(out) != result:
        raise ValueError("the result is not the one the delta names")
    return out, before, after


def ranked_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key; a partial rank in each input partition comes first, so a hot key never gathers whole."""
    local = W.partitionBy(*keys, F.spark_partition_id()).orderBy(*order)
    few = df.withColumn("__r", F.row_number().over(local)).where(F.col("__r") <= k).drop("__r")
    return few.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def overlaid(base: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """D3. Left join in which every field of ``side`` takes the place of the base's where the key has a row there, null or not;
    fields only ``side`` has are null elsewhere; ``overlaid`` tells which rows were met. Keys of ``side`` must not repeat."""
    fields = [c for c in side.columns if c != key]
    j = base.join(side.select(key, F.struct(*fields).alias("__new")), key, "left")
    met = F.col("__new").isNotNull()
    cols = [F.when(met, F.col("__new")[c]).otherwise(F.col(c) if c in base.columns else F.lit(None)).alias(c) for c in fields]
    return j.select(*[c for c in base.columns if c not in fields], *cols, met.alias("overlaid"))
