"""P6: oversized items into pieces under a limit, cut at natural boundaries with a given overlap."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..operators.ordered import bucket_of, millis


def cut(start: int, end: int, pauses: list[tuple[int, int]], limit: int, overlap: int) -> tuple[list[tuple[int, int, bool]], bool]:
    """Pieces (start, end, ends in a hard cut) of one item, and whether any cut had to be hard.

    ``pauses`` lie inside the item, in any order, perhaps overlapping. Neighbouring pieces share exactly
    ``overlap``; a cut is natural where that stretch ends in a pause or, where the next cut would else be
    out of reach, begins in one. In the sorted array of pauses the last one in reach is found by
    binary search, so a cut is hard only where a stretch without pause exceeds the limit, and there
    at the limit. Of the two forms of a natural cut the first is taken unless it costs a
    hard cut or a piece more. The limit must exceed the overlap.
    """
    merged: list[list[int]] = []
    for lo, hi in sorted(pauses):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    step, los = limit - overlap, [lo for lo, _ in merged]

    def last(x: int, off: int) -> int:
        """The last place up to x + step that lies ``off`` before a point of a pause; x if there is none beyond it."""
        i = bisect_right(los, x + step + off) - 1
        return max(x, min(merged[i][1] - off, x + step)) if i >= 0 else x

    def reach(x: int) -> int:
        """The furthest begin of the next piece that a natural cut allows after a piece begun at x; x if there is none."""
        return max(last(x, 0), last(x, overlap))

    def cost(x: int) -> tuple[int, int]:
        hard = n = 0
        while end - x > limit:
            y = reach(x)
            hard, n, x = hard + (y == x), n + 1, x + step if y == x else y
        return hard, n

    pieces, at = [], start
    while end - at > limit:
        y = reach(at)
        if y == at:
            pieces.append((at, at + limit, True))
            at += step
            continue
        inside = last(at, overlap)
        if at < inside < y and cost(inside) <= cost(y):
            y = inside
        pieces.append((at, y + overlap, False))
        at = y
    pieces.append((at, end, False))
    return pieces, any(h for _, _, h in pieces)


def oversized(segments: DataFrame, breaks: DataFrame, limit_ms: int, bucket_ms: int = 60_000) -> DataFrame:
    """Each segment longer than the limit once, with the pauses wholly inside it.

    Null, NaN or reversed ends give no length; repeated rows count once; breaks with a null end are
    ignored. Pauses meet segments by (sid, minute), so a hot recording spreads over its minutes, and
    a list is bounded by the length of one segment.
    """
    items = segments.where("seg_id is not null").select("seg_id", "sid", millis(F.col("start_s")).alias("s"), millis(F.col("end_s")).alias("e")).where(f"e - s > {limit_ms}").dropDuplicates(["seg_id"])
    pauses = breaks.select("sid", millis(F.col("lo")).alias("lo"), millis(F.col("hi")).alias("hi")).where("lo is not null and hi >= lo").distinct().withColumn("b", bucket_of(F.col("lo"), bucket_ms))
    spread = items.withColumn("b", F.explode(F.sequence(bucket_of(F.col("s"), bucket_ms), bucket_of(F.col("e"), bucket_ms))))
    met = spread.join(pauses, ["sid", "b"], "left").withColumn("inside", F.expr("lo >= s and hi <= e"))
    return met.groupBy("seg_id", "sid", "s", "e").agg(F.collect_list(F.when(F.col("inside"), F.struct("lo", "hi"))).alias("pauses"))


def cut_pieces(segments: DataFrame, breaks: DataFrame, limit_ms: int, overlap_ms: int) -> DataFrame:
    """seg_id, sid, piece, start_ms, end_ms, hard_cut, forced_cut: one row per piece of each oversized segment."""
    if not 0 <= overlap_ms < limit_ms:
        raise ValueError("the overlap must be smaller than the limit")
    schema = "seg_id long, sid string, piece int, start_ms long, end_ms long, hard_cut int, forced_cut int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for seg, sid, s, e, ps in zip(b["seg_id"], b["sid"], b["s"], b["e"], b["pauses"]):
                parts, forced = cut(int(s), int(e), [(int(p["lo"]), int(p["hi"])) for p in ps], limit_ms, overlap_ms)
                rows += [(seg, sid, k, x, y, int(h), int(forced)) for k, (x, y, h) in enumerate(parts)]
            if rows:
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return oversized(segments, breaks, limit_ms).mapInPandas(run, schema)


def checked(pieces: DataFrame, breaks: DataFrame, limit_ms: int, overlap_ms: int, bucket_ms: int = 60_000) -> DataFrame:
    """seg_id, start_ms, end_ms, within_limit, overlaps, natural, forced_cut of each cut segment, from the pieces and the pauses anew.

    The three are 1 where every piece is within the limit, neighbours share the overlap, and every cut that is
    not hard has an end in, or its next piece a begin in, a pause.
    """
    nxt = W.partitionBy("seg_id").orderBy("piece")  # a segment's pieces
    p = pieces.withColumn("next_ms", F.lead("start_ms").over(nxt))
    cuts = p.where("next_ms is not null").select("seg_id", "sid", "piece", "hard_cut", "next_ms", F.col("end_ms").alias("cut_ms"))
    pauses = breaks.select("sid", millis(F.col("lo")).alias("lo"), millis(F.col("hi")).alias("hi")).where("lo is not null and hi >= lo").distinct()
    spread = pauses.withColumn("b", F.explode(F.sequence(bucket_of(F.col("lo"), bucket_ms), bucket_of(F.col("hi"), bucket_ms))))
    at = cuts.withColumn("t", F.explode(F.array("cut_ms", "next_ms"))).withColumn("b", bucket_of(F.col("t"), bucket_ms))
    met = at.join(spread, ["sid", "b"]).where("t between lo and hi").select("seg_id", "piece").distinct().withColumn("met", F.lit(1))
    natural = cuts.join(met, ["seg_id", "piece"], "left").groupBy("seg_id").agg(F.min(F.greatest("hard_cut", F.coalesce("met", F.lit(0)))).alias("natural"))
    per = p.groupBy("seg_id").agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.min((F.col("end_ms") - F.col("start_ms") <= limit_ms).cast("int")).alias("within_limit"),
        F.min(F.when(F.col("next_ms").isNotNull(), (F.col("end_ms") - F.col("next_ms") == overlap_ms).cast("int"))).alias("overlaps"), F.max("hard_cut").alias("forced_cut"),
    )
    return per.join(natural, "seg_id").select("seg_id", "start_ms", "end_ms", "within_limit", "overlaps", "natural", "forced_cut")


def limits(size_limits: DataFrame, item: str) -> tuple[float, float | None]:
    """(max_size, overlap_size) of an item from the fixed two-row table."""
    r = size_limits.where(F.col("item") == item).select("max_size", "overlap_size").first()
    return r.max_size, r.overlap_size
