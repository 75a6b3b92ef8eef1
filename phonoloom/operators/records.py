"""File records, nonverbal rows and selections: the reshaping that ends a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import bucket_of, carry_last, carry_max, carry_previous


def speaker_cuts(frames: DataFrame, longest_ms: int = 30_000, merge_gap_ms: int = 3000, least_ms: int = 500) -> DataFrame:
    """F5. Frames (sid, idx, s, e, spk) in time order: longer ones fall into pieces of ``longest_ms`` and a tail, others join the
    unit before while the speaker is the same, the gap below ``merge_gap_ms`` and the span within ``longest_ms``; a unit's end never shrinks and units below ``least_ms`` are dropped.

    Returns sid, spk, unit_start, unit_end, n. The fold is per stretch without a change of speaker, a long frame or a wide gap to the furthest end so far.
    """
    d = carry_previous(frames.select("sid", "idx", "s", "e", "spk").withColumn("hour", bucket_of(F.col("s"), 3_600_000)), ["sid"], "hour", ["s", "idx"], ["spk"])
    d = carry_max(d, ["sid"], "hour", ["s", "idx"], "e", "far")
    long = F.col("e") - F.col("s") > longest_ms
    opens = ~F.col("has_prev") | ~F.col("prev_spk").eqNullSafe(F.col("spk")) | (F.col("s") - F.col("far") >= merge_gap_ms)
    d = carry_last(d.withColumn("opens", F.when(opens | long, F.struct("s", "idx"))), ["sid"], "hour", ["s", "idx"], "opens", "run")
    lists = d.groupBy("sid", "spk", "run").agg(F.sort_array(F.collect_list(F.struct("s", "idx", "e"))).alias("rows"))
    unit = "named_struct('us', a.us, 'ue', a.ue, 'n', a.n)"
    closed = f"if(a.n > 0, array_append(a.c, {unit}), a.c)"
    # the open unit is carried beside the closed ones; of a long frame the tail stays open
    step = f"""aggregate(rows, named_struct('c', cast(array() as array<struct<us:bigint,ue:bigint,n:bigint>>), 'us', 0L, 'ue', 0L, 'n', 0L), (a, r) ->
        case when a.n > 0 and r.e - a.us <= {longest_ms} and r.s - a.ue < {merge_gap_ms}
             then named_struct('c', a.c, 'us', a.us, 'ue', greatest(a.ue, r.e), 'n', a.n + 1L)
             when r.e - r.s > {longest_ms}
             then named_struct('c', concat({closed}, transform(sequence(0, cast(ceil((r.e - r.s) / {longest_ms}) as int) - 2), k -> named_struct('us', r.s + k * {longest_ms}L, 'ue', r.s + (k + 1) * {longest_ms}L, 'n', 1L))),
                               'us', r.s + (cast(ceil((r.e - r.s) / {longest_ms}) as bigint) - 1L) * {longest_ms}L, 'ue', r.e, 'n', 1L)
             else named_struct('c', {closed}, 'us', r.s, 'ue', r.e, 'n', 1L) end,
        a -> array_append(a.c, {unit}))"""
    u = lists.select("sid", "spk", F.explode(F.expr(step)).alias("u")).select("sid", "spk", F.col("u.us").alias("unit_start"), F.col("u.ue").alias("unit_end"), F.col("u.n").alias("n"))
    return u.where(F.col("unit_end") - F.col("unit_start") >= least_ms)


def without_tags(df: DataFrame, tags: str, drop: Sequence[str], ids: DataFrame | None = None, key: str = "id") -> DataFrame:
    """C18. ``tags`` without the listed ones; rows whose key is in ``ids`` lose all; ``dropped`` counts what went. Null tags stay null."""
    kept = F.filter(tags, lambda t: ~t.isin(*drop))
    d = df
    if ids is not None:
        d = df.join(ids.select(key).distinct().withColumn("__out", F.lit(True)), key, "left")
        kept = F.when(F.col("__out"), F.array().cast("array<string>")).otherwise(kept)
    return d.withColumn("__kept", kept).withColumn("dropped", F.size(tags) - F.size("__kept")).withColumn(tags, F.col("__kept")).drop("__kept", "__out")


def strict_selection(chosen: DataFrame, index: DataFrame, key: str, needed: Sequence[str]) -> DataFrame:
    """D20. The index rows of the chosen keys; a repeated or missing key, or a null in ``needed``, raises before any row is returned."""
    if not chosen.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated {key} in the selection")
    got = chosen.select(key).join(index, key, "left")
    gap = F.lit(False)
    for c in needed:
        gap = gap | F.col(c).isNull()
    if not got.where(gap).isEmpty():
        raise ValueError(f"a selected {key} has no range")
    return got


def synced_spans(target: DataFrame, decisions: DataFrame) -> DataFrame:
    """D17. Spans (sid, s, e, spk, tag) brought in line with review decisions (sid, s, e, spk, verdict, tag) by their whole key:
    keep, drop or replace; a replaced span that is missing is added. Conflicting decisions on one key raise.
    """
    keys = ["sid", "s", "e", "spk"]
    if not decisions.groupBy(*keys).agg(F.countDistinct(F.struct("verdict", F.coalesce("tag", F.lit("")))).alias("n")).where("n > 1").isEmpty():
        raise ValueError("conflicting decisions on one span")
    d = decisions.dropDuplicates(keys).select(*keys, "verdict", F.col("tag").alias("new_tag"))
    j = target.join(d, keys, "full")
    return j.where((F.coalesce("verdict", F.lit("keep")) != "drop") & (F.col("tag").isNotNull() | (F.col("verdict") == "replace"))).select(*keys, F.coalesce("new_tag", "tag").alias("tag"))


def converted(rows: DataFrame, rate: int = 16_000) -> DataFrame:
    """F26. Items (id, s, e, lo, hi) in milliseconds as sample bounds, rounded to the nearest and clamped to their parent [lo, hi]; items outside it or not ending after their start are marked."""
    s, e = F.greatest("s", "lo"), F.least("e", "hi")
    at = lambda ms: F.bround(ms * rate / 1000).cast("long")
    bad = F.when(F.col("e") <= F.col("s"), "empty").when((F.col("s") >= F.col("hi")) | (F.col("e") <= F.col("lo")), "outside")
    return rows.select("id", F.when(bad.isNull(), at(s)).alias("from_sample"), F.when(bad.isNull(), at(e)).alias("to_sample"), bad.alias("problem"))


def unit_texts(units: DataFrame, facts: DataFrame) -> DataFrame:
    """D9. Text of each (sid, unit) whose members (seg_index, s) all have an accepted fact: their non-blank texts in time order; else null."""
    f = facts.where("accepted").groupBy("sid", "seg_index").agg(F.min_by("text", "fact_id").alias("text"))
    j = units.join(f.withColumn("hit", F.lit(1)), ["sid", "seg_index"], "left")
    g = j.groupBy("sid", "unit").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"), F.array_sort(F.collect_list(F.when(F.trim("text") != "", F.struct("s", F.trim("text").alias("t"))))).alias("ts"))
    return g.select("sid", "unit", "n", F.when(F.col("n") == F.col("hits"), F.array_join(F.transform("ts", lambda x: x["t"]), " ")).alias("text"))
