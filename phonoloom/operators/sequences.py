"""Windows, turns, runs and cuts over time-ordered segments (columns sid, idx, s, e, spk, ... in milliseconds).

All passes over the order go through hour buckets (see ``ordered``), so an endless recording
never becomes one task. Ties of time are broken by idx; empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions.scalars import time_label
from .joins import ranked_within
from .lineage import settle
from .ordered import bucket_of, bucketed_rank, carry_last, carry_max, carry_previous, runs

HOUR = 3_600_000
ORDER = ["s", "idx"]


def hourly(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", bucket_of(F.col("s"), HOUR))


def gap_windows(segs: DataFrame, max_gap_ms: int = 6000) -> DataFrame:
    """F1. Adds ``win``, the start of the window: a new one where the gap to the furthest end so far exceeds ``max_gap_ms``."""
    d = carry_max(hourly(segs), ["sid"], "hour", ORDER, "e", "far")
    d = d.withColumn("opens", F.when(F.col("far").isNull() | (F.col("s") - F.col("far") > max_gap_ms), F.col("s")))
    return carry_last(d, ["sid"], "hour", ORDER, "opens", "win").drop("opens")


def turns(windowed: DataFrame) -> DataFrame:
    """F2. Longest runs of one speaker inside a window: sid, win, spk, turn_start, turn_end, n_seg."""
    d = windowed.withColumn("key", F.struct("win", "spk"))
    r = runs(d.select("sid", "hour", "s", "e", "idx", "key"), ["sid"], "hour", ORDER, "key", ["s", "e"])
    return r.select("sid", F.col("key.win").alias("win"), F.col("key.spk").alias("spk"), F.col("first_s").alias("turn_start"), F.col("last_e").alias("turn_end"), F.col("n_rows").alias("n_seg"))


def union_and_overlap(segs: DataFrame, by: list[str]) -> DataFrame:
    """F6, F7. ``by`` with union_ms and overlap_ms: time covered at all, and by two or more distinct speakers.

    An interval adds what lies beyond the furthest end so far, and to the overlap what lies before
    that end and beyond the furthest point already covered twice. Own overlaps of a speaker are
    merged before.
    """
    own = carry_max(hourly(segs), ["sid", "spk"], "hour", ORDER, "e", "own")
    # what is new of each interval within its speaker; parts already covered add nothing
    own = own.withColumn("s", F.greatest("s", F.coalesce("own", "s"))).where("e > s").select("sid", "spk", "idx", "s", "e", *[c for c in by if c not in ("sid", "spk")])
    # every pass below reads its input twice: settled, the passes add up instead of doubling
    d = carry_max(hourly(settle(own)), ["sid"], "hour", [*ORDER, "spk"], "e", "m1")
    d = d.withColumn("twice", F.when(F.col("m1").isNotNull(), F.least("e", "m1")))
    d = carry_max(settle(d), ["sid"], "hour", [*ORDER, "spk"], "twice", "m2")
    fresh = F.greatest(F.lit(0), F.col("e") - F.greatest("s", F.coalesce("m1", "s")))
    both = F.when(F.col("m1").isNull(), 0).otherwise(F.greatest(F.lit(0), F.col("twice") - F.greatest("s", F.coalesce("m2", "s"))))
    return d.groupBy(*by).agg(F.sum(fresh).alias("union_ms"), F.sum(both).alias("overlap_ms"))


def window_metrics(segs: DataFrame, max_gap_ms: int = 6000) -> DataFrame:
    """E13. Per window: start, end, turns, speakers, mean turn span, share of turns of the second speaker, weighted quality, overlap share."""
    named = settle(segs.select("sid", "idx", "s", "e", "q", F.coalesce("spk", F.lit("")).alias("spk")))
    w = settle(gap_windows(named, max_gap_ms))
    spans = w.groupBy("sid", "win").agg(
        F.max("e").alias("win_end"), F.count(F.lit(1)).alias("n_seg"), F.sum(F.when(F.col("q").isNotNull(), F.col("q") * (F.col("e") - F.col("s")))).alias("qw"),
        F.sum(F.when(F.col("q").isNotNull(), F.col("e") - F.col("s"))).alias("w"),
    )
    t = turns(w).groupBy("sid", "win", "spk").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("turn_end") - F.col("turn_start")).alias("span"))
    by_count = F.sort_array(F.collect_list("n"), asc=False)
    t = t.groupBy("sid", "win").agg(F.sum("n").alias("turns"), F.count(F.lit(1)).alias("speakers"), F.sum("span").alias("span"), F.try_element_at(by_count, F.lit(2)).alias("second"))
    over = union_and_overlap(w.drop("hour"), ["sid", "win"])
    m = spans.join(t, ["sid", "win"]).join(over, ["sid", "win"])
    return m.select(
        "sid", F.col("win").alias("win_start"), "win_end", "n_seg", "turns", "speakers", F.round(F.col("span") / F.col("turns"), 3).alias("mean_turn_ms"),
        F.round(F.coalesce("second", F.lit(0)) / F.col("turns"), 6).alias("second_share"), F.round(F.col("qw") / F.col("w"), 4).alias("mean_q"),
        "union_ms", F.round(F.col("overlap_ms") / (F.col("win_end") - F.col("win")), 6).alias("overlap_share"),
    )


def gate_windows(metrics: DataFrame) -> DataFrame:
    """C23. The first failing gate of each window, in the order of the list; null quality fails its gate."""
    sec = (F.col("win_end") - F.col("win_start")) / 1000
    reason = (
        F.when(sec < 30, "too_short")
        .when(F.col("speakers") < 2, "one_speaker")
        .when(F.col("speakers") > 6, "too_many_speakers")
        .when(F.col("turns") < F.greatest(F.lit(2), F.col("speakers")), "too_few_turns")
        .when(F.col("mean_turn_ms") >= 60000, "avg_turn_too_long")
        .when(F.col("second_share") < 0.15, "unbalanced")
        .when(F.coalesce("mean_q", F.lit(0.0)) + 1e-9 < 2.4, "low_mean_quality")
        .when(F.col("overlap_share") > 0.05 + 1e-9, "overlap_coverage")
        .otherwise("kept")
    )
    return metrics.withColumn("reason", reason)


def _folded_units(segs: DataFrame, max_gap_ms: int, max_span_ms: int) -> DataFrame:
    """The units of ``capped_units`` with the idx each begins with."""
    d = carry_previous(hourly(segs.withColumn("spk", F.coalesce("spk", F.lit("")))), ["sid"], "hour", ORDER, ["spk", "e"])
    opens = ~F.col("has_prev") | (F.col("prev_spk") != F.col("spk")) | (F.col("s") - F.col("prev_e") >= max_gap_ms)
    d = carry_last(d.withColumn("opens", F.when(opens, F.struct("s", "idx"))), ["sid"], "hour", ORDER, "opens", "run")
    rows = F.sort_array(F.collect_list(F.struct("s", "idx", "e")))
    folded = d.groupBy("sid", "spk", "run").agg(rows.alias("rows"))
    # the open unit is carried beside the closed ones, which are only touched when a unit closes
    step = f"""aggregate(rows, named_struct('c', cast(array() as array<struct<us:bigint,ue:bigint,n:bigint,i:bigint>>), 'us', 0L, 'ue', 0L, 'n', 0L, 'i', 0L), (a, r) ->
        if(a.n > 0 and r.e - a.us <= {max_span_ms},
           named_struct('c', a.c, 'us', a.us, 'ue', r.e, 'n', a.n + 1L, 'i', a.i),
           named_struct('c', if(a.n > 0, array_append(a.c, named_struct('us', a.us, 'ue', a.ue, 'n', a.n, 'i', a.i)), a.c), 'us', r.s, 'ue', r.e, 'n', 1L, 'i', cast(r.idx as bigint))),
        a -> array_append(a.c, named_struct('us', a.us, 'ue', a.ue, 'n', a.n, 'i', a.i)))"""
    u = folded.select("sid", "spk", F.explode(F.expr(step)).alias("u"))
    return u.select("sid", "spk", F.col("u.us").alias("unit_start"), F.col("u.ue").alias("unit_end"), F.col("u.n").alias("n_seg"), F.col("u.i").alias("first_idx"))


def capped_units(segs: DataFrame, max_gap_ms: int = 3000, max_span_ms: int = 20_000) -> DataFrame:
    """F3. Greedy merge of neighbouring segments of one speaker: sid, spk, unit_start, unit_end, n_seg.

    A segment joins while the gap to the last segment's end is below ``max_gap_ms`` and the span from
    the unit's start stays within ``max_span_ms``. Only breaks of speaker or gap are fixed points of
    the fold, so rows are folded per such run, which a run of the order bounds, not per recording.
    """
    return _folded_units(segs, max_gap_ms, max_span_ms).drop("first_idx")


def unit_metrics(segs: DataFrame, max_gap_ms: int = 3000, max_span_ms: int = 20_000) -> DataFrame:
    """E15. Per unit of F3: sid, unit_start, n_seg, seconds (of its segments, three places), mean_q (plain mean, three places) and lang,
    the most frequent set and known language in lower case, the first seen at ties."""
    first = _folded_units(segs, max_gap_ms, max_span_ms).select("sid", F.col("first_idx").alias("idx"), F.lit(True).alias("__first"))
    d = hourly(segs).join(first, ["sid", "idx"], "left").withColumn("opens", F.when(F.col("__first"), F.struct("s", "idx")))
    d = carry_last(d, ["sid"], "hour", ORDER, "opens", "unit")
    d = d.withColumn("__l", F.lower(F.trim("lang"))).withColumn("__l", F.when(~F.col("__l").isin("", "unknown"), F.col("__l")))
    votes = d.where("__l is not null").groupBy("sid", "unit", "__l").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("s", "idx")).alias("at"))
    top = votes.groupBy("sid", "unit").agg(F.max(F.struct("n", (-F.col("at.s")).alias("a"), (-F.col("at.idx")).alias("b"), "__l")).alias("x")).select("sid", "unit", F.col("x.__l").alias("lang"))
    g = d.groupBy("sid", "unit").agg(F.count(F.lit(1)).alias("n_seg"), F.round(F.sum(F.col("e") - F.col("s")) / 1000, 3).alias("seconds"), F.round(F.avg("q") + 1e-9, 3).alias("mean_q"))
    return g.join(top, ["sid", "unit"], "left").select("sid", F.col("unit.s").alias("unit_start"), "n_seg", "seconds", "mean_q", "lang")


def long_chunks(segs: DataFrame, max_gap_ms: int = 2000) -> DataFrame:
    """F4, E14. Chunks broken by a change of speaker or a gap to the last end above ``max_gap_ms``: span, members, weighted quality."""
    d = carry_previous(hourly(segs.withColumn("spk", F.coalesce("spk", F.lit("")))), ["sid"], "hour", ORDER, ["spk", "e"])
    opens = ~F.col("has_prev") | (F.col("prev_spk") != F.col("spk")) | (F.col("s") - F.col("prev_e") > max_gap_ms)
    d = carry_last(d.withColumn("opens", F.when(opens, F.struct("s", "idx"))), ["sid"], "hour", ORDER, "opens", "chunk")
    w = F.when(F.col("q").isNotNull(), F.col("e") - F.col("s"))
    g = d.groupBy("sid", "chunk").agg(F.first("spk").alias("spk"), F.max_by("e", F.struct(*ORDER)).alias("chunk_end"), F.count(F.lit(1)).alias("n_seg"), (F.sum(F.col("q") * w) / F.sum(w)).alias("mq"))
    return g.select("sid", "spk", F.col("chunk.s").alias("chunk_start"), "chunk_end", "n_seg", F.round("mq", 4).alias("mean_q"))


def chunk_metrics(segs: DataFrame, max_gap_ms: int = 2000) -> DataFrame:
    """E14. Per long chunk (F4): chunk_start, members (seg_index in order of time), speech_ms, mean_q weighted by speech, evaluated (whether
    any member has a score) and flagged_share, the flagged members' (``flag``) part of the summed speech."""
    d = carry_previous(hourly(segs.withColumn("spk", F.coalesce("spk", F.lit("")))), ["sid"], "hour", ORDER, ["spk", "e"])
    opens = ~F.col("has_prev") | (F.col("prev_spk") != F.col("spk")) | (F.col("s") - F.col("prev_e") > max_gap_ms)
    d = carry_last(d.withColumn("opens", F.when(opens, F.struct("s", "idx"))), ["sid"], "hour", ORDER, "opens", "chunk")
    w = F.col("e") - F.col("s")
    members = F.array_sort(F.collect_list(F.when(F.col("seg_index").isNotNull(), F.struct("s", "idx", "seg_index"))))
    g = d.groupBy("sid", "chunk").agg(
        members.alias("m"), F.sum(w).alias("speech_ms"), F.round(F.sum(F.col("q") * w) / F.nullif(F.sum(F.when(F.col("q").isNotNull(), w)), F.lit(0)), 4).alias("mean_q"),
        (F.count("q") > 0).cast("int").alias("evaluated"), F.round(F.sum(F.when(F.col("flag"), w).otherwise(0)) / F.sum(w), 6).alias("flagged_share"),
    )
    return g.select("sid", F.col("chunk.s").alias("chunk_start"), F.array_join(F.transform("m", lambda x: x["seg_index"]), ",").alias("members"), "speech_ms", "mean_q", "evaluated", "flagged_share")


def with_runs(segs: DataFrame, label: str, max_gap_ms: int = 10_000) -> DataFrame:
    """Adds ``run``, the (s, idx) of the first row of the run of equal ``label`` (null is a label) without a gap to the previous row's end above the limit."""
    d = carry_previous(hourly(segs), ["sid"], "hour", ORDER, [label, "e"])
    opens = ~F.col("has_prev") | ~F.col(f"prev_{label}").eqNullSafe(F.col(label)) | (F.col("s") - F.col("prev_e") > max_gap_ms)
    return carry_last(d.withColumn("opens", F.when(opens, F.struct("s", "idx"))), ["sid"], "hour", ORDER, "opens", "run").drop("opens")


def label_runs(segs: DataFrame, label: str, max_gap_ms: int = 10_000) -> DataFrame:
    """F8. Run-length encoding of a label: sid, label, run_start, run_end, n_seg, speech_ms."""
    d = with_runs(segs, label, max_gap_ms)
    g = d.groupBy("sid", "run").agg(F.first(label).alias("label"), F.max_by("e", F.struct(*ORDER)).alias("run_end"), F.count(F.lit(1)).alias("n_seg"), F.sum(F.col("e") - F.col("s")).alias("speech_ms"))
    return g.select("sid", "label", F.col("run.s").alias("run_start"), "run_end", "n_seg", "speech_ms")


def phase_line(segs: DataFrame, label: str, least_share: float = 0.05, most: int = 6, least_variation: float = 0.15) -> DataFrame:
    """F23, G4. The phases of a label over a recording in one line: ``a (0:05-1:20) > b (1:20-2:00)``; sid, n_phases, line.

    Runs (F8) of at least ``least_share`` of the recording, of which the ``most`` longest are told in order of time (the earlier at ties),
    equal neighbours joined from the first start to the last end. No line where fewer than two are left, or where the label with the most
    speech over all runs holds more than 1 - ``least_variation`` of it.
    """
    r = label_runs(segs, label).where("label is not null")
    held = r.groupBy("sid", "label").agg(F.sum("speech_ms").alias("w")).groupBy("sid").agg((1 - F.max("w") / F.sum("w")).alias("__v"))
    total = segs.groupBy("sid").agg(F.max("e").alias("__end"))
    r = r.withColumn("__len", F.col("run_end") - F.col("run_start")).join(total, "sid").where(F.col("__len") >= F.lit(least_share) * F.col("__end"))
    r = ranked_within(r, ["sid"], [F.desc("__len"), F.asc("run_start")], most)
    w = W.partitionBy("sid").orderBy("run_start")  # at most ``most`` rows
    r = r.withColumn("__new", F.when(F.lag("label").over(w) == F.col("label"), 0).otherwise(1)).withColumn("__g", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    g = r.groupBy("sid", "__g", "label").agg(F.min("run_start").alias("a"), F.max_by("run_end", "run_start").alias("b"))
    line = F.concat("label", F.lit(" ("), time_label(F.col("a")), F.lit("-"), time_label(F.col("b")), F.lit(")"))
    g = g.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("__g", line.alias("t")))).alias("p")).where(F.size("p") >= 2)
    g = g.join(held.where(F.col("__v") >= least_variation), "sid")
    return g.select("sid", F.size("p").alias("n_phases"), F.array_join(F.transform("p", lambda x: x["t"]), " > ").alias("line"))


def rate_deltas(segs: DataFrame, value: str) -> DataFrame:
    """F13. Difference of a value to the last non-null value before it, and the relative change."""
    d = carry_last(hourly(segs).withColumn("pos", F.when(F.col(value).isNotNull(), F.struct("s", "idx", value))), ["sid"], "hour", ORDER, "pos", "upto")
    d = carry_previous(d, ["sid"], "hour", ORDER, ["upto"])
    before = F.col("prev_upto")[value]
    return d.select("sid", "idx", F.round(F.col(value) - before, 3).alias("delta"), F.when(before != 0, F.round(F.col(value) / before - 1, 3)).alias("change"))


def speaker_tags(windowed: DataFrame) -> DataFrame:
    """F16. ``S`` and the rank of a speaker's first appearance in its window: sid, win, spk, tag."""
    first = windowed.groupBy("sid", "win", "spk").agg(F.min(F.struct("s", "idx")).alias("at"))
    return first.select("sid", "win", "spk", F.concat(F.lit("S"), F.row_number().over(W.partitionBy("sid", "win").orderBy("at")).cast("string")).alias("tag"))


def cut_windows(segs: DataFrame, window_ms: int = 15_000, tail_ms: int = 500) -> DataFrame:
    """F17. Segments above the window length cut into windows, a tail below ``tail_ms`` dropped, text only on the first: idx, sub, s, e, txt."""
    n = F.ceil((F.col("e") - F.col("s")) / F.lit(window_ms)).cast("int")
    d = segs.withColumn("sub", F.explode(F.sequence(F.lit(0), n - 1)))
    s = F.col("s") + F.col("sub") * window_ms
    d = d.withColumn("ws", s).withColumn("we", F.least(F.col("e"), s + window_ms))
    d = d.where((F.col("sub") == 0) | (F.col("we") - F.col("ws") >= tail_ms))
    return d.select("idx", F.col("sub").cast("long").alias("sub"), F.col("ws").alias("win_s"), F.col("we").alias("win_e"), F.when(F.col("sub") == 0, F.col("txt")).alias("txt"))


def numbered(rows: DataFrame, keys: list[str], order: str, prefix: str, batch: int = 100) -> DataFrame:
    """F22. Adds ``name`` (prefix and four digits from 0) and ``batch`` per ``keys`` in ``order``."""
    r = bucketed_rank(rows, keys, order, [], HOUR, "k")
    return r.withColumn("name", F.format_string(f"{prefix}%04d", F.col("k") - 1)).withColumn("batch", F.floor((F.col("k") - 1) / batch) + 1).drop("k")


def placed_members(windowed: DataFrame) -> DataFrame:
    """D22. Adds ``place``, the 1-based place of a segment in its window: its rank in the recording less that of the window's first, so a window without end is never one task."""
    d = bucketed_rank(windowed, ["sid"], "s", ["idx"], HOUR, "__rank")
    first = d.groupBy("sid", "win").agg(F.min("__rank").alias("__first"))
    return d.join(first, ["sid", "win"]).withColumn("place", F.col("__rank") - F.col("__first") + 1).drop("__rank", "__first")


def kept_turns(windowed: DataFrame, tolerance_ms: int = 50) -> DataFrame:
    """I28. Adds ``kept``: false for a reused segment (``status``) that ends more than ``tolerance_ms`` after its window's ``win_end``."""
    return windowed.withColumn("kept", (F.col("status") != "reuse") | (F.col("e") <= F.col("win_end") + tolerance_ms))


def transcript(windowed: DataFrame) -> DataFrame:
    """F20. One text per window: runs of one speaker tag joined, text-less ones omitted: ``[S1] a b [S2] c``.

    Runs are built in hour buckets; only a window's finished lines meet in one row. Windows without text give no row.
    """
    tagged = windowed.join(speaker_tags(windowed), ["sid", "win", "spk"])
    d = tagged.select("sid", "hour", "s", "idx", F.struct("win", "tag").alias("key"), F.nullif(F.trim("txt"), F.lit("")).alias("t"))
    r = runs(d, ["sid"], "hour", ORDER, "key", ["s", "idx"], joined=["t"]).where("t <> ''")
    line = F.concat(F.lit("["), F.col("key.tag"), F.lit("] "), F.col("t"))
    g = r.groupBy("sid", F.col("key.win").alias("win_start")).agg(F.array_sort(F.collect_list(F.struct("first_s", "first_idx", line.alias("line")))).alias("rs"))
    return g.select("sid", "win_start", F.array_join(F.transform("rs", lambda x: x["line"]), " ").alias("transcript"))


def event_schedule(duration_ms: Column, every: int = 30_000, room: int = 10_000, least: int = 15_000) -> Column:
    """F24. Target times every ``every``; a last one closer than ``room`` to the end moves to the later of the one before + ``least`` and the end - ``room``."""
    base = F.when(duration_ms > every, F.sequence(F.lit(every), duration_ms, F.lit(every))).otherwise(F.array().cast("array<bigint>"))
    last = F.try_element_at(base, F.lit(-1))
    moved = F.greatest(last - every + least, duration_ms - room)
    return F.when(F.size(base) > 0, F.when(duration_ms - last < room, F.concat(F.slice(base, 1, F.size(base) - 1), F.array(moved))).otherwise(base)).otherwise(base)
