"""Queries of the sequence operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sequences as S
from ..sources import views
from ..sources.views import sql

# window starts: a running maximum of the ends, then the last opening at or before each row
_WIN = """also f as (select *, max(e) over (partition by sid order by s, idx rows between unbounded preceding and 1 preceding) as far from seg),
o as (select *, max(case when far is null or s - far > 6000 then s end) over (partition by sid order by s, idx rows unbounded preceding) as win from f),
"""
_TURN = """n as (select sid, idx, s, e, win, q, coalesce(spk, '') as spk from o),
t0 as (select *, case when lag(spk) over w = spk and lag(win) over w = win then 0 else 1 end as new from n window w as (partition by sid order by s, idx)),
t1 as (select *, sum(new) over (partition by sid order by s, idx rows unbounded preceding) as run from t0),
turn as (select sid, win, spk, run, min(s) as turn_start, arg_max(e, (s, idx)) as turn_end, count(*) as n_seg from t1 group by sid, win, spk, run),
"""


def _seg(spark, d):
    return views.segments(spark, d).select("sid", "idx", "s", "e", "spk", "q", "lang", "txt")


def f1_gap_windows(spark, d):
    return S.gap_windows(_seg(spark, d)).groupBy("sid", "win").agg(F.max("e").alias("win_end"), F.count(F.lit(1)).alias("n_seg")).withColumnRenamed("win", "win_start")


def f2_turns(spark, d):
    return S.turns(S.gap_windows(_seg(spark, d).withColumn("spk", F.coalesce("spk", F.lit("")))))


def f3_capped_units(spark, d):
    return S.capped_units(_seg(spark, d))


def f4_long_chunks(spark, d):
    return S.long_chunks(_seg(spark, d))


def f6_union_length(spark, d):
    return S.union_and_overlap(views.frames(spark, d), ["sid"]).select("sid", "union_ms")


def f7_overlap_coverage(spark, d):
    return S.union_and_overlap(views.frames(spark, d), ["sid"]).select("sid", "overlap_ms")


def f8_label_runs(spark, d):
    return S.label_runs(_seg(spark, d), "lang")


def f13_rate_deltas(spark, d):
    return S.rate_deltas(_seg(spark, d), "q")


def f16_speaker_tags(spark, d):
    return S.speaker_tags(S.gap_windows(_seg(spark, d).withColumn("spk", F.coalesce("spk", F.lit(""))))).withColumnRenamed("win", "win_start")


def f17_cut_windows(spark, d):
    return S.cut_windows(_seg(spark, d))


def f20_transcript(spark, d):
    return S.transcript(S.gap_windows(_seg(spark, d).withColumn("spk", F.coalesce("spk", F.lit("")))))


def f21_turn_counts(spark, d):
    return f2_turns(spark, d).groupBy("sid").agg(F.count(F.lit(1)).alias("n_turns"), F.countDistinct("win").alias("n_windows"))


def f22_numbering(spark, d):
    w = f1_gap_windows(spark, d)
    return S.numbered(w, ["sid"], "win_start", "D").select("sid", "win_start", "name", "batch")


def f24_event_schedule(spark, d):
    r = views.segments(spark, d).groupBy("sid").agg(F.max("e").alias("dur"))
    return r.select("sid", F.explode(S.event_schedule(F.col("dur"))).alias("at_ms"))


def c23_window_gates(spark, d):
    return S.gate_windows(S.window_metrics(_seg(spark, d)))


def e13_window_metrics(spark, d):
    return S.window_metrics(_seg(spark, d))


_METRICS = _WIN + _TURN + """cnt as (select sid, win, spk, count(*) as n, sum(turn_end - turn_start) as span from turn group by all),
rk as (select *, row_number() over (partition by sid, win order by n desc) as r from cnt),
tt as (select sid, win, cast(sum(n) as bigint) as turns, count(*) as speakers, sum(span) as span, max(case when r = 2 then n end) as second from rk group by sid, win),
sp as (select sid, win, max(e) as win_end, count(*) as n_seg, sum(case when q is not null then q * (e - s) end) as qw, sum(case when q is not null then e - s end) as w from n group by sid, win),
pe as (select *, max(e) over (partition by sid, spk order by s, idx rows between unbounded preceding and 1 preceding) as pm from n),
isl as (select *, sum(case when pm is null or s > pm then 1 else 0 end) over (partition by sid, spk order by s, idx rows unbounded preceding) as g from pe),
per as (select sid, spk, g, min(win) as win, min(s) as s, max(e) as e from isl group by sid, spk, g),
ev as (select sid, win, s as t, 1 as v from per union all select sid, win, e, -1 from per),
ev1 as (select sid, win, t, sum(v) as v from ev group by sid, win, t),
ev2 as (select sid, win, t, sum(v) over (partition by sid, win order by t) as depth, lead(t) over (partition by sid, win order by t) as nx from ev1),
ov as (select sid, win, sum(case when depth >= 1 then nx - t else 0 end) as union_ms, sum(case when depth >= 2 then nx - t else 0 end) as overlap_ms from ev2 group by sid, win),
met as (select sp.sid, sp.win as win_start, win_end, n_seg, turns, speakers, round(span / turns, 3) as mean_turn_ms, round(coalesce(second, 0) / turns, 6) as second_share,
  round(qw / w, 4) as mean_q, cast(union_ms as bigint) as union_ms, round(overlap_ms / (win_end - sp.win), 6) as overlap_share
  from sp join tt on sp.sid = tt.sid and sp.win = tt.win join ov on ov.sid = sp.sid and ov.win = sp.win)
"""
_RUNS = """also p as (select *, lag(e) over w as pe, lag({label}) over w as pl, lag(idx) over w as pi from seg window w as (partition by sid order by s, idx)),
r as (select *, sum(case when pi is null or pl is distinct from {label} or s - pe {cmp} then 1 else 0 end) over (partition by sid order by s, idx rows unbounded preceding) as run from p)
"""

ORACLES = {
    "f1_gap_windows": sql(_WIN + "x as (select 1) select sid, win as win_start, max(e) as win_end, count(*) as n_seg from o group by sid, win", "seg"),
    "f2_turns": sql(_WIN + _TURN + "x as (select 1) select sid, win, spk, turn_start, turn_end, n_seg from turn", "seg"),
    "f4_long_chunks": sql(
        _RUNS.format(label="sp", cmp="> 2000").replace("from seg window", "from (select * exclude (spk), coalesce(spk, '') as sp from seg) window")
        + "select sid, any_value(sp) as spk, min(s) as chunk_start, arg_max(e, (s, idx)) as chunk_end, count(*) as n_seg, round(sum(case when q is not null then q * (e - s) end) / sum(case when q is not null then e - s end), 4) as mean_q from r group by sid, run", "seg"),
    "f6_union_length": sql("""also p as (select *, max(e) over (partition by sid order by s, idx, spk rows between unbounded preceding and 1 preceding) as m from frm)
        select sid, cast(sum(greatest(0, e - greatest(s, coalesce(m, s)))) as bigint) as union_ms from p group by sid""", "frm"),
    "f7_overlap_coverage": sql("""also pe as (select *, max(e) over (partition by sid, spk order by s, idx rows between unbounded preceding and 1 preceding) as pm from frm),
        isl as (select *, sum(case when pm is null or s > pm then 1 else 0 end) over (partition by sid, spk order by s, idx rows unbounded preceding) as g from pe),
        per as (select sid, spk, g, min(s) as s, max(e) as e from isl group by sid, spk, g),
        ev as (select sid, t, sum(v) as v from (select sid, s as t, 1 as v from per union all select sid, e, -1 from per) group by sid, t),
        ev2 as (select sid, t, sum(v) over (partition by sid order by t) as depth, lead(t) over (partition by sid order by t) as nx from ev)
        select sid, cast(sum(case when depth >= 2 then nx - t else 0 end) as bigint) as overlap_ms from ev2 group by sid""", "frm"),
    "f8_label_runs": sql(_RUNS.format(label="lang", cmp="> 10000") + "select sid, any_value(lang) as label, min(s) as run_start, arg_max(e, (s, idx)) as run_end, count(*) as n_seg, cast(sum(e - s) as bigint) as speech_ms from r group by sid, run", "seg"),
    "f13_rate_deltas": sql("""also p as (select *, last_value(q ignore nulls) over (partition by sid order by s, idx rows between unbounded preceding and 1 preceding) as b from seg)
        select sid, idx, round(q - b, 3) as delta, case when b <> 0 then round(q / b - 1, 3) end as change from p""", "seg"),
    "f16_speaker_tags": sql(_WIN + _TURN + "fs as (select sid, win, spk, min((s, idx)) as fst from n group by all) select sid, win as win_start, spk, 'S' || row_number() over (partition by sid, win order by fst) as tag from fs", "seg"),
    "f17_cut_windows": sql("""also x as (select *, unnest(range(0, cast(ceil((e - s) / 15000.0) as bigint))) as sub from seg),
        y as (select *, s + sub * 15000 as ws, least(e, s + sub * 15000 + 15000) as we from x)
        select idx, sub, ws as win_s, we as win_e, case when sub = 0 then txt end as txt from y where sub = 0 or we - ws >= 500""", "seg"),
    "f20_transcript": sql(_WIN.replace("from seg)", "from (select * replace (coalesce(spk, '') as spk) from seg))") + """fs as (select sid, win, spk, min((s, idx)) as fst from o group by all),
        tg as (select sid, win, spk, 'S' || row_number() over (partition by sid, win order by fst) as tag from fs),
        j as (select o.*, tag, trim(coalesce(txt, ''), ' ') as t from o join tg on o.sid = tg.sid and o.win = tg.win and o.spk = tg.spk),
        l as (select *, case when lag(tag) over (partition by sid, win order by s, idx) = tag then 0 else 1 end as new from j),
        r as (select *, sum(new) over (partition by sid, win order by s, idx rows unbounded preceding) as run from l),
        ln as (select sid, win, run, '[' || any_value(tag) || '] ' || string_agg(t, ' ' order by s, idx) as line from r where t <> '' group by sid, win, run)
        select sid, win as win_start, string_agg(line, ' ' order by run) as transcript from ln group by sid, win""", "seg"),
    "f21_turn_counts": sql(_WIN + _TURN + "x as (select 1) select sid, count(*) as n_turns, count(distinct win) as n_windows from turn group by sid", "seg"),
    "f22_numbering": sql(_WIN + "w as (select distinct sid, win from o), k as (select *, row_number() over (partition by sid order by win) as k from w) select sid, win as win_start, 'D' || lpad(cast(k - 1 as varchar), cast(greatest(4, length(cast(k - 1 as varchar))) as integer), '0') as name, (k - 1) // 100 + 1 as batch from k", "seg"),
    "f24_event_schedule": sql("""also r as (select sid, max(e) as dur from seg group by sid),
        x as (select sid, dur, unnest(range(30000, dur + 1, 30000)) as t from r where dur > 30000),
        y as (select *, max(t) over (partition by sid) as mx from x)
        select sid, case when t = mx and dur - t < 10000 then greatest(t - 30000 + 15000, dur - 10000) else t end as at_ms from y""", "seg"),
    "e13_window_metrics": sql(_METRICS + "select * from met", "seg"),
    "c23_window_gates": sql(_METRICS + """select *, case when (win_end - win_start) / 1000.0 < 30 then 'too_short' when speakers < 2 then 'one_speaker' when speakers > 6 then 'too_many_speakers'
        when turns < greatest(2, speakers) then 'too_few_turns' when mean_turn_ms >= 60000 then 'avg_turn_too_long' when second_share < 0.15 then 'unbalanced'
        when coalesce(mean_q, 0.0) + 1e-9 < 2.4 then 'low_mean_quality' when overlap_share > 0.05 + 1e-9 then 'overlap_coverage' else 'kept' end as reason from met""", "seg"),
}

QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "cef" and k[1:2].isdigit()}


def f11_label_timeline(spark, d):
    from ..operators import timelines

    return timelines.label_timeline(_seg(spark, d), "lang")


def f12_value_timeline(spark, d):
    from ..operators import timelines

    return timelines.value_timeline(_seg(spark, d), "q")


QUERIES |= {"f11_label_timeline": f11_label_timeline, "f12_value_timeline": f12_value_timeline}
