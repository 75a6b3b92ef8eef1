"""Queries of units, restricted posteriors, overlays and transcripts of cut windows, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import scalars as X
from ..operators import folds as A
from ..operators import joins as J
from ..operators import rules as R
from ..operators import sequences as S
from ..operators import verdicts as V
from ..operators.ordered import millis
from ..sources import views
from ..sources.tables import table
from ..sources.views import sql
from . import rule_queries as Q
from . import fold_queries, join_queries, sequence_queries, verdict_queries


def c3_transcript_verdict(spark, d):
    f = R.with_repetition(views.facts(spark, d).select("fact_id", "sid", "seg_index", "text", "language", "accepted"), "text")
    j = f.join(views.segments(spark, d).select("sid", "seg_index", "s", "e", "q", F.col("lang").alias("lid")), ["sid", "seg_index"])
    both = L.is_dialect(F.col("language")) & L.lid_is_dialect(F.col("lid"))
    return j.select("fact_id", V.transcript_verdict(F.col("text"), F.col("language"), F.col("accepted"), (F.col("e") - F.col("s")) / 1000, F.col("q"), F.col("lid"), F.col("repeated"), both).alias("reason"))


def c14_label_gate(spark, d):
    c = F.try_element_at("extra", F.lit("lid_confidence")).try_cast("double")
    label, sure = R.gated_label(F.col("language"), c, 0.6)
    return views.facts(spark, d).select("fact_id", label.alias("label"), sure.alias("confidence"))


def c15_collapse_marks(spark, d):
    # what was heard of a row against the text of its segment, which begins at the same time
    nv = views.nv_rows(spark, d).where("nv_tags is not null and rel_start is not null").select("id", F.col("rec").alias("sid"), millis(F.col("rel_start")).alias("s"), "nv_tags", "nv_text")
    j = nv.join(views.segments(spark, d).select("sid", "s", "txt"), ["sid", "s"], "left")
    heard, _ = X.split_tags(F.col("nv_text"))
    d_ = j.withColumn("ratio", X.length_ratio(heard, F.col("txt")))
    return d_.select("id", "ratio", F.when((F.size("nv_tags") > 0) & (F.col("ratio") < 0.6), F.array_join(F.array_sort(F.array_distinct("nv_tags")), ",")).alias("collapsed"))


def c22_window_hopes(spark, d):
    w = S.gap_windows(verdict_queries._status(spark, d).select("sid", "idx", "s", "e", "status"))
    part = lambda k: F.sum(F.when(F.col("status") == k, F.col("e") - F.col("s")).otherwise(0)).alias(k)
    g = w.groupBy("sid", "win").agg(part("reuse"), part("skip"), part("fill"))
    share = F.col("reuse") / (F.col("reuse") + F.col("skip") + F.col("fill"))
    return g.select("sid", F.col("win").alias("win_start"), "reuse", "skip", "fill", ((share < 0.05) & (F.col("skip") > F.col("fill"))).cast("int").alias("hopeless"))


def d2_gated_merge(spark, d):
    # a segment's label from its lowest fact, where the gate lets it through
    f = views.facts(spark, d).select("sid", "seg_index", "fact_id", "language", F.try_element_at("extra", F.lit("lid_confidence")).try_cast("double").alias("c"))
    f = J.first_wins(f, ["sid", "seg_index"], ["fact_id"])
    label, sure = R.gated_label(F.col("language"), F.col("c"), 0.5)
    s = views.segments(spark, d).select("idx", "sid", "seg_index")
    return s.join(f.select("sid", "seg_index", label.alias("label"), sure.alias("confidence")), ["sid", "seg_index"], "left").select("idx", "label", "confidence")


def d12_filled_languages(spark, d):
    r = J.last_wins(table(spark, d, "recordings").where("sid is not null").select("sid", "languages", "ingested_at"), ["sid"], ["ingested_at"])
    return J.filled_labels(views.segments(spark, d).select("sid", "idx", "s", "e", "lang"), "lang", r).select("idx", "label", "source")


def e21_edge_drift(spark, d):
    n = F.coalesce(X.char_count(F.col("txt")), F.lit(0))
    s = views.segments(spark, d).withColumn("rate", X.speech_rate(n, (F.col("e") - F.col("s")) / 1000))
    return A.drifted_edges(A.speed_edges(s, "lang", "rate"), L.SPEED_EDGES)


def h7_owners(spark, d):
    # rows of a known record go with it, others by their own id
    m = views.manifest(spark, d).where("id is not null").select("id", "parent_id")
    known = views.records(spark, d).where("id is not null").select(F.col("id").alias("parent_id"), F.lit(True).alias("known"))
    return m.join(known, "parent_id", "left").select("id", X.crc_shard(F.when(F.col("known"), F.col("parent_id")).otherwise(F.col("id")), 16).alias("shard"))


def h8_gathered(spark, d):
    m = views.manifest(spark, d).where("id is not null").select("id", "parent_id")
    sharded = m.select("id", X.crc_shard(F.coalesce("parent_id", "id"), 4).alias("shard"))
    return J.gathered([sharded.where(F.col("shard") == k) for k in range(4)], m, "id").select("id", "shard", "position")


def i8_rates(spark, d):
    s, sec = views.segments(spark, d), (F.col("e") - F.col("s")) / 1000
    return s.select("idx", F.round(X.text_rate(F.col("txt"), sec), 1).alias("text_cps"), F.round(X.heard_rate(F.col("txt"), sec), 1).alias("heard_cps"))


def c25_restricted_posterior(spark, d):
    # what a recording's segments are in, restricted to the languages it declares
    s = views.segments(spark, d).where("lang is not null and lang <> ''")
    per = s.groupBy("sid", "lang").agg(F.sum(F.col("e") - F.col("s")).alias("w"))
    declared = J.last_wins(table(spark, d, "recordings").where("sid is not null").select("sid", "languages", "ingested_at"), ["sid"], ["ingested_at"]).select("sid", "languages")
    return A.restricted(per.join(declared, "sid", "left"), ["sid"], "lang", "w", "languages")


def d3_caption_overlay(spark, d):
    m = views.manifest(spark, d).where("id is not null").select("id", "parent_id", "txt", "lang")
    c = table(spark, d, "documents").where("kind = 'caption' and text is not null and parent_id is not null").select("parent_id", "doc_id", "text", "lang", "source", "n_chars", "created_at")
    c = J.first_wins(c, ["parent_id"], ["doc_id"])
    return J.overlaid(m, c.select("parent_id", F.col("text").alias("txt"), "lang", "source", "n_chars", "created_at"), "parent_id").select("id", "txt", "lang", "source", "n_chars", F.col("overlaid").cast("int").alias("captioned"))


def e15_unit_metrics(spark, d):
    return S.unit_metrics(views.segments(spark, d))


def e26_tag_enrichment(spark, d):
    # how often rows with a tag pass against rows without it
    nv = views.nv_rows(spark, d).where("nv_tags is not null").select("nv_tags", (F.size(F.coalesce("nv_verified", F.array().cast("array<string>"))) > 0).cast("int").alias("ok"))
    return A.enriched(nv, "nv_tags", "ok")


def f15_split_windows(spark, d):
    st = verdict_queries._status(spark, d).select("sid", "idx", "s", "e", "spk", "q", "status")
    role = F.when(F.col("status") == "reuse", "OK").when(F.col("status") == "skip", "BREAK").otherwise("SILENCE")
    return V.split_windows(S.gap_windows(st).withColumn("role", role))


def _entries(spark, d):
    """What each transcript says of its segment's language, with the detector's confidence and the rest as another label."""
    f = views.facts(spark, d).select("fact_id", "sid", "seg_index", "language", F.try_element_at("extra", F.lit("lid_confidence")).try_cast("double").alias("c")).where("language is not null and c is not null")
    j = f.join(views.segments(spark, d).select("sid", "seg_index", "s", "e"), ["sid", "seg_index"])
    both = F.explode(F.array(F.struct(F.col("language").alias("label"), F.col("c").alias("p")), F.struct(F.lit("other").alias("label"), (1 - F.col("c")).alias("p"))))
    return j.select("sid", F.col("fact_id").alias("row"), (F.col("e") - F.col("s")).alias("w"), both.alias("x")).select("sid", "row", "w", "x.label", "x.p")


def e4_weighted_posterior(spark, d):
    return A.posterior_fold(_entries(spark, d), ["sid"])


def e5_summed_labels(spark, d):
    return A.accent_fold(_entries(spark, d), ["sid"], F.struct("row", "label"))


def e7_file_summary(spark, d):
    s = views.segments(spark, d)
    r = J.last_wins(table(spark, d, "recordings").where("sid is not null").select("sid", "duration", "ingested_at"), ["sid"], ["ingested_at"])
    return A.file_summary(s, r, S.label_runs(s, "lang"))


def f23_phase_line(spark, d):
    return S.phase_line(views.segments(spark, d), "spk")


def e14_chunk_metrics(spark, d):
    s = views.segments(spark, d).select("sid", "idx", "seg_index", "s", "e", "spk", "q", (F.trim(F.coalesce("txt", F.lit(""))) == "").alias("flag"))
    return S.chunk_metrics(s)


def e20_view_hours(spark, d):
    m = views.manifest(spark, d).where("source_member is not null and rel_end > rel_start")
    view = F.when(F.contains("source_member", F.lit("_long_")), "long").when(F.contains("source_member", F.lit("_dlg_")), "dialogue").otherwise("short")
    ms = F.round((F.col("rel_end") - F.col("rel_start")) * 1000).cast("long")
    return A.view_hours(m.select(F.coalesce(F.nullif(F.trim("lang"), F.lit("")), F.lit("unknown")).alias("lang"), view.alias("view"), ms.alias("ms")), least_hours=0.05)


def e6_speaker_fold(spark, d):
    s = views.segments(spark, d).where("spk is not null")
    first = S.speaker_tags(s.withColumn("win", F.lit(0))).select("sid", "spk", "tag")
    voices = views.records(spark, d).where("speakers is not null").select(F.col("id").alias("sid"), F.explode("speakers").alias("tag", "v")).select("sid", "tag", F.col("v.gender").alias("gender"))
    voices = J.first_wins(voices, ["sid", "tag"], ["gender"])
    return A.speaker_fold(s, first.join(voices, ["sid", "tag"], "left").select("sid", "spk", "gender"))


def i28_cut_transcripts(spark, d):
    st = verdict_queries._status(spark, d).select("sid", "idx", "s", "e", "spk", "txt", "status")
    w = S.gap_windows(st)
    own = F.max(F.when(F.col("status") != "reuse", F.col("e")))
    ends = w.groupBy("sid", "win").agg(F.coalesce(own, F.max("e")).alias("win_end"))
    kept = S.kept_turns(w.join(ends, ["sid", "win"]))
    dropped = kept.groupBy("sid", "win").agg(F.sum((~F.col("kept")).cast("int")).alias("dropped")).select("sid", F.col("win").alias("win_start"), "dropped")
    return dropped.join(S.transcript(kept.where("kept")), ["sid", "win_start"], "left").select("sid", "win_start", "dropped", "transcript")


_WIN = "f as (select *, max(e) over (partition by sid order by s, idx rows between unbounded preceding and 1 preceding) as far from {0}), o as (select *, max(case when far is null or s - far > 6000 then s end) over (partition by sid order by s, idx rows unbounded preceding) as win from f)"
# greedy units, row by row: the unit is named by the rank of its first row
_UNITS = "with recursive seg as (" + views.SQL["seg"] + """), n as (select sid, coalesce(spk, '') as spk, idx, s, e, q, lang, row_number() over (partition by sid order by s, idx) as r from seg),
    u as (select sid, spk, s as us, e as ue, r, r as unit from n where r = 1
      union all select n.sid, n.spk, case when n.spk = u.spk and n.s - u.ue < 3000 and n.e - u.us <= 20000 then u.us else n.s end, n.e, n.r, case when n.spk = u.spk and n.s - u.ue < 3000 and n.e - u.us <= 20000 then u.unit else n.r end from u join n on n.sid = u.sid and n.r = u.r + 1)"""
_ENT = "also c as (select fact_id, sid, seg_index, language, try_cast(extra['lid_confidence'] as double) as c from fac where language is not null and try_cast(extra['lid_confidence'] as double) is not null), j as (select c.sid, fact_id as row, e - s as w, language, c from c join seg on seg.sid = c.sid and seg.seg_index = c.seg_index), en as (select sid, row, w, language as label, c as p from j union all select sid, row, w, 'other', 1 - c from j)"
_CUTS = "with recursive frm as (" + views.SQL["frm"] + """), n as (select sid, spk, s, e, row_number() over (partition by sid order by s, idx) as r from frm),
    u as (select sid, spk, case when e - s > 30000 then s + (cast(ceil((e - s) / 30000.0) as bigint) - 1) * 30000 else s end as us, e as ue, s, r, r as unit from n where r = 1
      union all select n.sid, n.spk, case when n.e - n.s <= 30000 and n.spk = u.spk and n.e - u.us <= 30000 and n.s - u.ue < 3000 then u.us when n.e - n.s > 30000 then n.s + (cast(ceil((n.e - n.s) / 30000.0) as bigint) - 1) * 30000 else n.s end,
        case when n.e - n.s <= 30000 and n.spk = u.spk and n.e - u.us <= 30000 and n.s - u.ue < 3000 then greatest(u.ue, n.e) else n.e end, n.s, n.r, case when n.e - n.s <= 30000 and n.spk = u.spk and n.e - u.us <= 30000 and n.s - u.ue < 3000 then u.unit else n.r end from u join n on n.sid = u.sid and n.r = u.r + 1),
    t as (select sid, spk, unit, min(us) as unit_start, max(ue) as unit_end, count(*) as n from u group by sid, spk, unit),
    x as (select n.sid, n.spk, n.s, n.e, unnest(range(0, cast(ceil((n.e - n.s) / 30000.0) as bigint) - 1)) as k from n join u on u.sid = n.sid and u.r = n.r where n.e - n.s > 30000)
    select sid, spk, unit_start, unit_end, n from t where unit_end - unit_start >= 500 union all select sid, spk, s + k * 30000, s + (k + 1) * 30000, 1 from x"""
ORACLES = {
    "c3_transcript_verdict": sql("also " + Q._REP + ", h as (select fac.*, repeated, seg.q, lower(trim(coalesce(seg.lang, ''))) as lid, (e - s) / 1000.0 as sec, " + Q._CH.format("text") + " as ch from fac join rep using (fact_id) join seg on seg.sid = fac.sid and seg.seg_index = fac.seg_index) select fact_id, case when trim(coalesce(text, '')) = '' and coalesce(language, '') = '' then 'no_result' when not coalesce(accepted, false) then 'lang' when repeated >= 0.8 then 'asr_repetition' when ch < 2 then 'text' when language in ('zh', 'en') and lid not in ('zh', 'en') and (q is null or q < 3.0) then 'post_asr_zh_en' when not coalesce(" + Q._RATIO.format(sec="sec", ch="ch", lang="language") + ", false) then 'ratio' end as reason from h", "fac", "seg"),
    "c25_restricted_posterior": sql("also r as (select sid, arg_max_null(languages, ingested_at) as ok from recordings where sid is not null group by sid), p as (select sid, lang, sum(e - s) as w from seg where lang is not null and lang <> '' group by all), k as (select p.*, case when list_contains(coalesce(ok, []), lang) then w else 0 end as kw from p left join r using (sid)), t as (select *, sum(kw) over (partition by sid) as kt, sum(w) over (partition by sid) as wt from k) select sid, lang, round(case when kt > 0 then kw / kt else w / wt end, 6) as share from t where kt = 0 or kw > 0", "seg"),
    "d3_caption_overlay": sql("also c as (select distinct on (parent_id) parent_id, text, lang, source, n_chars from documents where kind = 'caption' and text is not null and parent_id is not null order by parent_id, doc_id) select id, case when c.parent_id is null then txt else c.text end as txt, case when c.parent_id is null then man.lang else c.lang end as lang, source, n_chars, case when c.parent_id is null then 0 else 1 end as captioned from man left join c on c.parent_id = man.parent_id where id is not null", "man"),
    "e15_unit_metrics": _UNITS + ", m as (select u.sid, u.unit, n.s, n.e, n.q, n.idx, lower(trim(n.lang)) as l from u join n on n.sid = u.sid and n.r = u.r), v as (select sid, unit, l, count(*) as c, min((s, idx)) as fst from m where l is not null and l not in ('', 'unknown') group by all), t as (select distinct on (sid, unit) sid, unit, l from v order by sid, unit, c desc, fst), g as (select sid, unit, min(s) as unit_start, count(*) as n_seg, round(sum(e - s) / 1000.0, 3) as seconds, round(avg(q) + 1e-9, 3) as mean_q from m group by sid, unit) select g.sid, unit_start, n_seg, seconds, mean_q, t.l as lang from g left join t on t.sid = g.sid and t.unit = g.unit",
    "e26_tag_enrichment": sql("also n as (select nv_tags, case when len(coalesce(nv_verified, [])) > 0 then 1 else 0 end as ok from nv where nv_tags is not null), a as (select count(*) as n, sum(ok) as k from n), t as (select tag, count(*) as c, sum(ok) as k from (select unnest(list_distinct(nv_tags)) as tag, ok from n) group by tag) select tag, c as n_with, a.n - c as n_without, round(t.k / c, 6) as rate_with, round((a.k - t.k) / nullif(a.n - c, 0), 6) as rate_without, round((t.k / c) / nullif((a.k - t.k) / nullif(a.n - c, 0), 0), 6) as ratio from t, a", "nv"),
    "f15_split_windows": sql("also " + verdict_queries._STATUS + ", " + _WIN.format("st") + """, r0 as (select *, case status when 'reuse' then 'OK' when 'skip' then 'BREAK' else 'SILENCE' end as role from o),
        p0 as (select *, sum(case when role = 'BREAK' then 1 else 0 end) over (partition by sid, win order by s, idx rows unbounded preceding) as piece from r0),
        q0 as (select *, last_value(case when role = 'OK' then e end ignore nulls) over (partition by sid, win, piece order by s, idx rows between unbounded preceding and 1 preceding) as oe from p0 where role <> 'BREAK'),
        n0 as (select *, sum(case when role = 'OK' and s - oe > 3000 then 1 else 0 end) over (partition by sid, win, piece order by s, idx rows unbounded preceding) as part from q0),
        b0 as (select *, min(case when role = 'OK' then (s, idx) end) over g as lo, max(case when role = 'OK' then (s, idx) end) over g as hi from n0 window g as (partition by sid, win, piece, part)),
        m0 as (select *, sid || '#' || win || '#' || piece || '#' || part as rk from b0 where (s, idx) >= lo and (s, idx) <= hi),
        a0 as (select sid, win, piece, part, rk, min(s) as run_start, max(e) as run_end, count(*) as n from m0 group by all having max(e) - min(s) >= 5000 and count(distinct case when role = 'OK' then spk end) >= 1),
        n as (select rk as sid, idx, s, e, min(s) over (partition by rk) as win, q, coalesce(spk, '') as spk from m0 where rk in (select rk from a0)),
        """ + sequence_queries._TURN.partition("from o),")[2] + sequence_queries._METRICS.partition(sequence_queries._TURN)[2].rstrip() + ", gt as (select *, case when (win_end" + sequence_queries.ORACLES["c23_window_gates"].partition("select *, case when (win_end")[2] + """),
        w0 as (select sid, win, count(*) as ni, min(case when role = 'OK' then 1 else 0 end) as ok from r0 group by sid, win),
        j0 as (select a0.*, gt.speakers, gt.reason, case when ok = 1 and n = ni then 1 else 0 end as whole, sum(case when gt.reason = 'kept' then 1 else 0 end) over (partition by a0.sid, a0.win order by run_start, piece, part rows unbounded preceding) as kk from a0 join gt on gt.sid = a0.rk join w0 on w0.sid = a0.sid and w0.win = a0.win)
        select sid, win as win_start, run_start, run_end, speakers, reason, whole, case when reason = 'kept' then 'D' || win || '_p' || (kk - 1) end as name from j0""", "seg", "fac"),
    "e4_weighted_posterior": sql(_ENT + ", t as (select sid, sum(w) as w from j group by sid) select en.sid, label, round(sum(en.w * p) / any_value(t.w), 6) as mean from en join t on t.sid = en.sid group by en.sid, label", "seg", "fac"),
    "e5_summed_labels": sql(_ENT + ", g as (select sid, label, sum(w * p) as s, min((row, label)) as fst from en group by sid, label), t as (select *, sum(s) over (partition by sid) as tot, row_number() over (partition by sid order by s desc, fst) as r from g) select sid, max(case when r = 1 then label end) as label, round(max(case when r = 1 then s / tot end), 6) as agreement, string_agg(case when r <= 3 then label || '=' || format('{:.3f}', s / tot + 1e-12) end, ' ' order by r) as top3 from t group by sid", "seg", "fac"),
    "e7_file_summary": sql(sequence_queries._RUNS.format(label="lang", cmp="> 10000").rstrip() + """, l as (select sid, lang, sum(e - s) as w from seg where lang is not null and lang <> '' group by all), v as (select sid, arg_max(lang, (w, lang)) as lang, round(max(w) / sum(w), 6) as dominant_lang_ratio, count(*) as n_languages from l group by sid),
        d as (select sid, arg_max_null(duration, ingested_at) as file_seconds from recordings where sid is not null group by sid), n as (select sid, count(distinct run) as n_spans from r group by sid),
        g as (select sid, count(*) as n_segments, sum(e - s) as ms, round(sum(q * (e - s)) / nullif(sum(case when q is not null then e - s end), 0), 6) as mean_q, round(10 * log10(sum((e - s) * pow(10.0, q * -10 / 10)) / nullif(sum(case when q is not null then e - s end), 0)), 4) as level from seg group by sid)
        select g.sid, n_segments, round(ms / 1000.0 + 1e-9, 2) as speech_seconds, file_seconds, round(ms / 1000.0 / nullif(file_seconds, 0) + 1e-9, 3) as speech_ratio, v.lang, dominant_lang_ratio, coalesce(n_languages, 0) as n_languages, mean_q, level, n_spans from g left join v on v.sid = g.sid left join d on d.sid = g.sid join n on n.sid = g.sid""", "seg"),
    "f23_phase_line": sql(sequence_queries._RUNS.format(label="spk", cmp="> 10000").rstrip() + """, u as (select sid, any_value(spk) as label, min(s) as a, arg_max(e, (s, idx)) as b, sum(e - s) as w from r group by sid, run), k as (select * from u where label is not null),
        v as (select sid, 1 - max(w) / sum(w) as v from (select sid, label, sum(w) as w from k group by sid, label) group by sid), t as (select sid, max(e) as total from seg group by sid),
        h as (select k.*, row_number() over (partition by k.sid order by b - a desc, a) as rk from k join t on t.sid = k.sid where b - a >= 0.05 * total),
        l as (select *, case when lag(label) over (partition by sid order by a) = label then 0 else 1 end as new from h where rk <= 6), g as (select *, sum(new) over (partition by sid order by a rows unbounded preceding) as g from l),
        c as (select sid, g, label, min(a) as a, arg_max(b, a) as b from g group by sid, g, label),
        x as (select sid, g, label || ' (' || (a // 60000) || ':' || lpad(cast(a // 1000 % 60 as varchar), 2, '0') || '-' || (b // 60000) || ':' || lpad(cast(b // 1000 % 60 as varchar), 2, '0') || ')' as t from c)
        select x.sid, cast(count(*) as int) as n_phases, string_agg(t, ' > ' order by g) as line from x join v on v.sid = x.sid where v.v >= 0.15 group by x.sid having count(*) >= 2""", "seg"),
    "e14_chunk_metrics": sql("""also c0 as (select sid, idx, seg_index, s, e, q, coalesce(spk, '') as spk, trim(coalesce(txt, '')) = '' as flag from seg), p as (select *, lag(e) over w as pe, lag(spk) over w as ps from c0 window w as (partition by sid order by s, idx)),
        r as (select *, sum(case when pe is null or ps <> spk or s - pe > 2000 then 1 else 0 end) over (partition by sid order by s, idx rows unbounded preceding) as run from p)
        select sid, min(s) as chunk_start, string_agg(seg_index, ',' order by s, idx) as members, cast(sum(e - s) as bigint) as speech_ms, round(sum(q * (e - s)) / nullif(sum(case when q is not null then e - s end), 0), 4) as mean_q, case when count(q) > 0 then 1 else 0 end as evaluated, round(sum(case when flag then e - s else 0 end) / sum(e - s), 6) as flagged_share from r group by sid, run""", "seg"),
    "e20_view_hours": sql("""also v as (select coalesce(nullif(trim(lang), ''), 'unknown') as lang, case when contains(source_member, '_long_') then 'long' when contains(source_member, '_dlg_') then 'dialogue' else 'short' end as "view", cast(round((rel_end - rel_start) * 1000) as bigint) as ms from man where source_member is not null and rel_end > rel_start),
        t as (select sum(ms) as t from v), g as (select lang, "view", count(*) as n, sum(ms) as ms, grouping(lang) as gl, grouping("view") as gv from v group by rollup (lang, "view"))
        select lang, "view", n, round(ms / 3600000.0, 4) as hours, round(ms / t.t, 6) as part from g, t where ms / 3600000.0 >= 0.05 or gl = 1""", "man"),
    "e6_speaker_fold": sql("""also v as (select * from seg where spk is not null), a as (select sid, spk, min((s, idx)) as fst from v group by all), tg as (select sid, spk, 'S' || row_number() over (partition by sid order by fst) as tag from a),
        vo as (select id as sid, unnest(map_keys(speakers)) as tag, unnest(map_values(speakers)).gender as gender from rec where speakers is not null), gd as (select tg.sid, tg.spk, gender from tg left join vo on vo.sid = tg.sid and vo.tag = tg.tag),
        l as (select sid, spk, lang, sum(e - s) as w from v where lang is not null and lang <> '' group by all), lv as (select sid, spk, arg_max(lang, (w, lang)) as lang, round(max(w) / sum(w), 6) as dominant_lang_ratio, count(*) as n_languages from l group by sid, spk),
        g as (select sid, spk, count(*) as n_segments, round(sum(e - s) / 1000.0 + 1e-9, 2) as speech_seconds, round(sum(q * (e - s)) / nullif(sum(case when q is not null then e - s end), 0), 6) as mean_q from v group by sid, spk)
        select g.sid, g.spk, n_segments, speech_seconds, lv.lang, lv.dominant_lang_ratio, coalesce(n_languages, 0) as n_languages, gd.gender, mean_q, case when mean_q is null then null when gd.gender = 'male' then case when mean_q * 45 < 115.7 then 'low' when mean_q * 45 > 149.7 then 'high' else 'medium' end else case when mean_q * 45 < 141.6 then 'low' when mean_q * 45 > 184.5 then 'high' else 'medium' end end as pitch
        from g left join lv on lv.sid = g.sid and lv.spk = g.spk left join gd on gd.sid = g.sid and gd.spk = g.spk""", "seg", "rec"),
    "c14_label_gate": sql("also c as (select fact_id, language, try_cast(extra['lid_confidence'] as double) as c from fac) select fact_id, case when c >= 0.6 and language not in ('', 'unknown') then language end as label, round(c, 4) as confidence from c", "fac"),
    "c15_collapse_marks": sql("""also j as (select nv.id, nv_tags, trim(regexp_replace(regexp_replace(nv_text, '\\[[A-Za-z][A-Za-z-]*\\]', ' ', 'g'), '\\s+', ' ', 'g')) as h, txt from nv left join seg on seg.sid = nv.rec and seg.s = try_cast(round(rel_start * 1000) as bigint) where nv_tags is not null and rel_start is not null),
        r as (select *, case when length(regexp_replace(txt, '[\\s\\p{P}\\p{Z}]', '', 'g')) > 0 then round(length(regexp_replace(h, '[\\s\\p{P}\\p{Z}]', '', 'g')) / length(regexp_replace(txt, '[\\s\\p{P}\\p{Z}]', '', 'g')), 2) end as ratio from j)
        select id, ratio, case when len(nv_tags) > 0 and ratio < 0.6 then array_to_string(list_sort(list_distinct(nv_tags)), ',') end as collapsed from r""", "nv", "seg"),
    "c22_window_hopes": sql("also " + verdict_queries._STATUS + ", " + _WIN.format("st") + ", g as (select sid, win as win_start, cast(sum(case when status = 'reuse' then e - s else 0 end) as bigint) as reuse, cast(sum(case when status = 'skip' then e - s else 0 end) as bigint) as skip, cast(sum(case when status = 'fill' then e - s else 0 end) as bigint) as fill from o group by sid, win) select *, case when reuse / (reuse + skip + fill) < 0.05 and skip > fill then 1 else 0 end as hopeless from g", "seg", "fac"),
    "d2_gated_merge": sql("also c as (select distinct on (sid, seg_index) sid, seg_index, language, try_cast(extra['lid_confidence'] as double) as c from fac order by sid, seg_index, fact_id) select idx, case when c >= 0.5 and language not in ('', 'unknown') then language end as label, round(c, 4) as confidence from seg left join c on c.sid = seg.sid and c.seg_index = seg.seg_index", "seg", "fac"),
    "d12_filled_languages": "with nl as (" + join_queries.ORACLES["d12_nearest_language"] + "), seg as (" + views.SQL["seg"] + "), r as (select sid, arg_max_null(languages, ingested_at) as l from recordings where sid is not null group by sid) select nl.idx, coalesce(label, case when len(l) = 1 then l[1] end) as label, case when label is null and len(l) = 1 and l[1] is not null then 'container' else source end as source from nl join seg on seg.idx = nl.idx left join r on r.sid = seg.sid",
    "e21_edge_drift": "with f as (" + fold_queries.ORACLES["e21_speed_edges"] + "), g as (select lang, n, lo, hi, map {" + ", ".join(f"'{k}': [{v[0]}::double, {v[1]}::double]" for k, v in L.SPEED_EDGES.items()) + "}[lower(trim(lang))] as o from f) select lang, n, lo, hi, o[1] as shipped_lo, o[2] as shipped_hi, case when o is null then null when greatest(abs(lo / o[1] - 1), abs(hi / o[2] - 1)) > 0.15 then 1 else 0 end as drift from g",
    "h7_owners": sql("also " + Q.CRC_TABLE + ", k as (select man.id, case when rec.id is not null then man.parent_id else man.id end as own from man left join rec on rec.id = man.parent_id where man.id is not null) select id, " + Q.CRC_SQL.format("own") + " % 16 as shard from k, crct", "man", "rec"),
    "h8_gathered": sql("also " + Q.CRC_TABLE + " select id, " + Q.CRC_SQL.format("coalesce(parent_id, id)") + " % 4 as shard, row_number() over (order by id) as position from man, crct where id is not null", "man"),
    "i8_rates": sql("also r as (select idx, (e - s) / 1000.0 as sec, length(coalesce(txt, '')) as n, " + Q._CH.format("txt") + " as c from seg) select idx, case when sec >= 0.5 and n > 0 then round(n / sec, 1) end as text_cps, case when sec >= 0.5 and c > 0 then round(c / least(sec, 30.0), 1) end as heard_cps from r", "seg"),
    "f3_capped_units": _UNITS + " select sid, spk, min(us) as unit_start, arg_max(ue, r) as unit_end, count(*) as n_seg from u group by sid, spk, unit",
    "f5_speaker_cuts": _CUTS,
    "i28_cut_transcripts": sql("also " + verdict_queries._STATUS + ", " + _WIN.format("st") + """, w as (select *, coalesce(max(case when status <> 'reuse' then e end) over (partition by sid, win), max(e) over (partition by sid, win)) as we from o),
        k as (select *, status <> 'reuse' or e <= we + 50 as kept from w), d as (select sid, win, cast(sum(case when kept then 0 else 1 end) as bigint) as dropped from k group by sid, win),
        a as (select sid, win, spk, min((s, idx)) as fst from k where kept group by all), g as (select sid, win, spk, 'S' || row_number() over (partition by sid, win order by fst) as tag from a),
        x as (select k.sid, k.win, k.s, k.idx, trim(coalesce(txt, '')) as t, tag, lag(tag) over (partition by k.sid, k.win order by k.s, k.idx) as pt from k join g on g.sid = k.sid and g.win = k.win and g.spk = k.spk where kept),
        y as (select *, sum(case when pt is null or pt <> tag then 1 else 0 end) over (partition by sid, win order by s, idx rows unbounded preceding) as run from x),
        z as (select sid, win, run, '[' || tag || '] ' || string_agg(t, ' ' order by s, idx) as line from y where t <> '' group by sid, win, run, tag)
        select d.sid, d.win as win_start, dropped, string_agg(line, ' ' order by run) as transcript from d left join z on z.sid = d.sid and z.win = d.win group by d.sid, d.win, dropped""", "seg", "fac"),
}

QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "cdefhi" and k[1:2].isdigit()}
