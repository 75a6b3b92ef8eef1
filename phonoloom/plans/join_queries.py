"""Queries of the joins, set operations and merges, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import joins as J
from ..sources import views
from ..sources.tables import table
from ..sources.views import sql


def _seg(spark, d, *cols):
    return views.segments(spark, d).select("sid", "idx", "s", "e", *cols)


def _member(spark, d):
    return views.frames(spark, d).select("sid", F.col("idx").alias("a_idx"), F.col("s").alias("as"), F.col("e").alias("ae"))


def _short(spark, d):
    return _seg(spark, d).select("sid", F.col("idx").alias("b_idx"), F.col("s").alias("bs"), F.col("e").alias("be"))


def _accepted(spark, d):
    """One accepted transcript per segment: the lowest fact."""
    f = views.facts(spark, d).where("accepted and text is not null and trim(text) <> ''")
    return J.first_wins(f.select("sid", "seg_index", "fact_id", F.col("text").alias("heard"), F.col("language").alias("heard_lang")), ["sid", "seg_index"], ["fact_id"])


def a3_last_wins(spark, d):
    r = table(spark, d, "recordings").select("sid", "audio_name", "sample_rate", "ingested_at")
    return J.last_wins(r.where("sid is not null"), ["sid"], ["ingested_at", "audio_name"]).select("sid", "audio_name", "sample_rate")


def a9_first_seen_archives(spark, d):
    m = views.manifest(spark, d).where("source_tar is not null")
    return m.groupBy("source_tar").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))


def a18_member_views(spark, d):
    m = views.manifest(spark, d).where("source_member is not null")
    v = F.when(F.contains("source_member", F.lit("_long_")), "long").when(F.contains("source_member", F.lit("_dlg_")), "dialogue").otherwise("short")
    return m.groupBy(v.alias("view")).agg(F.count(F.lit(1)).alias("n"))


def d1_stage_merge(spark, d):
    base = table(spark, d, "documents").where("doc_id is not null").select("doc_id", "parent_id", "kind")
    tags = table(spark, d, "documents").where("doc_id is not null and text is not null").select("doc_id", X.char_count(F.col("text")).cast("long").alias("chars"))
    return J.merged(base, tags, "doc_id")


def d2_transcript_merge(spark, d):
    s = views.segments(spark, d).select("idx", "sid", "seg_index", "txt")
    return s.join(_accepted(spark, d), ["sid", "seg_index"], "left").select("idx", F.coalesce("heard", "txt").alias("text"), F.when(F.col("heard").isNotNull(), "asr").when(F.col("txt").isNotNull(), "raw").alias("text_source"))


def d5_remaining_work(spark, d):
    done = views.facts(spark, d).where("accepted").select("sid", "seg_index")
    return views.segments(spark, d).join(done, ["sid", "seg_index"], "left_anti").select("idx")


def d6_pending_archives(spark, d):
    m = views.manifest(spark, d)
    done = m.where("txt is not null").select(F.regexp_extract("source_tar", "([^/]+)$", 1).alias("base"))
    return m.where("source_tar is not null").select("source_tar", F.regexp_extract("source_tar", "([^/]+)$", 1).alias("base")).distinct().join(done, "base", "left_anti").select("source_tar")


def d7_scope_filter(spark, d):
    scope = views.records(spark, d).where("n_speakers >= 3").select(F.col("id").alias("rec"))
    return views.nv_rows(spark, d).join(scope, "rec", "left_semi").select("id", "rec")


def d8_fully_transcribed(spark, d):
    s = views.segments(spark, d).select("sid", "spk", "seg_index").where("spk is not null")
    f = views.facts(spark, d).select("sid", "seg_index").where("seg_index is not null")
    return J.divided(s, f, ["sid", "spk"], ["sid", "seg_index"])


def d10_iou_match(spark, d):
    return J.best_overlap(_member(spark, d), _short(spark, d))


def d11_orphan_shorts(spark, d):
    return J.orphans(_member(spark, d), _short(spark, d)).select("sid", "b_idx")


def d12_nearest_language(spark, d):
    return J.nearest_label(_seg(spark, d, "lang"), "lang").select("idx", "label", "source")


def d13_segment_at_point(spark, d):
    p = views.breaks(spark, d).select("sid", "lo").distinct().select("sid", F.col("lo").alias("p"), F.col("lo").alias("t"))
    return J.at_point(p, _seg(spark, d))


def d13_nearest_segment(spark, d):
    p = views.breaks(spark, d).select("sid", "lo").distinct().select("sid", F.col("lo").alias("p"), F.col("lo").alias("t"))
    return J.at_or_nearest(p, _seg(spark, d))


def d14_frame_conflicts(spark, d):
    return J.conflicts(views.frames(spark, d))


def d15_broken_gaps(spark, d):
    return J.broken_gaps(_seg(spark, d), views.breaks(spark, d)).select("idx", "gap_s", "gap_e")


def d16_parent_promotion(spark, d):
    nv = views.nv_rows(spark, d).where("nv_tags is not null").select("id", "rec", F.array_contains("nv_tags", "Humming").cast("int").alias("hum"))
    part = nv.groupBy("rec").agg(F.avg("hum").alias("part"))
    return nv.join(part, "rec").select("id", F.when(F.col("part") >= 0.25, "sung").otherwise("speech").alias("route"))


def d18_secondary_fill(spark, d):
    f = views.facts(spark, d).select("fact_id", "sid", "seg_index", "asr_model", "accepted")
    first = f.where("accepted")
    second = f.where("not accepted").join(first, ["sid", "seg_index"], "left_anti")
    return first.unionByName(second).select("fact_id", "sid", "seg_index")


def d21_attach_text(spark, d):
    t = table(spark, d, "documents").where("parent_id is not null").groupBy(F.col("parent_id").alias("sid")).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"))
    return _seg(spark, d).groupBy("sid").agg(F.count(F.lit(1)).alias("segs")).join(t, "sid").select("sid", "segs", "docs", "chars")


def d23_null_backfill(spark, d):
    s = _seg(spark, d, "q")
    m = s.groupBy("sid").agg(F.round(F.avg("q"), 6).alias("mq"))
    return s.join(m, "sid").select("idx", F.coalesce("q", "mq").alias("q"), F.col("q").isNull().cast("int").alias("filled"))


def b4_ledger(spark, d):
    m = views.manifest(spark, d)
    tried = m.select("source_tar").where("source_tar is not null").distinct()
    got = m.where("txt is not null and source_tar is not null").groupBy("source_tar").agg(F.count(F.lit(1)).alias("n"))
    return tried.join(got, "source_tar", "full").select("source_tar", F.coalesce("n", F.lit(0)).alias("n"))


def b5_delta_apply(spark, d):
    m = views.manifest(spark, d).where("id is not null").select("id", "lang", "txt")
    changed = m.where("lang is null").select("id", F.lit("und").alias("lang"), "txt")
    return J.applied_delta(m, changed, m.where("lang is not null and txt is null").select("id"), "id").select("id", "lang")


def b10_language_seconds(spark, d):
    return _seg(spark, d, "lang").groupBy("sid", F.coalesce("lang", F.lit("none")).alias("lang")).agg(F.sum(F.col("e") - F.col("s")).alias("ms"))


def h2_first_wins(spark, d):
    f = table(spark, d, "diar_frames").where("sid is not null").select("sid", "frame_idx", "speaker", "arrived_at")
    return J.first_wins(f, ["sid", "frame_idx"], ["arrived_at", "speaker"]).select("sid", "frame_idx", "speaker")


def h4_done_union(spark, d):
    a = views.facts(spark, d).select("sid")
    return a.union(views.manifest(spark, d).select(F.col("parent_id").alias("sid"))).where("sid is not null").distinct()


def h5_missing_recordings(spark, d):
    r = table(spark, d, "recordings").select("sid").where("sid is not null")
    return r.distinct().join(views.facts(spark, d).select("sid"), "sid", "left_anti")


def h6_both(spark, d):
    return table(spark, d, "recordings").select("sid").intersect(views.records(spark, d).select(F.col("id").alias("sid")))


def h7_reshard(spark, d):
    m = views.manifest(spark, d).where("id is not null")
    return m.select("id", X.hex_modulo(F.md5(F.coalesce("parent_id", "id").cast("binary")), 16).alias("shard"))


_PAIRS = "prs as (select f.sid, f.idx as a_idx, f.s as a_s, f.e as a_e, g.idx as b_idx, g.s as b_s, g.e as b_e from frm f join seg g on f.sid = g.sid and f.s < g.e and g.s < f.e)"
_ACC = "acc as (select sid, seg_index, arg_min(text, fact_id) as heard from fac where accepted and text is not null and trim(text) <> '' group by sid, seg_index)"

ORACLES = {
    "a3_last_wins": "select sid, arg_max(audio_name, (ingested_at, audio_name)) as audio_name, arg_max(sample_rate, (ingested_at, audio_name)) as sample_rate from recordings where sid is not null group by sid",
    "a9_first_seen_archives": sql("select source_tar, min(id) as first_id, count(*) as n from man where source_tar is not null group by source_tar", "man"),
    "a18_member_views": sql("select case when contains(source_member, '_long_') then 'long' when contains(source_member, '_dlg_') then 'dialogue' else 'short' end as view, count(*) as n from man where source_member is not null group by 1", "man"),
    "d1_stage_merge": "select doc_id, parent_id, kind, length(regexp_replace(text, '[\\s\\p{P}\\p{Z}]', '', 'g')) as chars from documents where doc_id is not null",
    "d2_transcript_merge": sql("also " + _ACC + " select idx, coalesce(heard, txt) as text, case when heard is not null then 'asr' when txt is not null then 'raw' end as text_source from seg left join acc using (sid, seg_index)", "seg", "fac"),
    "d5_remaining_work": sql("select idx from seg where not exists (select 1 from fac where accepted and fac.sid = seg.sid and fac.seg_index = seg.seg_index)", "seg", "fac"),
    "d6_pending_archives": sql("select distinct source_tar from man where source_tar is not null and regexp_extract(source_tar, '([^/]+)$', 1) not in (select regexp_extract(source_tar, '([^/]+)$', 1) from man where txt is not null and source_tar is not null)", "man"),
    "d7_scope_filter": sql("select id, rec from nv where rec in (select id from rec where n_speakers >= 3)", "nv", "rec"),
    "d8_fully_transcribed": sql("select sid, spk, count(*) as members from (select distinct on (idx) seg.sid, spk, (select count(*) from fac where fac.sid = seg.sid and fac.seg_index = seg.seg_index) as n from seg where spk is not null) group by sid, spk having min(n) > 0", "seg", "fac"),
    "d10_iou_match": sql("also " + _PAIRS + """, i as (select *, round((least(a_e, b_e) - greatest(a_s, b_s)) / greatest(1e-9, greatest(a_e, b_e) - least(a_s, b_s)), 9) as iou from prs),
        r as (select *, row_number() over (partition by sid, a_idx order by iou desc, b_s, b_idx) as r from i) select sid, a_idx, b_idx, iou from r where r = 1 and iou >= 0.5""", "seg", "frm"),
    "d11_orphan_shorts": sql("also " + _PAIRS + " select sid, idx as b_idx from seg where (sid, idx) not in (select (sid, b_idx) from prs where (least(a_e, b_e) - greatest(a_s, b_s)) / (b_e - b_s) >= 0.1)", "seg", "frm"),
    "d12_nearest_language": sql("""also m as (select *, s + e as mid2 from seg),
        w as (select *, last_value(case when lang is not null then (mid2, lang) end ignore nulls) over (partition by sid order by mid2, idx rows unbounded preceding) as b,
          first_value(case when lang is not null then (mid2, lang) end ignore nulls) over (partition by sid order by mid2, idx rows between current row and unbounded following) as a from m),
        x as (select idx, lang, case when a is null or mid2 - b[1] <= a[1] - mid2 then b[2] else a[2] end as near from w)
        select idx, coalesce(lang, near) as label, case when lang is not null then 'own' when near is not null then 'nearest' end as source from x""", "seg"),
    "d13_segment_at_point": sql("""also p as (select distinct sid, lo as p from brk), j as (select p.sid, p.p, idx, row_number() over (partition by p.sid, p.p order by e - s, idx) as r from p join seg on seg.sid = p.sid and s <= p.p and e >= p.p)
        select sid, p, idx from j where r = 1""", "brk", "seg"),
    "d13_nearest_segment": sql("""also p as (select distinct sid, lo as p from brk), j as (select p.sid, p.p, idx, s <= p.p and e >= p.p as hit, row_number() over (partition by p.sid, p.p order by s <= p.p and e >= p.p desc, case when s <= p.p and e >= p.p then e - s else least(abs(p.p - s), abs(p.p - e)) end, idx) as r from p join seg on seg.sid = p.sid)
        select sid, p, idx, case when hit then 'inside' else 'nearest' end as source from j where r = 1""", "brk", "seg"),
    "d14_frame_conflicts": sql("""also p as (select a.sid, a.idx as a, b.idx as b, least(a.e, b.e) - greatest(a.s, b.s) as over_ms, a.e - a.s as da, b.e - b.s as db from frm a join frm b on a.sid = b.sid and a.s < b.e and b.s < a.e and (a.s, -a.e, a.idx) < (b.s, -b.e, b.idx))
        select sid, a, b, over_ms, case when over_ms > 2000 or over_ms > 0.4 * da then 1 else 0 end as drop_a, case when over_ms > 2000 or over_ms > 0.4 * db then 1 else 0 end as drop_b from p""", "frm"),
    "d15_broken_gaps": sql("""also g as (select *, lag(e) over (partition by sid order by s, idx) as pe from seg)
        select idx, pe as gap_s, s as gap_e from g where s > pe and exists (select 1 from brk where brk.sid = g.sid and hi > lo and lo < g.s and hi > g.pe)""", "seg", "brk"),
    "d16_parent_promotion": sql("also h as (select id, rec, list_contains(nv_tags, 'Humming') as hum from nv where nv_tags is not null), p as (select rec, avg(case when hum then 1 else 0 end) as part from h group by rec) select id, case when part >= 0.25 then 'sung' else 'speech' end as route from h join p using (rec)", "nv"),
    "d18_secondary_fill": sql("select fact_id, sid, seg_index from fac where accepted or (not accepted and not exists (select 1 from fac g where g.accepted and g.sid = fac.sid and g.seg_index = fac.seg_index))", "fac"),
    "d21_attach_text": sql("also t as (select parent_id as sid, count(*) as docs, cast(sum(n_chars) as bigint) as chars from documents where parent_id is not null group by parent_id) select seg.sid, count(*) as segs, any_value(docs) as docs, any_value(chars) as chars from seg join t on seg.sid = t.sid group by seg.sid", "seg"),
    "d23_null_backfill": sql("select idx, coalesce(q, round(avg(q) over (partition by sid), 6)) as q, case when q is null then 1 else 0 end as filled from seg", "seg"),
    "b4_ledger": sql("select source_tar, count(txt) as n from man where source_tar is not null group by source_tar", "man"),
    "b5_delta_apply": sql("select id, coalesce(lang, 'und') as lang from man where id is not null and not (lang is not null and txt is null)", "man"),
    "b10_language_seconds": sql("select sid, coalesce(lang, 'none') as lang, cast(sum(e - s) as bigint) as ms from seg group by all", "seg"),
    "h2_first_wins": "select sid, frame_idx, arg_min_null(speaker, (arrived_at, coalesce(speaker, ''))) as speaker from diar_frames where sid is not null group by sid, frame_idx",
    "h4_done_union": sql("select sid from fac where sid is not null union select parent_id from man where parent_id is not null", "fac", "man"),
    "h5_missing_recordings": sql("select distinct sid from recordings where sid is not null and sid not in (select sid from fac where sid is not null)", "fac"),
    "h6_both": sql("select sid from recordings intersect select id from rec", "rec"),
    "h7_reshard": sql("select id, cast(('0x' || substr(md5(coalesce(parent_id, id)), 32, 1)) as bigint) as shard from man where id is not null", "man"),
}

QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "abdh" and k[1:2].isdigit()}
