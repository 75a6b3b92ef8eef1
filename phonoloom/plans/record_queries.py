"""Queries of the record operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import records as R
from ..operators import sequences as S
from ..sources import views
from ..sources.views import sql


def _noisy(spark, d):
    return views.nv_rows(spark, d).where("array_contains(nv_tags, 'Humming')").select("id")


def c15_collapsed(spark, d):
    nv = views.nv_rows(spark, d).where("nv_tags is not null and nv_text is not null")
    words = F.length(F.regexp_replace("nv_text", r"\[[^\]]*\]|\s", ""))
    return nv.select("id", F.when((F.size("nv_tags") > 0) & (words < 30), F.array_join(F.array_distinct("nv_tags"), ",")).alias("collapsed"))


def c16_sung(spark, d):
    nv = views.nv_rows(spark, d).where("nv_tags is not null")
    hits = F.array_sort(F.array_intersect("nv_tags", F.array(F.lit("Breathing"), F.lit("Sigh"))))
    return nv.select("id", F.when(F.array_contains("nv_tags", "Humming") & (F.size(hits) > 0), F.concat(F.lit("singing("), F.element_at(hits, 1), F.lit(")"))).alias("rejected"))


def c18_dropped_tags(spark, d):
    nv = views.nv_rows(spark, d).select("id", "nv_tags")
    return R.without_tags(nv, "nv_tags", ["Cough"], _noisy(spark, d)).select("id", F.array_join("nv_tags", ",").alias("tags"), F.col("dropped").cast("long").alias("dropped"))


def d9_unit_texts(spark, d):
    s = S.gap_windows(views.segments(spark, d).select("sid", "idx", "seg_index", "s", "e")).select("sid", F.col("win").alias("unit"), "seg_index", "s")
    return R.unit_texts(s, views.facts(spark, d))


def d20_selection(spark, d):
    m = views.manifest(spark, d).where("id is not null and source_member is not null")
    return R.strict_selection(m.where("lang = 'en'").select("id"), m.select("id", "source_tar", "source_member"), "id", ["source_member"])


def f5_speaker_cuts(spark, d):
    return R.speaker_cuts(views.frames(spark, d))


def f26_sample_bounds(spark, d):
    s = views.segments(spark, d)
    w = S.gap_windows(s.select("sid", "idx", "s", "e")).groupBy("sid", "win").agg(F.max("e").alias("hi"))
    rows = S.gap_windows(s.select("sid", "idx", "s", "e")).join(w, ["sid", "win"])
    return R.converted(rows.select(F.col("idx").alias("id"), "s", "e", F.col("win").alias("lo"), F.col("hi")))


def g7_segment_order(spark, d):
    s = views.segments(spark, d)
    from ..operators.ordered import bucketed_rank

    return bucketed_rank(s.select("sid", "idx", "s", "e"), ["sid"], "s", ["e", "idx"], 3_600_000, "rank").select("idx", "rank")


def i27_fallbacks(spark, d):
    nv = views.nv_rows(spark, d)
    return nv.select("id", F.coalesce("parent_id", "rec").alias("parent"), F.coalesce("turn", F.lit("S1")).alias("turn"))


def e7_file_record(spark, d):
    from ..functions import scalars as X
    from ..operators import folds as A

    s, w = views.segments(spark, d), F.col("e") - F.col("s")
    base = s.groupBy("sid").agg(F.count(F.lit(1)).alias("n_segments"), F.sum(w).alias("speech_ms"), F.max("e").alias("file_ms"), F.countDistinct("lang").alias("n_languages"))
    vote = A.weighted_vote(s, ["sid"], "lang", w).select("sid", F.col("label").alias("lang"), F.col("share").alias("lang_share"))
    mean = A.weighted_mean(s, ["sid"], "q", w).withColumnRenamed("mean", "q")
    r = base.join(vote, "sid", "left").join(mean, "sid").withColumn("speech_share", F.round(F.col("speech_ms") / F.col("file_ms"), 3))
    return r.withColumn("level", X.bucket(F.col("q"), (2.4, 3.2), ("noisy", "fair", "clear")))


def e22_span_vote(spark, d):
    s, w = views.segments(spark, d).select("sid", "idx", "s", "e", "lang", "spk", "q"), F.col("e") - F.col("s")
    runs = S.with_runs(s, "lang").where("q >= 2.5 and spk is not null")
    per = runs.groupBy("sid", "run", "spk").agg(F.sum(w).alias("w"), F.sum(F.col("q") * w).alias("qw"))
    g = per.groupBy("sid", "run").agg(F.max(F.struct("w", "spk")).alias("x"), F.sum("w").alias("all"), F.sum("qw").alias("qw"))
    return g.select("sid", F.col("run.s").alias("run_start"), F.col("x.spk").alias("voice"), F.round(F.col("x.w") / F.col("all"), 6).alias("support"), F.round(F.col("qw") / F.col("all"), 4).alias("confidence"))


def e23_span_rate(spark, d):
    from ..functions import scalars as X

    s = views.segments(spark, d).select("sid", "idx", "s", "e", "lang", F.coalesce(X.char_count(F.col("txt")), F.lit(0)).alias("chars"))
    g = S.with_runs(s, "lang").groupBy("sid", "run").agg(F.first("lang").alias("lang"), F.sum("chars").alias("chars"), F.sum(F.col("e") - F.col("s")).alias("ms"))
    rate = F.col("chars") * 1000 / F.col("ms")
    return g.select("sid", F.col("run.s").alias("run_start"), "lang", F.round(rate, 3).alias("cps"), X.bucket(rate, (4.0, 12.0), ("slow", "measured", "fast")).alias("pace"))


_RUNS = "p as (select *, lag(e) over w as pe, lag(lang) over w as pl, lag(idx) over w as pi from seg window w as (partition by sid order by s, idx)), rn as (select *, sum(case when pi is null or pl is distinct from lang or s - pe > 10000 then 1 else 0 end) over (partition by sid order by s, idx rows unbounded preceding) as run from p), rs as (select *, min(s) over (partition by sid, run) as run_start from rn)"
_WIN = "f as (select *, max(e) over (partition by sid order by s, idx rows between unbounded preceding and 1 preceding) as far from seg), o as (select *, max(case when far is null or s - far > 6000 then s end) over (partition by sid order by s, idx rows unbounded preceding) as win from f)"
ORACLES = {
    "e7_file_record": sql("""also p as (select sid, lang, sum(e - s) as w from seg where lang is not null and lang <> '' group by all), v as (select sid, arg_max(lang, (w, lang)) as lang, round(max(w) / sum(w), 6) as lang_share from p group by sid),
        b as (select sid, count(*) as n_segments, cast(sum(e - s) as bigint) as speech_ms, max(e) as file_ms, count(distinct lang) as n_languages, round(sum(q * (e - s)) / nullif(sum(case when q is not null then e - s end), 0), 6) as q from seg group by sid)
        select b.sid, n_segments, speech_ms, file_ms, n_languages, v.lang, lang_share, q, round(speech_ms / file_ms, 3) as speech_share, case when q is null then null when q < 2.4 then 'noisy' when q > 3.2 then 'clear' else 'fair' end as level from b left join v on v.sid = b.sid""", "seg"),
    "e22_span_vote": sql("also " + _RUNS + ", k as (select sid, run, run_start, spk, sum(e - s) as w, sum(q * (e - s)) as qw from rs where q >= 2.5 and spk is not null group by all) select sid, run_start, arg_max(spk, (w, spk)) as voice, round(max(w) / sum(w), 6) as support, round(sum(qw) / sum(w), 4) as confidence from k group by sid, run, run_start", "seg"),
    "e23_span_rate": sql("also " + _RUNS + ", g as (select sid, run_start, any_value(lang) as lang, sum(length(regexp_replace(coalesce(txt, ''), '[\\s\\p{P}\\p{Z}]', '', 'g'))) * 1000 / sum(e - s) as r from rs group by sid, run, run_start) select sid, run_start, lang, round(r, 3) as cps, case when r < 4 then 'slow' when r > 12 then 'fast' else 'measured' end as pace from g", "seg"),
    "c15_collapsed": sql("select id, case when len(nv_tags) > 0 and length(regexp_replace(nv_text, '\\[[^\\]]*\\]|\\s', '', 'g')) < 30 then (select string_agg(t, ',' order by p) from (select t, min(p) as p from (select unnest(nv_tags) as t, generate_subscripts(nv_tags, 1) as p) group by t)) end as collapsed from nv where nv_tags is not null and nv_text is not null", "nv"),
    "c16_sung": sql("also h as (select id, nv_tags, list_sort(list_filter(['Breathing', 'Sigh'], lambda x: list_contains(nv_tags, x))) as h from nv where nv_tags is not null) select id, case when list_contains(nv_tags, 'Humming') and len(h) > 0 then 'singing(' || h[1] || ')' end as rejected from h", "nv"),
    "c18_dropped_tags": sql("also k as (select id, nv_tags, case when list_contains(nv_tags, 'Humming') then [] else list_filter(nv_tags, lambda t: t <> 'Cough') end as k from nv) select id, array_to_string(k, ',') as tags, len(nv_tags) - len(k) as dropped from k", "nv"),
    "d9_unit_texts": sql("also " + _WIN + """, g as (select sid, seg_index, arg_min_null(text, fact_id) as text, 1 as hit from fac where accepted group by sid, seg_index),
        j as (select o.sid, o.win, o.s, g.text, hit from o left join g on g.sid = o.sid and g.seg_index = o.seg_index)
        select sid, win as unit, count(*) as n, case when count(*) = count(hit) then coalesce(string_agg(trim(text), ' ' order by s, trim(text)) filter (where trim(text) <> ''), '') end as text from j group by sid, win""", "seg", "fac"),
    "d20_selection": sql("select id, source_tar, source_member from man where id is not null and source_member is not null and lang = 'en'", "man"),
    "f26_sample_bounds": sql("also " + _WIN + ", w as (select *, max(e) over (partition by sid, win) as hi from o) select idx as id, cast(round_even(greatest(s, win) * 16000 / 1000, 0) as bigint) as from_sample, cast(round_even(least(e, hi) * 16000 / 1000, 0) as bigint) as to_sample, cast(null as varchar) as problem from w", "seg"),
    "g7_segment_order": sql("select idx, row_number() over (partition by sid order by s, e, idx) as rank from seg", "seg"),
    "i27_fallbacks": sql("select id, coalesce(parent_id, rec) as parent, coalesce(turn, 'S1') as turn from nv", "nv"),
}

QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "cdefgi" and k[1:2].isdigit()}
