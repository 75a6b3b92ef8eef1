"""Queries of verdicts, folds over files and text functions, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import folds as A
from ..operators import sequences as S
from ..operators import timelines as T
from ..operators import verdicts as V
from ..operators.ordered import ranged_rank
from ..sources import views
from ..sources.tables import table
from ..sources.views import sql
from . import sequence_queries


def _seg(spark, d):
    return views.segments(spark, d)


def _w():
    return F.col("e") - F.col("s")


def _status(spark, d):
    """Segments with what a transcript table has for them: reuse, skip or fill."""
    f = views.facts(spark, d).groupBy("sid", "seg_index").agg(F.max(F.coalesce("accepted", F.lit(False))).alias("ok"))
    return _seg(spark, d).join(f, ["sid", "seg_index"], "left").withColumn("status", F.when(F.col("ok"), "reuse").when(F.col("ok").isNotNull(), "skip").otherwise("fill"))


def c14_posterior_gate(spark, d):
    p = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.abs(x).cast("double")).alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    best = F.array_max("p")
    return p.select("vec_id", F.when(best / total >= 0.05, F.array_position("p", best)).alias("label"), F.round(best / total, 4).alias("confidence"))


def c21_reuse_status(spark, d):
    return _status(spark, d).select("idx", "status")


def c22_untranscribable(spark, d):
    g = _status(spark, d).groupBy("sid").agg(*[F.sum(F.when(F.col("status") == k, _w()).otherwise(0)).alias(k) for k in ("reuse", "skip", "fill")])
    share = F.col("reuse") / (F.col("reuse") + F.col("skip") + F.col("fill"))
    return g.select("sid", "reuse", "skip", "fill", ((share < 0.05) & (F.col("skip") > F.col("fill"))).cast("int").alias("hopeless"))


def c24_chunk_gates(spark, d):
    c = S.long_chunks(_seg(spark, d))
    sec = (F.col("chunk_end") - F.col("chunk_start")) / 1000
    return c.select("sid", "chunk_start", F.when(sec < 30, "too_short").when(F.coalesce("mean_q", F.lit(0.0)) < 2.4, "low_quality").otherwise("kept").alias("reason"))


def d19_offsets(spark, d):
    m = views.manifest(spark, d).where("source_tar is not null")
    i = m.where("txt is not null").select("source_tar", "source_member", F.length("txt").cast("long").alias("size")).dropDuplicates(["source_tar", "source_member"])
    return m.select("id", "source_tar", "source_member").join(i, ["source_tar", "source_member"], "left").groupBy("source_tar").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("size").isNull().cast("int")).alias("missing"))


def e6_voice_fold(spark, d):
    s = _seg(spark, d).where("spk is not null")
    g = s.groupBy("sid", "spk").agg(F.count(F.lit(1)).alias("n"), F.sum(_w()).alias("ms"), F.countDistinct("lang").alias("n_langs"))
    return g.join(A.weighted_vote(s, ["sid", "spk"], "lang", _w()), ["sid", "spk"], "left").join(A.weighted_mean(s, ["sid", "spk"], "q", _w()), ["sid", "spk"]).select("sid", "spk", "n", "ms", "n_langs", F.col("label").alias("lang"), F.col("share").alias("lang_share"), F.col("mean").alias("q"))


def e9_dominant_label(spark, d):
    t = T.label_timeline(_seg(spark, d), "lang").where("label is not null").groupBy("sid", "label").agg(F.sum("speech_ms").alias("w"))
    g = t.groupBy("sid").agg(F.max(F.struct("w", "label")).alias("x"), F.sum("w").alias("all"))
    return g.select("sid", F.col("x.label").alias("label"), F.round(1 - F.col("x.w") / F.col("all"), 3).alias("variability"))


def e10_spread(spark, d):
    t = T.value_timeline(_seg(spark, d), "q")
    return t.groupBy("sid").agg(F.count("label").alias("n"), F.round(F.coalesce((F.max("label") - F.min("label")) / F.nullif(F.max("label"), F.lit(0.0)), F.lit(0.0)), 3).alias("spread"))


def f14_run_assembly(spark, d):
    s = S.gap_windows(_status(spark, d).select("sid", "idx", "s", "e", "spk", "status"))
    return V.assembled_runs(s.withColumn("role", F.when(F.col("status") == "reuse", "OK").when(F.col("status") == "skip", "BREAK").otherwise("SILENCE")))


def f18_best_window(spark, d):
    r = S.gap_windows(_seg(spark, d)).select("sid", F.col("win").alias("run"), "s", "e")
    return V.best_window(r).withColumnRenamed("run", "win_start")


def f19_stitched(spark, d):
    nv = views.nv_rows(spark, d).where("turn is not null and nv_text is not null and trim(nv_text) <> ''")
    pos = F.struct("rel_start", "turn", "nv_text", "id")
    g = nv.groupBy("rec").agg(F.array_sort(F.collect_list(pos)).alias("r"))
    # a tag only where the turn changes
    line = F.aggregate("r", F.struct(F.lit("").alias("last"), F.lit("").alias("out")), lambda a, x: F.struct(x["turn"].alias("last"), F.concat(a["out"], F.when(a["last"] == x["turn"], F.concat(F.lit(" "), x["nv_text"])).otherwise(F.concat(F.when(a["out"] == "", "").otherwise(" "), F.lit("["), x["turn"], F.lit("] "), x["nv_text"]))).alias("out")))
    return g.select(F.col("rec").alias("id"), line["out"].alias("transcript"))


def g2_full_locality(spark, d):
    m = views.manifest(spark, d).where("source_tar is not null")
    # no table has byte offsets: the name of the member, by which archives are written, stands for its offset
    order = [F.asc_nulls_last("source_member"), F.asc_nulls_last("rel_start"), F.asc("id")]
    return ranged_rank(m.select("source_tar", "source_member", "rel_start", "id"), ["source_tar"], order, "rank").select("source_tar", "id", "rank")


def h1_concat(spark, d):
    a = views.manifest(spark, d).select("id", F.col("txt").alias("text"))
    b = views.nv_rows(spark, d).select("id", F.col("nv_text").alias("text"), "turn")
    return a.unionByName(b, allowMissingColumns=True)


def h8_coverage(spark, d):
    m = views.manifest(spark, d).where("id is not null").select("id")
    parts = [m.where(X.hex_modulo(F.md5(F.col("id").cast("binary")), 4) == k).withColumn("shard", F.lit(k)) for k in range(4)]
    got = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return m.join(got, "id", "full").groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


def i2_ngram_repeat(spark, d):
    return views.facts(spark, d).select("fact_id", V.ngram_repeat(F.col("text")).cast("long").alias("most"))


def i3_repeated_share(spark, d):
    return V.with_repeated_share(views.facts(spark, d), "fact_id", "text")


def i12_language_names(spark, d):
    names = F.create_map(*[F.lit(x) for kv in {"english": "en", "german": "de", "french": "fr", "spanish": "es", "portuguese": "pt", "russian": "ru", "ukrainian": "uk", "chinese": "zh", "japanese": "ja", "korean": "ko", "thai": "th", "hindi": "hi"}.items() for x in kv])
    low = F.lower(F.trim("lang"))
    code = F.coalesce(F.try_element_at(names, low), F.when(F.length(low) >= 2, F.regexp_extract(low, "^([a-z]{2})(?:[-_].*)?$", 1)))
    return table(spark, d, "documents").select("doc_id", F.when(F.coalesce(code, F.lit("")) == "", "unknown").otherwise(code).alias("code"))


def i23_turn_positions(spark, d):
    t = table(spark, d, "documents").where("kind = 'dialogue' and text is not null")
    return t.select("doc_id", F.size(F.regexp_extract_all("text", F.lit(r"\[S\d+\]"), F.lit(0))).cast("long").alias("tags"), F.locate("[S2]", F.col("text")).cast("long").alias("first_s2"))


def i25_score_polynomial(spark, d):
    q = F.col("q")
    return _seg(spark, d).select("idx", F.round(q * q * -0.0832 + q * 1.2209 + 0.0052, 6).alias("score"))


def i26_array_summary(spark, d):
    p = F.filter("embedding", lambda x: ~F.isnan(x) & (x > 0))
    total = F.aggregate(F.transform(p, lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return table(spark, d, "embeddings").select("vec_id", F.size(p).cast("long").alias("n"), F.round(total / F.nullif(F.size(p), F.lit(0)), 5).alias("mean"))


_STATUS = "st as (select seg.*, case when f.ok then 'reuse' when f.ok is not null then 'skip' else 'fill' end as status from seg left join (select sid, seg_index, bool_or(coalesce(accepted, false)) as ok from fac group by sid, seg_index) f on f.sid = seg.sid and f.seg_index = seg.seg_index)"
_WIN = "f as (select *, max(e) over (partition by sid order by s, idx rows between unbounded preceding and 1 preceding) as far from {0}), o as (select *, max(case when far is null or s - far > 6000 then s end) over (partition by sid order by s, idx rows unbounded preceding) as win from f)"
_CH = "length(regexp_replace(coalesce({}, ''), '[\\s\\p{{P}}\\p{{Z}}]', '', 'g'))"
ORACLES = {
    "c24_chunk_gates": "select sid, chunk_start, case when (chunk_end - chunk_start) / 1000.0 < 30 then 'too_short' when coalesce(mean_q, 0.0) < 2.4 then 'low_quality' else 'kept' end as reason from (" + sequence_queries.ORACLES["f4_long_chunks"] + ")",
    "c14_posterior_gate": "with p as (select vec_id, list_transform(embedding, lambda x: abs(cast(x as double))) as p from embeddings), q as (select vec_id, p, list_max(p) as b, list_sum(p) as t from p) select vec_id, case when b / t >= 0.05 then list_position(p, b) end as label, round(b / t, 4) as confidence from q",
    "c21_reuse_status": sql("also " + _STATUS + " select idx, status from st", "seg", "fac"),
    "c22_untranscribable": sql("also " + _STATUS + ", g as (select sid, cast(sum(case when status = 'reuse' then e - s else 0 end) as bigint) as reuse, cast(sum(case when status = 'skip' then e - s else 0 end) as bigint) as skip, cast(sum(case when status = 'fill' then e - s else 0 end) as bigint) as fill from st group by sid) select *, case when reuse / (reuse + skip + fill) < 0.05 and skip > fill then 1 else 0 end as hopeless from g", "seg", "fac"),
    "d19_offsets": sql("also i as (select distinct source_tar, source_member from man where txt is not null and source_tar is not null) select man.source_tar, count(*) as rows, cast(sum(case when i.source_tar is null then 1 else 0 end) as bigint) as missing from man left join i on i.source_tar = man.source_tar and i.source_member = man.source_member where man.source_tar is not null group by man.source_tar", "man"),
    "e6_voice_fold": sql("""also v as (select * from seg where spk is not null), g as (select sid, spk, count(*) as n, cast(sum(e - s) as bigint) as ms, count(distinct lang) as n_langs, round(sum(q * (e - s)) / nullif(sum(case when q is not null then e - s end), 0), 6) as q from v group by sid, spk),
        p as (select sid, spk, lang, sum(e - s) as w from v where lang is not null and lang <> '' group by all), k as (select sid, spk, arg_max(lang, (w, lang)) as lang, round(max(w) / sum(w), 6) as lang_share from p group by sid, spk)
        select g.sid, g.spk, n, ms, n_langs, lang, lang_share, q from g left join k on k.sid = g.sid and k.spk = g.spk""", "seg"),
    "f14_run_assembly": sql("also " + _STATUS + ", " + _WIN.format("st") + """, r as (select *, case status when 'reuse' then 'OK' when 'skip' then 'BREAK' else 'SILENCE' end as role from o),
        p as (select *, sum(case when role = 'BREAK' then 1 else 0 end) over (partition by sid, win order by s, idx rows unbounded preceding) as piece from r),
        q2 as (select *, last_value(case when role = 'OK' then e end ignore nulls) over (partition by sid, win, piece order by s, idx rows between unbounded preceding and 1 preceding) as oe from p where role <> 'BREAK'),
        n as (select *, sum(case when role = 'OK' and s - oe > 3000 then 1 else 0 end) over (partition by sid, win, piece order by s, idx rows unbounded preceding) as part from q2),
        b as (select *, min(case when role = 'OK' then (s, idx) end) over g as lo, max(case when role = 'OK' then (s, idx) end) over g as hi from n window g as (partition by sid, win, piece, part)),
        a as (select sid, win, min(s) as run_start, max(e) as run_end, count(*) as n, count(distinct case when role = 'OK' then spk end) as voices from b where (s, idx) >= lo and (s, idx) <= hi group by sid, win, piece, part)
        select sid, win as win_start, run_start, run_end, n, voices from a where run_end - run_start >= 5000 and voices >= 1""", "seg", "fac"),
    "f18_best_window": sql("also " + _WIN.format("seg") + """, j as (select a.sid, a.win, a.s, a.idx, sum(b.e - b.s) as speech, max(b.e) as until from (select distinct sid, win, s, min(idx) as idx from o group by sid, win, s) a join o b on b.sid = a.sid and b.win = a.win and b.s >= a.s and b.e <= a.s + 30000 group by all),
        r as (select *, row_number() over (partition by sid, win order by speech desc, s) as r from j) select sid, win as win_start, s as win_s, until as win_e, cast(speech as bigint) as speech_ms from r where r = 1""", "seg"),
    "f19_stitched": sql("""also v as (select * from nv where turn is not null and nv_text is not null and trim(nv_text) <> ''), l as (select *, lag(turn) over w as pt from v window w as (partition by rec order by rel_start, turn, nv_text, id))
        select rec as id, string_agg(case when pt = turn then nv_text else '[' || turn || '] ' || nv_text end, ' ' order by rel_start, turn, nv_text, id) as transcript from l group by rec""", "nv"),
    "g2_full_locality": sql("select source_tar, id, row_number() over (partition by source_tar order by source_member nulls last, rel_start nulls last, id) as rank from man where source_tar is not null", "man"),
    "h1_concat": sql("select id, txt as text, null as turn from man union all select id, nv_text, turn from nv", "man", "nv"),
    "h8_coverage": sql("select cast(('0x' || substr(md5(id), 32, 1)) as bigint) % 4 as shard, count(*) as n from man where id is not null group by 1", "man"),
    "i2_ngram_repeat": sql("""also w as (select fact_id, list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda x: x <> '') as w, list_filter(string_split(regexp_replace(coalesce(text, ''), '\\s+', '', 'g'), ''), lambda x: x <> '') as c from fac),
        g as (select fact_id, case when len(w) >= 12 then list_transform(range(1, len(w) - 4), lambda i: array_to_string(w[i:i + 5], '|')) when len(c) >= 30 then list_transform(range(1, len(c) - 8), lambda i: array_to_string(c[i:i + 9], '|')) else ['x'] end as g from w),
        u as (select fact_id, unnest(g) as x from g), k as (select fact_id, x, count(*) as n from u group by all) select fact_id, max(n) as most from k group by fact_id""", "fac"),
    "i12_language_names": "with x as (select doc_id, lower(trim(lang)) as l from documents), y as (select doc_id, coalesce(map {'english': 'en', 'german': 'de', 'french': 'fr', 'spanish': 'es', 'portuguese': 'pt', 'russian': 'ru', 'ukrainian': 'uk', 'chinese': 'zh', 'japanese': 'ja', 'korean': 'ko', 'thai': 'th', 'hindi': 'hi'}[l], regexp_extract(l, '^([a-z]{2})(?:[-_].*)?$', 1)) as c from x) select doc_id, case when coalesce(c, '') = '' then 'unknown' else c end as code from y",
    "i23_turn_positions": "select doc_id, len(regexp_extract_all(text, '\\[S\\d+\\]')) as tags, strpos(text, '[S2]') as first_s2 from documents where kind = 'dialogue' and text is not null",
    "i25_score_polynomial": sql("select idx, round(q * q * -0.0832 + q * 1.2209 + 0.0052, 6) as score from seg", "seg"),
    "i26_array_summary": "with p as (select vec_id, list_filter(embedding, lambda x: x > 0) as p from embeddings) select vec_id, len(p) as n, round(list_avg(list_transform(p, lambda x: cast(x as double))), 5) as mean from p",
}

QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "cdefghi" and k[1:2].isdigit()}
