"""Queries of manifests, containers, fact tables and exports, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import exports as P
from ..operators import joins as J
from ..operators import records as R
from ..operators import rules
from ..operators import sequences as S
from ..sources import files, views
from ..sources.tables import table
from ..sources.views import sql
from .rule_queries import CRC_SQL, CRC_TABLE


def _recording(spark, d, col):
    r = table(spark, d, "recordings").where("sid is not null").select("sid", col, "ingested_at")
    return J.last_wins(r, ["sid"], ["ingested_at"]).select("sid", col)


def a5_usable_manifest(spark, d):
    return rules.usable_manifest(views.manifest(spark, d), shard=1, of=4).select("id", "via")


def a6_safe_paths(spark, d):
    m = views.manifest(spark, d)
    return m.select("id", files.safe_path(F.col("wav_path")).cast("int").alias("path_ok"), files.safe_path(F.concat(F.lit("../"), F.col("wav_path"))).cast("int").alias("up_ok"))


def _windows(spark, d):
    r = table(spark, d, "recordings").where("sid is not null").select("sid", "duration", "sample_rate", "ingested_at")
    r = J.last_wins(r, ["sid"], ["ingested_at"]).select(F.col("sid").alias("parent_id"), "sample_rate", (F.col("duration") * F.col("sample_rate")).cast("long").alias("total"))
    m = views.manifest(spark, d).select("id", "parent_id", (F.col("rel_start") * 16_000).cast("long").alias("a"), (F.col("rel_end") * 16_000).cast("long").alias("b"))
    return m.join(r, "parent_id", "left")


def a15_carrier_windows(spark, d):
    why, lo, hi = files.carrier_window(F.col("a"), F.col("b"), 16_000, F.col("sample_rate"), F.col("total"))
    return _windows(spark, d).select("id", why.alias("problem"), lo.alias("from_sample"), hi.alias("to_sample"))


def a16_slice_checks(spark, d):
    # a slice must be at the rate asked for and within its carrier
    w = _windows(spark, d)
    bad = F.when(F.col("sample_rate").isNull() | F.col("a").isNull() | F.col("b").isNull(), "missing").when(F.col("sample_rate") != 16_000, "rate").when((F.col("a") < 0) | (F.col("b") <= F.col("a")) | (F.col("b") > F.col("total")), "bounds")
    return w.select("id", bad.alias("problem"))


def a14_identified(spark, d):
    files = views.manifest(spark, d).where("parent_id is not null").select("id", "parent_id")
    ident = table(spark, d, "dialogue_records").where("id is not null").select(F.col("id").alias("parent_id"), F.concat(F.lit("d_"), "id").alias("sample_id"))
    return P.identified_files(files, ident, "parent_id", "id").select("id", "sample_id", "status")


def a17_pack_index(spark, d):
    m = views.manifest(spark, d).where("source_tar is not null and source_member is not null")
    return J.last_wins(m.select("source_tar", "source_member", "id"), ["source_tar", "source_member"], ["id"])


def a18_worklist(spark, d):
    # listed ids before scanned ones, each once, then a shard by md5
    listed = table(spark, d, "dialogue_records").where("id is not null").select(F.col("id").alias("sid"), F.lit("listed").alias("via"))
    scanned = table(spark, d, "recordings").where("sid is not null").select("sid", F.lit("scanned").alias("via"))
    both = listed.unionByName(scanned).groupBy("sid").agg(F.min("via").alias("via"))
    return both.where(X.hex_modulo(F.md5(F.col("sid").cast("binary")), 3) == 0)


def a19_merged_facts(spark, d):
    f = views.facts(spark, d).select("fact_id", "sid", "seg_index", "text", "asr_model")
    return P.merged_facts(f.where("asr_model = 'asr-base'"), f.where("asr_model <> 'asr-base'"), ["sid", "seg_index"], "fact_id").select("sid", "seg_index", "fact_id", "text")


def a20_scores(spark, d):
    # posteriors as the JSON arrays a scorer writes, read back
    e = table(spark, d, "embeddings").select("vec_id", F.to_json(F.transform("embedding", lambda x, i: F.struct(F.concat(F.lit("l"), i).alias("label"), x.cast("double").alias("score")))).alias("line"))
    return P.parsed_scores(e, "vec_id", "line", strict=False).where("score >= 0.03").select("vec_id", "label", F.round("score", 6).alias("score"))


def a21_line_ids(spark, d):
    line = F.to_json(F.struct("txt", "id", "wav_path"))
    return views.manifest(spark, d).select(P.raw_line_id(line).alias("id"))


def a22_container_entries(spark, d):
    return P.unique_ids(P.container_entries(_recording(spark, d, "languages"), views.segments(spark, d), ["en", "de", "fr", "es", "zh"])).select("id", "idx")


def a23_prepared(spark, d):
    s = views.segments(spark, d)
    return P.unique_ids(s.select(F.concat_ws("_", "sid", "seg_index").alias("id"), F.round((F.col("e") - F.col("s")) / 1000, 3).alias("seconds"), "txt"))


def a24_testset(spark, d):
    return P.packed_testset(_recording(spark, d, "duration"), views.frames(spark, d).select("sid", "idx", "s", "e"), 20.0, 300.0)


def b6_playlist(spark, d):
    s = views.segments(spark, d).where("seg_index is not null")
    return s.select("idx", P.playlist_line(F.concat_ws("_", "sid", "seg_index"), (F.col("e") - F.col("s")) / 1000).alias("line"))


def b9_permanent_failures(spark, d):
    # every transcript that was not accepted is a failed attempt at its recording
    return P.permanent_failures(table(spark, d, "seg_texts").where("not coalesce(accepted, false) and sid is not null"), "sid")


def d21_attached_texts(spark, d):
    # the manifest's texts beside the folded groups of their recordings
    m = views.manifest(spark, d).where("parent_id is not null and txt is not null").select(F.col("parent_id").alias("sid"), "id", "txt")
    g = views.segments(spark, d).groupBy("sid").agg(F.count(F.lit(1)).alias("n_segments"), F.sum(F.col("e") - F.col("s")).alias("speech_ms"))
    return g.join(m, "sid").select("id", "sid", "txt", "n_segments", "speech_ms")


def d22_members(spark, d):
    # every member of a window with its place
    w = S.gap_windows(views.segments(spark, d).select("sid", "idx", "s", "e"))
    return S.placed_members(w).select("idx", F.col("win").alias("win_start"), "place")


def d17_reviewed_spans(spark, d):
    # spans from the tagged rows, decisions from what was verified of them
    nv = views.nv_rows(spark, d).where("nv_tags is not null and rel_start is not null and rel_end is not null and rec <> ''")
    span = nv.select(F.col("rec").alias("sid"), F.round("rel_start", 6).alias("s"), F.round("rel_end", 6).alias("e"), F.coalesce("turn", F.lit("")).alias("spk"), F.array_join(F.array_sort("nv_tags"), "+").alias("tag"), "nv_verified", "id")
    first = J.first_wins(span, ["sid", "s", "e", "spk"], ["id"])
    verdict = F.when(F.col("nv_verified").isNull(), "keep").when(F.size("nv_verified") == 0, "drop").otherwise("replace")
    dec = first.select("sid", "s", "e", "spk", verdict.alias("verdict"), F.when(verdict == "replace", F.array_join(F.array_sort("nv_verified"), "+")).alias("tag"))
    return R.synced_spans(first.select("sid", "s", "e", "spk", "tag"), dec)


_CH = "length(regexp_replace(coalesce({}, ''), '[\\s\\p{{P}}\\p{{Z}}]', '', 'g'))"
_WIN = "f as (select *, max(e) over (partition by sid order by s, idx rows between unbounded preceding and 1 preceding) as far from seg), o as (select *, max(case when far is null or s - far > 6000 then s end) over (partition by sid order by s, idx rows unbounded preceding) as win from f)"
_AW = "also r as (select sid, arg_max_null(duration, ingested_at) as dur, arg_max_null(sample_rate, ingested_at) as rate from recordings where sid is not null group by sid), w as (select id, cast(trunc(rel_start * 16000) as bigint) as a, cast(trunc(rel_end * 16000) as bigint) as b, rate, cast(trunc(dur * rate) as bigint) as total from man left join r on r.sid = man.parent_id)"
ORACLES = {
    "a6_safe_paths": sql("select id, case when trim(wav_path) <> '' and wav_path not like '/%' and not list_contains(string_split(wav_path, '/'), '..') then 1 else 0 end as path_ok, 0 as up_ok from man", "man"),
    "a15_carrier_windows": sql(_AW + ", k as (select id, a, b, rate, total, a * rate // 16000 as x, b * rate // 16000 as y from w), p as (select *, case when a is null or b is null or rate is null or total is null then 'missing' when a < 0 or b <= a then 'bad_bounds' when b - a > 345600000 then 'too_long' when y - total > 1024 then 'past_end' when y > total then 'padded' end as problem from k) select id, problem, case when coalesce(problem, 'padded') = 'padded' then x end as from_sample, case when coalesce(problem, 'padded') = 'padded' then y end as to_sample from p", "man"),
    "a16_slice_checks": sql(_AW + " select id, case when rate is null or a is null or b is null then 'missing' when rate <> 16000 then 'rate' when a < 0 or b <= a or b > total then 'bounds' end as problem from w", "man"),
    "a5_usable_manifest": sql("also " + CRC_TABLE + ", u as (select *, trim(wav_path) <> '' and wav_path not like '/%' and not list_contains(string_split(wav_path, '/'), '..') as inside from man, crct where coalesce(" + CRC_SQL.format("coalesce(parent_id, id)") + " % 4, 0) = 1) select coalesce(id, regexp_extract(coalesce(wav_path, source_member), '([^/]+)$', 1)) as id, case when coalesce(inside, false) then 'path' else 'archive' end as via from u where coalesce(inside, false) or (source_tar is not null and source_member is not null)", "man"),
    "a14_identified": sql("also i as (select distinct id as parent_id, 'd_' || id as sample_id from dialogue_records where id is not null), x as (select man.id, sample_id, row_number() over (partition by man.parent_id order by man.id) as r from man left join i on i.parent_id = man.parent_id where man.parent_id is not null) select id, sample_id, case when sample_id is null then 'missing' when r > 1 then 'duplicate' else 'matched' end as status from x", "man"),
    "a17_pack_index": sql("select source_tar, source_member, max(id) as id from man where source_tar is not null and source_member is not null group by 1, 2", "man"),
    "a18_worklist": "with b as (select id as sid, 'listed' as via from dialogue_records where id is not null union all select sid, 'scanned' from recordings where sid is not null), g as (select sid, min(via) as via from b group by sid), h as (select *, md5(sid) as m from g) select sid, via from h where list_reduce(list_transform(string_split(m, ''), lambda c: cast('0x' || c as bigint)), lambda a, x: (a * 16 + x) % 3, 0::bigint) = 0",
    "a19_merged_facts": sql("also r as (select *, row_number() over (partition by sid, seg_index order by case when asr_model = 'asr-base' then 0 else 1 end desc, fact_id desc) as r from fac where asr_model is not null) select sid, seg_index, fact_id, text from r where r = 1", "fac"),
    "a20_scores": "with x as (select vec_id, 'l' || (generate_subscripts(embedding, 1) - 1) as label, cast(unnest(embedding) as double) as v from embeddings) select vec_id, label, round(v, 6) as score from x where v >= 0.03",
    "a21_line_ids": sql("select id from man", "man"),
    "a22_container_entries": sql("also r as (select sid, arg_max_null(languages, ingested_at) as languages from recordings where sid is not null group by sid), k as (select sid from r where len(languages) > 0 and len(list_filter(languages, lambda x: x not in ('en', 'de', 'fr', 'es', 'zh'))) = 0), n as (select sid, idx, s, e, row_number() over (partition by sid order by s, idx) - 1 as k from seg where sid in (select sid from k)) select format('{}_{:04d}', sid, k) as id, idx from n where e - s >= 500", "seg"),
    "a23_prepared": sql("select concat_ws('_', sid, seg_index) as id, round((e - s) / 1000.0, 3) as seconds, txt from seg", "seg"),
    "a24_testset": sql("also r as (select sid, arg_max_null(duration, ingested_at) as duration from recordings where sid is not null group by sid), t as (select frm.sid, idx, greatest(s, 0) as s, least(e, cast(round(duration * 1000) as bigint)) as e from frm join r on r.sid = frm.sid where duration between 20.0 and 300.0) select * from t where e > s", "frm"),
    "b6_playlist": sql("select idx, format('#EXTINF:{:.3f},{}_{}', (e - s) / 1000.0, sid, seg_index) || chr(10) || sid || '_' || seg_index || '.flac' as line from seg where seg_index is not null", "seg"),
    "b9_permanent_failures": "select sid, count(*) as attempts from seg_texts where not coalesce(accepted, false) and sid is not null group by sid having count(*) >= 3",
    "d21_attached_texts": sql("also g as (select sid, count(*) as n_segments, cast(sum(e - s) as bigint) as speech_ms from seg group by sid) select man.id, g.sid, txt, n_segments, speech_ms from g join man on man.parent_id = g.sid where txt is not null", "seg", "man"),
    "d22_members": sql("also " + _WIN + " select idx, win as win_start, row_number() over (partition by sid, win order by s, idx) as place from o", "seg"),
    "d17_reviewed_spans": sql("also p as (select rec as sid, round(rel_start, 6) as s, round(rel_end, 6) as e, coalesce(turn, '') as spk, array_to_string(list_sort(nv_tags), '+') as tag, nv_verified, id from nv where nv_tags is not null and rel_start is not null and rel_end is not null and rec <> ''), r as (select *, row_number() over (partition by sid, s, e, spk order by id) as r from p) select sid, s, e, spk, case when len(nv_verified) > 0 then array_to_string(list_sort(nv_verified), '+') else tag end as tag from r where r = 1 and (nv_verified is null or len(nv_verified) > 0)", "nv"),
}

QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "abd" and k[1:2].isdigit()}
