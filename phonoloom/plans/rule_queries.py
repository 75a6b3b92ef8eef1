"""Queries of the ordered rules, routes, names and label functions, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import scalars as X
from ..operators import joins as J
from ..operators import rules as R
from ..sources import views
from ..sources.tables import table
from ..sources.views import sql
from . import verdict_queries


def _seg(spark, d):
    return views.segments(spark, d)


def _sec():
    return (F.col("e") - F.col("s")) / 1000


def _recording(spark, d, *cols):
    r = table(spark, d, "recordings").where("sid is not null").select("sid", *cols, "ingested_at")
    return J.last_wins(r, ["sid"], ["ingested_at"])


def _heard(spark, d):
    """Facts with their segment's times and the repetition of their text."""
    f = views.facts(spark, d).select("fact_id", "sid", "seg_index", "text", "language", "accepted")
    return R.with_repetition(f, "text").join(_seg(spark, d).select("sid", "seg_index", "idx", "s", "e"), ["sid", "seg_index"])


def c1_carried(spark, d):
    return views.manifest(spark, d).select("id", "wav_path", "lang", "parent_id", X.char_count(F.col("txt")).cast("long").alias("chars"))


def c4_chunk_verdict(spark, d):
    h = _heard(spark, d)
    return h.select("fact_id", R.chunk_verdict(F.col("text"), F.col("language"), F.col("accepted"), _sec(), F.col("repeated"), 2).alias("reason"))


def c28_roles(spark, d):
    return c4_chunk_verdict(spark, d).select("fact_id", R.role_of(F.col("reason")).alias("role"))


def c7_accepted(spark, d):
    return table(spark, d, "documents").select("doc_id", L.accepted_language(F.lower(F.trim("lang"))).cast("int").alias("accepted"))


def c8_routes(spark, d):
    final = views.facts(spark, d).where("accepted").select("sid", "seg_index")
    return R.routed(_seg(spark, d).select("idx", "sid", "seg_index", "lang"), final, ["sid", "seg_index"], "lang").where("route <> 'unsupported'").select("idx", "route")


def c9_unsupported(spark, d):
    m = views.manifest(spark, d).select("id", "lang")
    return R.routed(m, m.limit(0).select("id"), ["id"], "lang").where("route = 'unsupported'").select("id")


def c11_views(spark, d):
    v = F.when(F.contains("source_member", F.lit("_long_")), "long").when(F.contains("source_member", F.lit("_dlg_")), "dialogue").otherwise("short")
    return views.manifest(spark, d).where("source_member is not null").select("id", v.alias("view"))


def c13_input_gates(spark, d):
    return _recording(spark, d, "sample_rate", "duration").select("sid", R.input_gate(F.col("sample_rate"), F.col("duration"), F.lit(None).cast("int")).alias("gate"))


def c26_asr_need(spark, d):
    # the table has no utterance counts that could stand for a text
    return views.manifest(spark, d).where(F.trim(F.coalesce("txt", F.lit(""))) == "").select("id")


def c27_rescues(spark, d):
    f = views.facts(spark, d)
    done = f.where("accepted").select("sid", "seg_index").distinct()
    second = J.first_wins(f.select("sid", "seg_index", "fact_id", F.col("text").alias("heard")), ["sid", "seg_index"], ["fact_id"])
    units = _seg(spark, d).join(done, ["sid", "seg_index"], "left_anti").join(second, ["sid", "seg_index"]).select("idx", "heard", "s", "e")
    return R.rescued(units, "heard", _sec()).select("idx", "rescue")


def c29_placed(spark, d):
    r = _recording(spark, d, "duration").select(F.col("sid").alias("parent_id"), "duration")
    m = views.manifest(spark, d).select("id", "parent_id", "rel_start", "rel_end").join(r, "parent_id", "left")
    why, lo, hi = R.placed_interval(F.lit(0.0), F.col("duration"), F.col("rel_start"), F.col("rel_end"))
    return m.select("id", why.alias("problem"), lo.alias("placed_start"), hi.alias("placed_end"))


def c30_safe_names(spark, d):
    return views.manifest(spark, d).select("id", R.safe_name(F.col("source_member")).cast("int").alias("member_ok"), R.safe_name(F.col("wav_path")).cast("int").alias("path_ok"))


def d4_dialect_fusion(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source", F.lower(F.trim("lang")).alias("code"))
    return docs.select("doc_id", F.when(L.accent_head(F.col("code")).isNotNull(), L.cascaded_dialect(F.col("text"), F.col("source"))).otherwise(F.col("source")).alias("variety"))


def g6_language_report(spark, d):
    # the feature is a top-k report
    n = _seg(spark, d).where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("e") - F.col("s")).alias("ms"))
    return n.orderBy(F.desc("ms"), "lang").limit(10)


def i7_speed_labels(spark, d):
    n = F.coalesce(X.char_count(F.col("txt")), F.lit(0))
    return _seg(spark, d).select("idx", L.speed_label(X.speech_rate(n, _sec()), F.lower(F.trim("lang"))).alias("pace"))


def i10_age_bands(spark, d):
    # two estimates of an age from the measured columns
    return _seg(spark, d).select("idx", L.age_of(F.when(F.col("q") > 4.2, "child"), F.col("q") * 12, F.when(_sec() < 20, _sec() * 4)).alias("band"))


def i11_dialects(spark, d):
    return table(spark, d, "documents").select("doc_id", L.cascaded_dialect(F.col("text"), F.col("source")).alias("variety"))


def i12_codes(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", L.name_code(F.col("lang")).alias("code"), L.is_dialect(F.col("lang")).cast("int").alias("dialect"), L.lid_is_dialect(F.col("lang")).cast("int").alias("lid_dialect"))


def i20_recovered_ids(spark, d):
    stem = F.concat(F.lpad(F.col("idx").cast("string"), 7, "0"), F.lit("_"), F.col("seg_index"))
    return _seg(spark, d).select("idx", X.clip_id(stem).alias("clip"))


def i22_sounds(spark, d):
    t = table(spark, d, "documents").where("text is not null")
    mid = F.floor(F.length("text") / 2).cast("int")
    lo = F.greatest(F.lit(0), mid - 80)
    context = F.substring(F.col("text"), lo + 1, F.least(F.length("text"), mid + 80) - lo)
    return t.select("doc_id", R.sound_for(context, F.concat(F.col("doc_id").cast("string"), F.lit(":1"))).alias("sound"))


def i23_boundaries(spark, d):
    t = table(spark, d, "documents").where("text is not null")
    who = R.speaker_at(F.col("text"), F.floor(F.length("text") / 2))
    b = F.col("b")
    return t.withColumn("b", R.boundaries(F.col("text"))).select("doc_id", F.size(b).cast("long").alias("n"), F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), who.alias("speaker"))


def i25_quality_scores(spark, d):
    q = F.col("q")
    cols = [F.round(X.polynomial(q, c), 6).alias(f"{p}{n}") for p, t in (("", X.QUALITY), ("own_", X.QUALITY_PERSONAL)) for n, c in t.items()]
    return _seg(spark, d).where("q is not null").select("idx", *cols)


def i26_pitch(spark, d):
    hz = F.filter(F.transform("embedding", lambda x: x.cast("double") * 1000), lambda x: ~F.isnan(x) & (F.abs(x) < 1e9) & (x > 0))
    mean = F.aggregate(hz, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(hz), F.lit(0))
    return table(spark, d, "embeddings").select("vec_id", F.round(mean, 1).alias("hz"), X.pitch_label(mean, F.when(F.col("label") == 0, "male")).alias("pitch"))


def j12_exits(spark, d):
    s = verdict_queries._status(spark, d).groupBy("sid").agg(F.max((F.col("status") == "skip").cast("int")).alias("failed"), F.max((F.col("status") == "fill").cast("int")).alias("stopped"))
    return s.select("sid", F.when(F.col("failed") == 1, "failed").when(F.col("stopped") == 1, "stopped").otherwise("done").alias("state"))


def k10_heads(spark, d):
    return _seg(spark, d).select("idx", L.accent_head(F.lower(F.trim("lang"))).alias("head"))


def l2_dispatch(spark, d):
    m = views.manifest(spark, d).where("id is not null").select("id", "parent_id")
    r = views.records(spark, d).where("speakers is not null and size(speakers) > 0").select(F.col("id").alias("parent_id")).withColumn("voices", F.lit(True))
    form = F.element_at(F.array(*[F.lit(x) for x in ("free", "aps", "dsd", "rp")]), (X.draw("", 0, F.col("id"), 4) + 1).cast("int"))
    tongue = F.element_at(F.array(F.lit("en"), F.lit("zh")), (X.draw("lang:", 0, F.col("id"), 2) + 1).cast("int"))
    example = F.when(form == "rp", X.hex_modulo(F.md5(F.concat(F.lit("rpex:"), "id").cast("binary")), 2))
    return m.join(r, "parent_id", "left").select("id", form.alias("form"), tongue.alias("tongue"), F.when(F.col("voices"), "dialogue").otherwise("clip").alias("builder"), example.alias("example"))


def c31_prompt_fits(spark, d):
    # characters stand for tokens here; the tokenizers belong to another part
    return table(spark, d, "documents").select("doc_id", R.prompt_fits(F.col("n_chars"), 512).cast("int").alias("fits"))


def l5_tagged_texts(spark, d):
    t = table(spark, d, "documents").where("kind in ('long', 'dialogue')")
    return R.tagged_texts(t.select(F.col("doc_id").alias("id"), "text", (F.col("n_chars") / 12.0).alias("seconds")))


def f25_insertions(spark, d):
    t = table(spark, d, "documents").where("kind in ('long', 'dialogue')")
    return R.insertions(t.select(F.col("doc_id").alias("id"), "text", (F.col("n_chars") / 12.0).alias("seconds")))


# shares of repeated runs of 4 words, or of 8 letters and digits below 18 words
_REP = """rw as (select fact_id, lower(coalesce(text, '')) as l from fac), ru as (select fact_id, regexp_extract_all(l, '[\\p{L}\\p{N}]+') as ws, regexp_extract_all(l, '[\\p{L}\\p{N}]') as cs from rw),
    rx as (select fact_id, 4 as n, len(ws) as m, unnest(ws) as x, generate_subscripts(ws, 1) as i from ru where len(ws) >= 18 union all select fact_id, 8, len(cs), unnest(cs), generate_subscripts(cs, 1) from ru where len(ws) < 18 and len(cs) >= 30),
    rg as (select *, string_agg(x, '|') over (partition by fact_id order by i rows between current row and 3 following) as gram from rx where n = 4 union all select *, string_agg(x, '|') over (partition by fact_id order by i rows between current row and 7 following) from rx where n = 8),
    rc as (select *, case when i <= m - n + 1 and count(*) over (partition by fact_id, gram, i <= m - n + 1) >= 5 then 1 else 0 end as hit from rg),
    rv as (select fact_id, case when n = 4 then max(hit) over (partition by fact_id order by i rows between 3 preceding and current row) else max(hit) over (partition by fact_id order by i rows between 7 preceding and current row) end as h from rc),
    rep as (select fac.fact_id, coalesce(p, 0.0) as repeated from fac left join (select fact_id, sum(h) / count(*) as p from rv group by fact_id) z using (fact_id))"""
_CH = "length(regexp_replace(coalesce({}, ''), '[\\s\\p{{P}}\\p{{Z}}]', '', 'g'))"
_RATIO = "({sec} > 0 and {ch} > 0 and {sec} / {ch} >= case when lower(trim({lang})) in ('zh', 'yue', 'ja', 'ko', 'th') then 0.04 else 0.015 end and {sec} / {ch} <= case when lower(trim({lang})) in ('zh', 'yue', 'ja', 'ko', 'th') then 2.0 else 1.0 end)"
_C4 = "also " + _REP + ", h as (select fac.*, repeated, (e - s) / 1000.0 as sec, " + _CH.format("text") + " as ch from fac join rep using (fact_id) join seg on seg.sid = fac.sid and seg.seg_index = fac.seg_index), vd as (select fact_id, case when trim(coalesce(text, '')) = '' and coalesce(language, '') = '' then 'no_result' when not coalesce(accepted, false) then 'lang_rejected' when repeated >= 0.8 then 'asr_repetition' when ch = 0 then 'blank' when ch < 2 then 'too_short' when not coalesce(" + _RATIO.format(sec="sec", ch="ch", lang="language") + ", false) then 'ratio' end as reason from h)"
_OK = "(" + ", ".join(f"'{c}'" for c in L.NAMES.values() if c not in L.SKIPPED) + ")"
_NAME = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in L.NAMES.items()) + "}"
_REGION = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in L.REGIONS.items()) + "}"
_HEAD = "case {c} when 'en' then 'voxlect_english' when 'zh' then 'voxlect_mandarin' when 'yue' then 'voxlect_mandarin' when 'ar' then 'voxlect_arabic' end"
_DIAL = "case when contains({t}, 'north') or contains({t}, 'other') then {f} when contains({t}, 'mandarin') then 'Standard Mandarin' when contains({t}, 'xinan') then 'Southwestern' when contains({t}, 'yue') then 'Cantonese' when contains({t}, 'wu') then 'wu' when contains({t}, 'min') then 'min' when contains({t}, 'xiang') then 'xiang' else {f} end"
_LAST = "rc1 as (select sid, arg_max_null({0}, ingested_at) as {0} from recordings where sid is not null group by sid)"


def _said(word: str) -> str:
    if word.isascii() and word.replace("'", "").replace(" ", "").isalpha():
        return f"cast(regexp_matches(c, '(^|[^A-Za-z]){word}([^A-Za-z]|$)', 'i') as int)"
    return f"cast(contains(lower(c), '{word}') as int)"


_SCORES = ", ".join(" + ".join(_said(w) for w in words) + f" as {tag.lower()}" for tag, words in R.KEYWORDS.items())
#: crc32 of an ASCII string in SQL: the table of the bytes by eight shifts, then one step a character
CRC_SQL = "xor(list_reduce(list_transform(string_split({0}, ''), lambda ch: cast(unicode(ch) as bigint)), lambda acc, b: xor(acc >> 8, crc_table[cast((xor(acc, b) & 255) as int) + 1]), 4294967295::bigint), 4294967295::bigint)"
CRC_TABLE = "crct as (select list_transform(range(0, 256), lambda n: list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, n)) as crc_table)"

ORACLES = {
    "c1_carried": sql("select id, wav_path, lang, parent_id, length(regexp_replace(txt, '[\\s\\p{P}\\p{Z}]', '', 'g')) as chars from man", "man"),
    "c4_chunk_verdict": sql(_C4 + " select fact_id, reason from vd", "fac", "seg"),
    "c28_roles": sql(_C4 + " select fact_id, case when reason is null then 'OK' when reason in ('blank', 'too_short') then 'SILENCE' else 'BREAK' end as role from vd", "fac", "seg"),
    "c7_accepted": f"select doc_id, case when lower(trim(lang)) in {_OK} then 1 else 0 end as accepted from documents",
    "c8_routes": sql(f"also fi as (select distinct sid, seg_index from fac where accepted), k as (select idx, lower(trim(coalesce(lang, ''))) as l, fi.sid is not null as final from seg left join fi on fi.sid = seg.sid and fi.seg_index = seg.seg_index) select idx, case when l in {_OK} and not final then 'secondary' else 'primary' end as route from k where l in {_OK} or l in ('', 'unknown')", "seg", "fac"),
    "c9_unsupported": sql(f"select id from man where lower(trim(coalesce(lang, ''))) not in {_OK} and lower(trim(coalesce(lang, ''))) not in ('', 'unknown')", "man"),
    "c11_views": sql("select id, case when contains(source_member, '_long_') then 'long' when contains(source_member, '_dlg_') then 'dialogue' else 'short' end as \"view\" from man where source_member is not null", "man"),
    "c13_input_gates": "with r as (select sid, arg_max_null(sample_rate, ingested_at) as rate, arg_max_null(duration, ingested_at) as dur from recordings where sid is not null group by sid) select sid, case when coalesce(rate, 0) < 24000 then 'low_rate' when dur >= 18000 then 'too_long' when dur * rate * 8 > 3500000000 then 'too_large' end as gate from r",
    "c26_asr_need": sql("select id from man where trim(coalesce(txt, '')) = ''", "man"),
    "c27_rescues": sql("also " + _REP + ", mr as (" + verdict_queries.ORACLES["i2_ngram_repeat"] + """), dn as (select distinct sid, seg_index from fac where accepted), sc as (select sid, seg_index, min(fact_id) as fact_id from fac group by sid, seg_index),
        u as (select idx, (e - s) / 1000.0 as sec, text, repeated, most, """ + _CH.format("text") + """ as ch from seg join sc on sc.sid = seg.sid and sc.seg_index = seg.seg_index join fac on fac.fact_id = sc.fact_id join rep on rep.fact_id = sc.fact_id join mr on mr.fact_id = sc.fact_id where not exists (select 1 from dn where dn.sid = seg.sid and dn.seg_index = seg.seg_index))
        select idx, case when trim(coalesce(text, '')) = '' then 'blank' when ch > 80 and sec > 0 and ch / sec > 25 and most >= 3 then 'degenerate' when repeated >= 0.8 then 'asr_repetition' else 'ok' end as rescue from u""", "seg", "fac"),
    "c31_prompt_fits": "select doc_id, case when n_chars + 512 <= 8192 then 1 else 0 end as fits from documents",
    "c29_placed": sql("also " + _LAST.format("duration") + ", j as (select id, rel_start as a, rel_end as b, duration as hi from man left join rc1 on rc1.sid = man.parent_id), k as (select *, case when a is null or b is null or hi is null then 'missing' when b <= a then 'empty' when a >= hi or b <= 0 then 'outside' end as problem from j) select id, problem, case when problem is null then greatest(0.0, a) end as placed_start, case when problem is null then least(b, hi) end as placed_end from k", "man"),
    "c30_safe_names": sql("select id, case when trim(source_member) <> '' and not contains(source_member, '/') and not contains(source_member, '\\') and source_member not in ('.', '..') then 1 else 0 end as member_ok, case when trim(wav_path) <> '' and not contains(wav_path, '/') and not contains(wav_path, '\\') and wav_path not in ('.', '..') then 1 else 0 end as path_ok from man", "man"),
    "d4_dialect_fusion": "with x as (select doc_id, source, lower(trim(lang)) as c, lower(coalesce(text, '')) as t from documents) select doc_id, case when (" + _HEAD.format(c="c") + ") is not null then " + _DIAL.format(t="t", f="source") + " else source end as variety from x",
    "g6_language_report": sql("select lang, count(*) as n, cast(sum(e - s) as bigint) as ms from seg where lang is not null group by lang order by ms desc, lang limit 10", "seg"),
    "i7_speed_labels": sql("also r as (select idx, lower(trim(lang)) as l, case when (e - s) / 1000.0 >= 0.5 and " + _CH.format("txt") + " > 0 then " + _CH.format("txt") + " / ((e - s) / 1000.0) end as r from seg), g as (select *, map {" + ", ".join(f"'{k}': [{v[0]}::double, {v[1]}::double]" for k, v in L.SPEED_EDGES.items()) + "}[l] as g from r) select idx, case when r is null or g is null then null when r < g[1] then 'slow' when r > g[2] then 'fast' else 'measured' end as pace from g", "seg"),
    "i10_age_bands": sql("also a as (select idx, q, q * 12 as a, case when (e - s) / 1000.0 < 20 then (e - s) / 1000.0 * 4 end as b from seg), m as (select idx, q, case when a is null then b when b is null then a else (a + b) / 2 end as y from a) select idx, case when q > 4.2 then 'child' when y is null then null when y < 13 then 'child' when y < 18 then 'teen' when y < 43 then 'young' when y < 60 then 'middle' else 'senior' end as band from m", "seg"),
    "i11_dialects": "with x as (select doc_id, source, lower(coalesce(text, '')) as t from documents) select doc_id, " + _DIAL.format(t="t", f="source") + " as variety from x",
    "i12_codes": "with x as (select doc_id, lower(trim(coalesce(lang, ''))) as l from documents), y as (select *, trim(split_part(l, ',', 1)) as h, string_split_regex(l, '\\s+') as p from x) select doc_id, case when l = '' then 'unk' else coalesce(" + _NAME + "[h], " + _REGION + "[l], case when contains(l, 'cantonese') then 'yue' end, 'unknown') end as code, case when h <> '' and " + _NAME + "[h] is null then 1 else 0 end as dialect, case when len(p) >= 2 and p[1] = 'zh' and p[2] in (" + ", ".join(f"'{x}'" for x in L.DIALECTS) + ") then 1 else 0 end as lid_dialect from y",
    "i16_crc_shard": sql("also " + CRC_TABLE + " select id, " + CRC_SQL.format("coalesce(parent_id, id)") + " % 8 as shard from man, crct where id is not null", "man"),
    "i20_recovered_ids": sql("select idx, nullif(regexp_extract(lpad(cast(idx as varchar), 7, '0') || '_' || seg_index, '^[0-9]{7}_(.+)$', 1), '') as clip from seg", "seg"),
    "i22_sounds": "with t as (select doc_id, text, length(text) as n, length(text) // 2 as m from documents where text is not null), x as (select doc_id, substr(text, cast(greatest(0, m - 80) as int) + 1, cast(least(n, m + 80) - greatest(0, m - 80) as int)) as c from t), s as (select doc_id, " + _SCORES + " from x) select doc_id, case when laughter + crying + sigh = 0 then ['Breathing', 'Breathing', 'Breathing', 'Laughter', 'Sigh', 'Breathing', 'Cough', 'Cough'][cast(cast('0x' || substr(sha256(doc_id || ':1'), 1, 8) as bigint) % 8 as int) + 1] when laughter >= crying and laughter >= sigh then 'Laughter' when crying >= sigh then 'Crying' else 'Sigh' end as sound from s",
    "i23_boundaries": "with t as (select doc_id, text, string_split(regexp_replace(text, '([.!?。！？；;，,][\\s\\p{Z}]*)', '\\1' || chr(1), 'g'), chr(1)) as p from documents where text is not null), l as (select doc_id, text, list_transform(p, lambda x: length(x)) as ls from t), e as (select doc_id, text, list_distinct(list_transform(range(0, len(ls) + 1), lambda k: coalesce(list_sum(ls[1:k]), 0))) as b from l) select doc_id, len(b) as n, cast(list_sum(b) as bigint) as total, nullif(regexp_extract(substr(text, 1, cast(length(text) // 2 as int) + 1), '(?s).*\\[(S\\d+)\\]', 1), '') as speaker from e",
    "i25_quality_scores": sql("select idx, " + ", ".join("round(" + _p + f", 6) as {pre}{n}" for pre, t in (("", X.QUALITY), ("own_", X.QUALITY_PERSONAL)) for n, c in t.items() for _p in [" + ".join(f"({v}) * pow(q, {len(c) - 1 - i})" for i, v in enumerate(c))]) + " from seg where q is not null", "seg"),
    "i26_pitch": "with h as (select vec_id, label, list_filter(list_transform(embedding, lambda x: cast(x as double) * 1000), lambda x: x > 0) as h from embeddings), m as (select vec_id, label, list_sum(h) / nullif(len(h), 0) as m from h) select vec_id, round(m, 1) as hz, case when m is null then null when label = 0 then case when m < 115.7 then 'low' when m > 149.7 then 'high' else 'medium' end else case when m < 141.6 then 'low' when m > 184.5 then 'high' else 'medium' end end as pitch from m",
    "j12_exits": sql("also " + verdict_queries._STATUS + " select sid, case when max(case when status = 'skip' then 1 else 0 end) = 1 then 'failed' when max(case when status = 'fill' then 1 else 0 end) = 1 then 'stopped' else 'done' end as state from st group by sid", "seg", "fac"),
    "k10_heads": sql("select idx, " + _HEAD.format(c="lower(trim(lang))") + " as head from seg", "seg"),
    "l2_dispatch": sql("also r as (select distinct id from rec where cardinality(speakers) > 0), m as (select man.id, r.id is not null as v, cast(('0x' || substr(md5('0:' || man.id), 32, 1)) as int) % 4 as f, cast(('0x' || substr(md5('lang:0:' || man.id), 32, 1)) as int) % 2 as t, cast(('0x' || substr(md5('rpex:' || man.id), 32, 1)) as bigint) % 2 as x from man left join r on r.id = man.parent_id) select id, ['free', 'aps', 'dsd', 'rp'][f + 1] as form, ['en', 'zh'][t + 1] as tongue, case when v then 'dialogue' else 'clip' end as builder, case when f = 3 then x end as example from m", "man", "rec"),
}
ORACLES["i3_repeated_share"] = sql("also " + _REP + " select fact_id, round(repeated, 6) as share from rep", "fac")

QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "cdefgijkl" and k[1:2].isdigit()}
