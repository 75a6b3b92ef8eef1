"""Queries of the aggregations, marks and scalar functions, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import folds as A
from ..operators import joins as J
from ..operators.ordered import ranged_rank
from ..sources import views
from ..sources.tables import table
from ..sources.views import sql


def _w():
    """Length of a segment in milliseconds."""
    return F.col("e") - F.col("s")


def _seg(spark, d):
    return views.segments(spark, d)


def _rated(spark, d):
    """Segments with characters, seconds and rate."""
    n, sec = F.coalesce(X.char_count(F.col("txt")), F.lit(0)).cast("long"), _w() / 1000
    return _seg(spark, d).withColumn("chars", n).withColumn("sec", sec).withColumn("rate", X.speech_rate(F.col("chars"), F.col("sec")))


def e1_weighted_vote(spark, d):
    return A.weighted_vote(_seg(spark, d), ["sid"], "lang", _w())


def e2_weighted_mean(spark, d):
    return A.weighted_mean(_seg(spark, d), ["sid"], "q", _w())


def e3_energy_mean(spark, d):
    return A.energy_mean(_seg(spark, d), ["sid"], F.col("q") * -10, _w())


def e4_posterior_mean(spark, d):
    return A.posterior_mean(table(spark, d, "embeddings"), ["label"], "embedding")


def e5_top_positions(spark, d):
    return A.posterior_mean(table(spark, d, "embeddings"), ["label"], "embedding").where("rank <= 3").select("label", "rank", "pos", "mean")


def e8_grouped_voices(spark, d):
    g = A.grouped_voices(_seg(spark, d), "sid", "spk")
    return g.select("sid", "orphans", F.explode_outer("voices").alias("spk", "v")).select("sid", "orphans", "spk", F.col("v.n").alias("n"), F.col("v.ms").alias("ms"))


def e11_covering_languages(spark, d):
    return A.covering_labels(_seg(spark, d).where("trim(txt) <> '' and lang <> 'unknown'"), ["sid"], "lang", _w())


def e12_majority_language(spark, d):
    s = _seg(spark, d).withColumn("l", F.lower(F.trim("lang"))).where("l is not null and l <> '' and l <> 'unknown'")
    g = s.groupBy("sid", "l").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("s", "idx")).alias("first"))
    return g.groupBy("sid").agg(F.max(F.struct("n", (-F.col("first.s")).alias("a"), (-F.col("first.idx")).alias("b"), "l")).alias("x")).select("sid", F.col("x.l").alias("lang"), F.col("x.n").alias("n"))


def e16_tag_counts(spark, d):
    return A.tag_counts(views.nv_rows(spark, d), ["rec"], "nv_tags")


def e17_speaker_tag_counts(spark, d):
    return A.tag_counts(views.nv_rows(spark, d).where("turn is not null"), ["rec", "turn"], "nv_tags")


def e18_segment_counters(spark, d):
    nv = views.nv_rows(spark, d).groupBy("rec").agg(F.count(F.lit(1)).alias("nv"), F.sum(F.coalesce(F.array_contains("nv_tags", "Humming").cast("int"), F.lit(0))).alias("sung"))
    r = views.records(spark, d).select("id")
    return r.join(nv, r["id"] == nv["rec"], "left").select("id", F.coalesce("nv", F.lit(0)).alias("nv_segments"), F.coalesce("sung", F.lit(0)).alias("nv_sung_segments"), F.col("nv").isNotNull().cast("int").alias("annotated"))


def e19_indexed_quantiles(spark, d):
    return A.indexed_quantiles(table(spark, d, "documents"), ["kind"], "n_chars", [0.1, 0.5, 0.9])


def e19_coverage(spark, d):
    m = views.manifest(spark, d)
    return m.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"has_{c}") for c in ("wav_path", "txt", "lang", "parent_id")])


def e19_top_sources(spark, d):
    # the feature is a top-k report
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source").limit(5)


def e20_survey(spark, d):
    t = table(spark, d, "documents").withColumn("lang", F.coalesce("lang", F.lit("none")))
    p = t.groupBy("source", "lang").pivot("kind", ["long", "dialogue", "caption", "short", "subtitle"]).agg(F.sum("n_chars"))
    return p.na.fill(0, ["long", "dialogue", "caption", "short", "subtitle"])


def e20_rollup(spark, d):
    t = table(spark, d, "documents")
    return t.rollup("source", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.grouping_id().cast("long").alias("level"))


def e21_speed_edges(spark, d):
    return A.speed_edges(_rated(spark, d), "lang", "rate")


def e24_row_languages(spark, d):
    s = _seg(spark, d).where("lang is not null and trim(lang) <> ''").groupBy("sid", "lang").agg(F.min(F.struct("s", "idx")).alias("first"))
    return s.groupBy("sid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "lang"))), lambda x: x["lang"]), ",").alias("languages"))


def e25_tag_deltas(spark, d):
    nv = views.nv_rows(spark, d)
    both = nv.select(F.explode("nv_tags").alias("tag"), F.lit(-1).alias("v")).unionByName(nv.select(F.explode("nv_verified").alias("tag"), F.lit(1).alias("v")))
    return both.groupBy("tag").agg(F.sum(F.when(F.col("v") < 0, 1).otherwise(0)).alias("before"), F.sum(F.when(F.col("v") > 0, 1).otherwise(0)).alias("after"), F.sum("v").alias("delta"))


def e26_enrichment(spark, d):
    nv = views.nv_rows(spark, d).where("nv_tags is not null")
    r = nv.select(F.array_contains("nv_tags", "Cough").alias("cand"), (F.size(F.coalesce("nv_verified", F.array().cast("array<string>"))) > 0).cast("int").alias("pass"))
    return r.groupBy("cand").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("pass"), 6).alias("pass_rate"))


def e27_recording_quality(spark, d):
    return _seg(spark, d).groupBy("sid").agg(F.round(F.coalesce(F.avg("q"), F.lit(0.0)), 6).alias("mos"))


def e28_tag_survival(spark, d):
    nv = views.nv_rows(spark, d).where("nv_tags is not null").select("id", F.explode(F.array_distinct("nv_tags")).alias("tag"), F.coalesce("nv_verified", F.array().cast("array<string>")).alias("ok"))
    g = nv.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum(F.array_contains("ok", F.col("tag")).cast("int")).alias("kept"))
    return g.select("tag", "n", "kept", F.round(F.col("kept") / F.col("n"), 6).alias("kept_share"))


def c2_quality_marks(spark, d):
    s, sec = _seg(spark, d), _w() / 1000
    floor = X.by_language(F.col("lang"), {"zh": 3.0, "en": 3.0}, 2.4)
    reason = F.when(sec < 0.5, "duration_too_short").when(sec > 30, "duration_too_long").when(F.col("q").isNull(), "missing_quality").when(F.col("q") < floor, "low_quality")
    return s.select("idx", reason.alias("reason"))


def c5_ratio_bounds(spark, d):
    return _rated(spark, d).select("idx", X.seconds_per_char_ok(F.col("sec"), F.col("chars"), F.col("lang")).cast("int").alias("ok"))


def c6_confidence_gate(spark, d):
    f = views.facts(spark, d)
    conf = F.try_element_at("extra", F.lit("lid_confidence")).cast("double")
    return f.select("fact_id", F.when(F.col("language").isNull() | (F.trim("language") == "") | (F.coalesce(conf, F.lit(0.0)) < 0.8), "unknown").otherwise(F.split("language", " ")[0]).alias("lang"))


def c10_language_subset(spark, d):
    r = J.last_wins(table(spark, d, "recordings").where("sid is not null").select("sid", "languages", "ingested_at"), ["sid"], ["ingested_at"])
    wanted = F.array(*[F.lit(x) for x in ("en", "de", "fr", "es")])
    return r.where((F.size("languages") > 0) & (F.size(F.array_except("languages", wanted)) == 0)).select("sid")


def c12_clamped(spark, d):
    r = J.last_wins(table(spark, d, "recordings").where("sid is not null").select("sid", "duration", "ingested_at"), ["sid"], ["ingested_at"]).select("sid", F.round(F.col("duration") * 1000).cast("long").alias("dur"))
    s = _seg(spark, d).join(r, "sid", "left")
    why = F.when(F.col("dur").isNull(), "no_duration").when(F.col("s") >= F.col("dur"), "starts_past_end").when(F.least("e", "dur") - F.col("s") < 500, "too_short")
    return s.select("idx", F.coalesce(why, F.lit("kept")).alias("reason"), F.least("e", "dur").alias("end_ms"))


def c17_verified(spark, d):
    nv = views.nv_rows(spark, d).where("nv_tags is not null")
    ok = F.coalesce("nv_verified", F.array().cast("array<string>"))
    return nv.select("id", F.array_join(F.filter("nv_tags", lambda t: F.array_contains(ok, t)), ",").alias("kept"), F.array_join(F.array_sort(F.array_distinct(F.array_except("nv_tags", ok))), ",").alias("rejected"))


def c19_cough_filter(spark, d):
    nv = views.nv_rows(spark, d).where("nv_text is not null")
    only = F.size(F.filter(F.coalesce("nv_tags", F.array().cast("array<string>")), lambda t: t != "Cough")) == 0
    keep = ~F.contains("nv_text", F.lit("[Cough]")) | ~only
    return nv.where(keep).select("id", F.trim(F.regexp_replace(F.regexp_replace("nv_text", r"\[Cough\]", " "), r" +", " ")).alias("text"))


def c20_iqr_acceptance(spark, d):
    r = _rated(spark, d).where("chars > 0").withColumn("r", F.col("sec") / F.col("chars"))
    b = r.agg(F.percentile("r", F.array(F.lit(0.25), F.lit(0.75))).alias("p")).select(F.col("p")[0].alias("q1"), F.col("p")[1].alias("q3"))
    j = r.join(F.broadcast(b))  # one row
    span = F.col("q3") - F.col("q1")
    return j.where((F.col("sec") >= 2) & (F.col("sec") <= 30) & (F.col("q") >= 2.8) & (F.col("chars") >= 2) & (F.col("r") >= F.col("q1") - 1.5 * span) & (F.col("r") <= F.col("q3") + 1.5 * span)).select("idx")


def c32_pattern_scan(spark, d):
    t = table(spark, d, "documents").where("text is not null")
    return t.where(F.col("text").rlike(r"\b[0-9]{1,2} ?[ap]\. ?m\.") | F.col("text").rlike(r"https?://")).select("doc_id")


def g1_full_order(spark, d):
    s = _seg(spark, d).select("sid", "idx", F.coalesce("q", F.lit(float("inf"))).alias("key"))
    return ranged_rank(s, ["sid"], [F.asc("key"), F.asc("idx")], "rank").select("sid", "idx", "rank")


def g3_top_voices(spark, d):
    v = _seg(spark, d).where("spk is not null").groupBy("sid", F.col("spk").alias("label")).agg(F.sum(_w()).alias("score"))
    g = v.groupBy("sid").agg(F.collect_list(F.struct("label", "score")).alias("v"))
    return g.select("sid", F.array_join(F.transform(X.top_labels(F.col("v")), lambda x: x["label"]), "|").alias("top"))


def g5_budget_stop(spark, d):
    t = views.manifest(spark, d).where("source_tar is not null and rel_end > rel_start").groupBy("source_tar").agg(F.sum(F.round((F.col("rel_end") - F.col("rel_start")) * 1000).cast("long")).alias("ms"))
    return A.budgeted(t, "source_tar", "ms", 900_000).select("source_tar", "ms", "before")


def i1_char_count(spark, d):
    return table(spark, d, "documents").select("doc_id", X.char_count(F.col("text")).cast("long").alias("chars"))


def i4_split_tags(spark, d):
    clean, tags = X.split_tags(F.col("nv_text"))
    return views.nv_rows(spark, d).select("id", clean.alias("clean"), F.array_join(tags, ",").alias("tags"))


def i5_length_ratio(spark, d):
    f = views.facts(spark, d).select("fact_id", "sid", "seg_index", "text")
    j = f.join(_seg(spark, d).select("sid", "seg_index", "txt"), ["sid", "seg_index"])
    return j.select("fact_id", X.length_ratio(F.col("text"), F.col("txt")).alias("ratio"))


def i6_buckets(spark, d):
    return _seg(spark, d).select("idx", X.bucket(F.col("q") * -10, X.VOLUME_EDGES, ("soft", "normal", "loud")).alias("level"), X.bucket(F.col("q") * 50, X.PITCH_FEMALE, ("low", "mid", "high")).alias("pitch"))


def i8_speech_rate(spark, d):
    return _rated(spark, d).select("idx", F.round("rate", 1).alias("cps"))


def i14_sample_bounds(spark, d):
    m = views.manifest(spark, d).where("rel_start is not null and rel_start >= 0")
    return m.select("id", X.truncated_sample(F.col("rel_start"), 16_000, F.lit(1_600_000_000)).alias("from_sample"))


def i15_draws(spark, d):
    m = views.manifest(spark, d).where("id is not null")
    return m.select("id", X.draw("", 7, F.col("id"), 4).alias("form"), X.draw("lang:", 7, F.col("id"), 2).alias("side"))


def i16_crc_shard(spark, d):
    return views.manifest(spark, d).where("id is not null").select("id", X.crc_shard(F.coalesce("parent_id", "id"), 8).alias("shard"))


def i18_round_robin(spark, d):
    return _seg(spark, d).select("idx", X.round_robin(F.col("idx"), [3, 1, 2]).cast("long").alias("worker"))


def i19_segment_ids(spark, d):
    return _seg(spark, d).select("idx", F.concat("sid", F.lit("_"), F.lpad(F.col("idx").cast("string"), 8, "0")).alias("name"))


def i20_clip_ids(spark, d):
    return views.manifest(spark, d).where("wav_path is not null").select("id", F.regexp_extract("wav_path", r"([^/]+)\.[a-z0-9]+$", 1).alias("stem"))


def i21_clipped(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clipped(F.col("text"), 300).alias("text"))


def i24_time_labels(spark, d):
    return _seg(spark, d).select("idx", X.time_label(F.col("s")).alias("label"))


def l1_tag_lines(spark, d):
    s = _seg(spark, d)
    line = F.array_compact(F.array(F.concat(F.lit("language: "), F.col("lang")), F.when(F.col("q") >= 3, "clear").when(F.col("q") < 2, "noisy"), F.concat(F.lit("voice: "), F.col("spk"))))
    return s.select("idx", F.array_join(line, "; ").alias("line"))


_N = "length(regexp_replace(coalesce({}, ''), '[\\s\\p{{P}}\\p{{Z}}]', '', 'g'))"
_RATED = "rt as (select *, " + _N.format("txt") + " as chars, (e - s) / 1000.0 as sec from seg), rr as (select *, case when sec >= 0.5 and chars > 0 then chars / sec end as rate from rt)"
_NT = "regexp_replace(txt, '[\\s\\p{P}\\p{Z}]', '', 'g')"
_POST = "with n as (select label, count(*) as n from embeddings group by label), x as (select label, unnest(embedding) as p, generate_subscripts(embedding, 1) - 1 as pos from embeddings), m as (select x.label, pos, round(sum(abs(cast(p as double))) / any_value(n.n), 6) as mean from x join n on n.label = x.label group by x.label, pos) "
ORACLES = {
    "e1_weighted_vote": sql("also p as (select sid, lang, sum(e - s) as w from seg where lang is not null and lang <> '' group by all) select sid, arg_max(lang, (w, lang)) as label, round(max(w) / sum(w), 6) as share from p group by sid", "seg"),
    "e2_weighted_mean": sql("select sid, round(sum(q * (e - s)) / nullif(sum(case when q is not null then e - s end), 0), 6) as mean from seg group by sid", "seg"),
    "e3_energy_mean": sql("select sid, round(10 * log10(sum((e - s) * pow(10.0, q * -10 / 10)) / nullif(sum(case when q is not null then e - s end), 0)), 4) as level from seg group by sid", "seg"),
    "e4_posterior_mean": _POST + "select label, pos, mean, row_number() over (partition by label order by mean desc, pos) as rank from m",
    "e5_top_positions": _POST + ", r as (select label, pos, mean, row_number() over (partition by label order by mean desc, pos) as rank from m) select * from r where rank <= 3",
    "e8_grouped_voices": sql("also g as (select sid, spk, count(*) as n, cast(sum(e - s) as bigint) as ms from seg group by sid, spk), o as (select sid, cast(sum(case when spk is null then n else 0 end) as bigint) as orphans, count(spk) as k from g group by sid) select o.sid, orphans, g.spk, g.n, g.ms from o left join g on g.sid = o.sid and g.spk is not null", "seg"),
    "e11_covering_languages": sql("""also p as (select sid, lang, sum(e - s) as w from seg where lang is not null and lang not in ('', 'unknown') and trim(txt) <> '' group by all),
        c as (select *, coalesce(sum(w) over (partition by sid order by w desc, lang rows between unbounded preceding and 1 preceding), 0) as b, sum(w) over (partition by sid) as a from p)
        select sid, string_agg(lang, ',' order by lang) as labels from c where b < 0.9 * a group by sid""", "seg"),
    "e12_majority_language": sql("also p as (select sid, lower(trim(lang)) as l, count(*) as n, min((s, idx)) as fst from seg where lower(trim(lang)) not in ('', 'unknown') group by all), r as (select *, row_number() over (partition by sid order by n desc, fst) as r from p) select sid, l as lang, n from r where r = 1", "seg"),
    "e16_tag_counts": sql("also x as (select id, rec, unnest(nv_tags) as tag from nv) select rec, tag, count(*) as n_tags, count(distinct id) as n_rows from x group by rec, tag", "nv"),
    "e17_speaker_tag_counts": sql("also x as (select id, rec, turn, unnest(nv_tags) as tag from nv where turn is not null) select rec, turn, tag, count(*) as n_tags, count(distinct id) as n_rows from x group by rec, turn, tag", "nv"),
    "e18_segment_counters": sql("select r.id, count(nv.id) as nv_segments, cast(sum(case when list_contains(nv_tags, 'Humming') then 1 else 0 end) as bigint) as nv_sung_segments, case when count(nv.id) > 0 then 1 else 0 end as annotated from rec r left join nv on nv.rec = r.id group by r.id", "rec", "nv"),
    "e19_indexed_quantiles": "with s as (select kind, list_sort(list(n_chars)) as l from documents where n_chars is not null group by kind) select kind, len(l) as n, l[cast(floor(len(l) * 0.1) as bigint) + 1] as p10, l[cast(floor(len(l) * 0.5) as bigint) + 1] as p50, l[cast(floor(len(l) * 0.9) as bigint) + 1] as p90 from s",
    "e19_coverage": sql("select count(*) as n, count(wav_path) as has_wav_path, count(txt) as has_txt, count(lang) as has_lang, count(parent_id) as has_parent_id from man", "man"),
    "e19_top_sources": "select source, count(*) as n from documents group by source order by n desc, source limit 5",
    "e20_survey": "select source, coalesce(lang, 'none') as lang, " + ", ".join(f"cast(coalesce(sum(case when kind = '{k}' then n_chars end), 0) as bigint) as \"{k}\"" for k in ("long", "dialogue", "caption", "short", "subtitle")) + " from documents group by 1, 2",
    "e20_rollup": "select source, kind, count(*) as n, cast(sum(n_chars) as bigint) as chars, grouping(source, kind) as level from documents group by rollup (source, kind)",
    "e21_speed_edges": sql("also " + _RATED + """, m as (select lang, count(*) as n, median(rate) as med from rr where rate is not null and lang is not null group by lang having count(*) >= 200),
        f as (select lang, n, round(med * 0.843, 1) as lo, round(med * 1.335, 1) as hi from m)
        select f.lang, n, lo, hi, round(sum(case when rate < lo then 1 else 0 end) / count(*), 6) as slow_share, round(sum(case when rate > hi then 1 else 0 end) / count(*), 6) as fast_share from f join rr on rr.lang = f.lang where rate is not null group by all""", "seg"),
    "e24_row_languages": sql("also p as (select sid, lang, min((s, idx)) as fst from seg where trim(lang) <> '' group by all) select sid, string_agg(lang, ',' order by fst) as languages from p group by sid", "seg"),
    "e25_tag_deltas": sql("also x as (select unnest(nv_tags) as tag, -1 as v from nv union all select unnest(nv_verified), 1 from nv) select tag, cast(sum(case when v < 0 then 1 else 0 end) as bigint) as before, cast(sum(case when v > 0 then 1 else 0 end) as bigint) as after, cast(sum(v) as bigint) as delta from x group by tag", "nv"),
    "e26_enrichment": sql("select list_contains(nv_tags, 'Cough') as cand, count(*) as n, round(avg(case when len(coalesce(nv_verified, [])) > 0 then 1 else 0 end), 6) as pass_rate from nv where nv_tags is not null group by 1", "nv"),
    "e27_recording_quality": sql("select sid, round(coalesce(avg(q), 0.0), 6) as mos from seg group by sid", "seg"),
    "e28_tag_survival": sql("also x as (select id, unnest(list_distinct(nv_tags)) as tag, coalesce(nv_verified, []) as ok from nv where nv_tags is not null) select tag, count(*) as n, cast(sum(case when list_contains(ok, tag) then 1 else 0 end) as bigint) as kept, round(avg(case when list_contains(ok, tag) then 1 else 0 end), 6) as kept_share from x group by tag", "nv"),
    "c2_quality_marks": sql("select idx, case when (e - s) / 1000.0 < 0.5 then 'duration_too_short' when (e - s) / 1000.0 > 30 then 'duration_too_long' when q is null then 'missing_quality' when q < case when lower(trim(lang)) in ('zh', 'en') then 3.0 else 2.4 end then 'low_quality' end as reason from seg", "seg"),
    "c5_ratio_bounds": sql("also " + _RATED + """ select idx, case when chars > 0 and sec > 0 and sec / chars >= case when lower(trim(lang)) in ('zh', 'yue', 'ja', 'ko', 'th') then 0.04 else 0.015 end
        and sec / chars <= case when lower(trim(lang)) in ('zh', 'yue', 'ja', 'ko', 'th') then 2.0 else 1.0 end then 1 else 0 end as ok from rr""", "seg"),
    "c6_confidence_gate": sql("select fact_id, case when language is null or trim(language) = '' or coalesce(try_cast(extra['lid_confidence'] as double), 0) < 0.8 then 'unknown' else split_part(language, ' ', 1) end as lang from fac", "fac"),
    "c10_language_subset": "with r as (select sid, arg_max_null(languages, ingested_at) as languages from recordings where sid is not null group by sid) select sid from r where len(languages) > 0 and len(list_filter(languages, lambda x: x not in ('en', 'de', 'fr', 'es'))) = 0",
    "c12_clamped": sql("""also r as (select sid, arg_max_null(duration, ingested_at) as d0 from recordings where sid is not null group by sid), r2 as (select sid, try_cast(round(d0 * 1000) as bigint) as dur from r), j as (select seg.*, dur from seg left join r2 using (sid))
        select idx, case when dur is null then 'no_duration' when s >= dur then 'starts_past_end' when least(e, dur) - s < 500 then 'too_short' else 'kept' end as reason, least(e, dur) as end_ms from j""", "seg"),
    "c17_verified": sql("select id, array_to_string(list_filter(nv_tags, lambda t: list_contains(coalesce(nv_verified, []), t)), ',') as kept, array_to_string(list_sort(list_distinct(list_filter(nv_tags, lambda t: not list_contains(coalesce(nv_verified, []), t)))), ',') as rejected from nv where nv_tags is not null", "nv"),
    "c19_cough_filter": sql("select id, trim(regexp_replace(regexp_replace(nv_text, '\\[Cough\\]', ' ', 'g'), ' +', ' ', 'g')) as text from nv where nv_text is not null and (not contains(nv_text, '[Cough]') or len(list_filter(coalesce(nv_tags, []), lambda t: t <> 'Cough')) > 0)", "nv"),
    "c20_iqr_acceptance": sql("also " + _RATED + ", x as (select *, sec / chars as r from rr where chars > 0), b as (select quantile_cont(r, 0.25) as q1, quantile_cont(r, 0.75) as q3 from x) select idx from x, b where sec >= 2 and sec <= 30 and q >= 2.8 and chars >= 2 and r >= q1 - 1.5 * (q3 - q1) and r <= q3 + 1.5 * (q3 - q1)", "seg"),
    "c32_pattern_scan": "select doc_id from documents where regexp_matches(text, '\\b[0-9]{1,2} ?[ap]\\. ?m\\.') or regexp_matches(text, 'https?://')",
    "g1_full_order": sql("select sid, idx, row_number() over (partition by sid order by coalesce(q, 'infinity'::double), idx) as rank from seg", "seg"),
    "g3_top_voices": sql("also p as (select sid, spk, sum(e - s) as w from seg where spk is not null group by all), r as (select *, row_number() over (partition by sid order by w desc, spk) as r from p) select sid, string_agg(spk, '|' order by r) as top from r where r <= 3 group by sid", "seg"),
    "g5_budget_stop": sql("also t as (select source_tar, cast(sum(cast(round((rel_end - rel_start) * 1000) as bigint)) as bigint) as ms from man where source_tar is not null and rel_end > rel_start group by 1), c as (select *, cast(coalesce(sum(ms) over (order by source_tar rows between unbounded preceding and 1 preceding), 0) as bigint) as before from t) select source_tar, ms, before from c where before < 900000", "man"),
    "i1_char_count": "select doc_id, length(regexp_replace(text, '[\\s\\p{P}\\p{Z}]', '', 'g')) as chars from documents",
    "i4_split_tags": sql("select id, trim(regexp_replace(regexp_replace(nv_text, '\\[[A-Za-z][A-Za-z-]*\\]', ' ', 'g'), '\\s+', ' ', 'g')) as clean, array_to_string(regexp_extract_all(nv_text, '\\[([A-Za-z][A-Za-z-]*)\\]', 1), ',') as tags from nv", "nv"),
    "i5_length_ratio": sql("select fact_id, case when length(" + _NT + ") > 0 then round(length(regexp_replace(text, '[\\s\\p{P}\\p{Z}]', '', 'g')) / length(" + _NT + "), 2) end as ratio from fac join seg using (sid, seg_index)", "fac", "seg"),
    "i6_buckets": sql("select idx, case when q is null then null when q * -10 < -27 then 'soft' when q * -10 > -19 then 'loud' else 'normal' end as level, case when q is null then null when q * 50 < 141.6 then 'low' when q * 50 > 184.5 then 'high' else 'mid' end as pitch from seg", "seg"),
    "i8_speech_rate": sql("also " + _RATED + " select idx, round(rate, 1) as cps from rr", "seg"),
    "i14_sample_bounds": sql("select id, cast(greatest(0, least(trunc(rel_start * 16000), 1600000000)) as bigint) as from_sample from man where rel_start >= 0", "man"),
    "i15_draws": sql("select id, cast(('0x' || substr(md5('7:' || id), 32, 1)) as bigint) % 4 as form, cast(('0x' || substr(md5('lang:7:' || id), 32, 1)) as bigint) % 2 as side from man where id is not null", "man"),
    "i18_round_robin": sql("select idx, cast([0, 1, 2, 0, 2, 0][cast(idx % 6 as integer) + 1] as bigint) as worker from seg", "seg"),
    "i19_segment_ids": sql("select idx, sid || '_' || lpad(cast(idx as varchar), 8, '0') as name from seg", "seg"),
    "i20_clip_ids": sql("select id, regexp_extract(wav_path, '([^/]+)\\.[a-z0-9]+$', 1) as stem from man where wav_path is not null", "man"),
    "i21_clipped": """with x as (select doc_id, text, substr(text, 1, 300) as h from documents), y as (select *, case when contains(h, ' ') then 300 - strpos(reverse(h), ' ') + 1 end as p from x)
        select doc_id, case when length(text) <= 300 then text when p > 150 then substr(h, 1, p - 1) || ' ...' else h || ' ...' end as text from y""",
    "i24_time_labels": sql("select idx, cast(s // 60000 as varchar) || ':' || lpad(cast(s // 1000 % 60 as varchar), 2, '0') as label from seg", "seg"),
    "l1_tag_lines": sql("select idx, concat_ws('; ', 'language: ' || lang, case when q >= 3 then 'clear' when q < 2 then 'noisy' end, 'voice: ' || spk) as line from seg", "seg"),
}

QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "cegil" and k[1:2].isdigit()}
