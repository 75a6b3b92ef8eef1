"""Rules, labels, exports and guarded sinks on small fixtures, and against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from phonoloom.functions import labels as L
from phonoloom.functions import scalars as X
from phonoloom.operators import exports, folds, joins, lineage, ordered, rules, sequences
from phonoloom.sources import sinks
from phonoloom.streaming import incremental


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_names(spark):
    names = ["Chinese", " english ", "Chinese,English", "Sichuan", "Cantonese (Hong Kong accent)", "cantonese of somewhere", "Tagalog", "", None]
    assert column(spark, names, L.name_code) == ["zh", "en", "zh", "zh", "yue", "yue", "unknown", "unk", "unk"]
    assert column(spark, names, L.is_dialect) == [False, False, False, True, True, True, True, False, False]
    assert column(spark, ["zh xinan", "zh", "zh mandarin", "en wu", "ZH  Wu", None], L.lid_is_dialect) == [True, False, False, False, True, False]
    assert column(spark, ["en", "ms", "id", "unknown", "", None, "xx"], L.accepted_language) == [True, False, False, False, False, False, False]


def test_dialect_cascade(spark):
    rows = [("zh north mandarin", "f"), ("zh mandarin", "f"), ("zh xinan", "f"), ("zh yue", "f"), ("zh wu", "f"), ("zh min", "f"), ("zh hakka", "f"), (None, "f"), ("zh wu", None), ("other", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = [r.x for r in df.select("i", L.cascaded_dialect(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()]
    assert got == ["f", "Standard Mandarin", "Southwestern", "Cantonese", "wu", "min", "f", "f", "wu", None]


def test_ages_and_speeds(spark):
    df = spark.createDataFrame([(0, "child", 50.0, 60.0), (1, "male", 17.0, 19.0), (2, None, None, 12.9), (3, None, None, None), (4, "female", 60.0, 60.0), (5, None, 42.9, None)], "i int, g string, a double, b double")
    got = [r.x for r in df.select("i", L.age_of(F.col("g"), F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()]
    assert got == ["child", "young", "child", None, "senior", "young"]
    df = spark.createDataFrame([(0, "en", 12.49), (1, "en", 12.5), (2, "en", 19.8), (3, "en", 19.81), (4, "fr", 3.0), (5, None, 3.0), (6, "ja", None), (7, "ja", float("nan"))], "i int, l string, r double")
    assert [r.x for r in df.select("i", L.speed_label(F.col("r"), F.col("l")).alias("x")).orderBy("i").collect()] == ["slow", "measured", "measured", "fast", None, None, None, None]
    assert column(spark, [115.6, 115.7, 149.7, 149.8, None], lambda c: X.pitch_label(c, F.lit("male")), "double") == ["low", "medium", "medium", "high", None]
    assert column(spark, [140.0, 200.0], lambda c: X.pitch_label(c, F.lit(None).cast("string")), "double") == ["low", "high"]


def test_chunk_verdicts_in_order(spark):
    rows = [
        (None, None, True, 5.0), (" ", "", True, 5.0), ("hello there", "en", False, 5.0), ("go now " * 40, "en", True, 20.0), ("...", "en", True, 5.0), ("a", "en", True, 0.5),
        ("hello there", "en", True, 0.0), ("hello there", "en", True, None), ("hello there", "en", True, 100.0), ("hello there", "en", True, 1.0), ("hello", None, None, 1.0), ("你好", "zh", True, 0.05), ("你好", "zh", True, 0.5),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, l string, ok boolean, sec double")
    d = rules.with_repetition(df, "t").select("i", rules.chunk_verdict(F.col("t"), F.col("l"), F.col("ok"), F.col("sec"), F.col("repeated"), 2).alias("x"))
    got = [r.x for r in d.orderBy("i").collect()]
    assert got == ["no_result", "no_result", "lang_rejected", "asr_repetition", "blank", "too_short", "ratio", "ratio", "ratio", None, "lang_rejected", "ratio", None]
    roles = [r.x for r in d.select("i", rules.role_of(F.col("x")).alias("x")).orderBy("i").collect()]
    assert roles == ["BREAK", "BREAK", "BREAK", "BREAK", "SILENCE", "SILENCE", "BREAK", "BREAK", "BREAK", "OK", "BREAK", "BREAK", "OK"]


def test_routes(spark):
    df = spark.createDataFrame([(1, "a", " EN "), (2, "b", "en"), (3, "c", None), (4, "d", "unknown"), (5, "e", "xx"), (6, "f", "ms")], "i int, k string, lang string")
    final = spark.createDataFrame([("b",), ("b",), ("c",)], "k string")
    got = {r.i: r.route for r in rules.routed(df, final, ["k"], "lang").collect()}
    assert got == {1: "secondary", 2: "primary", 3: "primary", 4: "primary", 5: "unsupported", 6: "unsupported"}


def test_rescues_and_gates(spark):
    df = spark.createDataFrame([(0, None, 1.0), (1, " ", 1.0), (2, "yes it is", 1.0), (3, "la la la la la la la la la la " * 8, 3.0), (4, "we go now " * 30, 60.0)], "i int, heard string, sec double")
    assert [r.rescue for r in rules.rescued(df, "heard", F.col("sec")).orderBy("i").collect()] == ["blank", "blank", "ok", "degenerate", "asr_repetition"]
    df = spark.createDataFrame([(0, 16_000, 5.0, 1), (1, 24_000, 5.0, 1), (2, 48_000, 18_000.0, 1), (3, 48_000, 12_000.0, None), (4, 48_000, 9_000.0, 1), (5, None, 1.0, 1)], "i int, r int, s double, c int")
    got = [r.x for r in df.select("i", rules.input_gate(F.col("r"), F.col("s"), F.col("c")).alias("x")).orderBy("i").collect()]
    assert got == ["low_rate", None, "too_long", "too_large", None, "low_rate"]


def test_names_and_intervals(spark):
    assert column(spark, ["a.flac", "", " ", "a/b", "a\\b", "..", ".", "/x", "a\x00", None, "…"], rules.safe_name) == [True] + [False] * 9 + [True]
    df = spark.createDataFrame([(0, 1.0, 2.0, 9.0), (1, -1.0, 2.0, 9.0), (2, 8.0, 12.0, 9.0), (3, 2.0, 2.0, 9.0), (4, 9.0, 10.0, 9.0), (5, None, 2.0, 9.0), (6, 1.0, 2.0, None)], "i int, a double, b double, hi double")
    why, lo, hi = rules.placed_interval(F.lit(0.0), F.col("hi"), F.col("a"), F.col("b"))
    got = [(r.w, r.lo, r.h) for r in df.select("i", why.alias("w"), lo.alias("lo"), hi.alias("h")).orderBy("i").collect()]
    assert got == [(None, 1.0, 2.0), (None, 0.0, 2.0), (None, 8.0, 9.0), ("empty", None, None), ("outside", None, None), ("missing", None, None), ("missing", None, None)]
    assert column(spark, ["0000012_x_y", "12_x", "0000012x", None], X.clip_id) == ["x_y", None, None, None]


def test_manifest_load(spark):
    rows = [("a", "d/a.wav", None, None, "p"), (None, "d/b.wav", None, None, "p"), ("c", None, "t.tar", "c.flac", None), ("d", "../d.wav", None, None, None), ("e", "/e.wav", "t.tar", "e.flac", None), ("f", None, "t.tar", None, None), ("g", " ", None, None, None)]
    df = spark.createDataFrame(rows, "id string, wav_path string, source_tar string, source_member string, parent_id string").withColumn("via", F.lit("x")).withColumn("inside", F.lit(1))
    got = {r.id: r.via for r in rules.usable_manifest(df).collect()}
    assert got == {"a": "path", "b.wav": "path", "c": "archive", "e": "archive"}
    parts = [{r.id for r in rules.usable_manifest(df, k, 3).collect()} for k in range(3)]
    assert set().union(*parts) == set(got) and sum(map(len, parts)) == len(got)
    with pytest.raises(ValueError):
        rules.usable_manifest(df, strict=True)


def test_boundaries_and_speakers(spark):
    assert column(spark, ["Yes, no.  ok", "", "日本。語", None], rules.boundaries) == [[0, 5, 10, 12], [0], [0, 3, 4], [0]]
    text = "[S1] hi there. [S2] yes"
    assert [column(spark, [text], lambda c, p=p: rules.speaker_at(c, F.lit(p)))[0] for p in (0, 3, 4, 17, 18, 23)] == [None, "S1", "S1", "S1", "S2", "S2"]


def test_insertions_as_sorted_search(spark):
    rng = random.Random(3)

    def plain(text, start, end, targets):
        places = sorted({0, len(text), *(m for m in rules.boundary_places(text))})
        taken, out = set(), []
        for t in targets:
            ideal = round(min(1.0, max(0.0, (t - start) / max(end - start, 0.001))) * len(text))
            for p in sorted(places, key=lambda v: (abs(v - ideal), v)):
                if p not in taken:
                    taken.add(p)
                    out.append((t, p))
                    break
        return out

    for _ in range(200):
        text = "".join(rng.choice("ab ,.") for _ in range(rng.randrange(0, 60)))
        targets = sorted(rng.uniform(-5, 40) for _ in range(rng.randrange(8)))
        assert rules.insertion_points(text, 0.0, 30.0, targets) == plain(text, 0.0, 30.0, targets)
    df = spark.createDataFrame([("a", "one, two. three", 65.0), ("b", None, 90.0), ("c", "x", 20.0), ("d", " ", 90.0), (None, "x. y", 90.0)], "id string, text string, seconds double")
    assert [(r.id, r.event, r.target, r.position) for r in rules.insertions(df).orderBy("event").collect()] == [("a", 1, 30.0, 5), ("a", 2, 55.0, 15)]
    assert rules.insertions(df.limit(0)).count() == 0


def test_sounds(spark):
    got = column(spark, ["such a funny joke", "tears at the funeral", "sorry, sorry", "laughter", "他哭了", "funny tears", None], lambda c: rules.sound_for(c, F.lit("k")))
    drawn = got[3]
    assert got == ["Laughter", "Crying", "Sigh", drawn, "Crying", "Laughter", drawn] and drawn in rules.DRAWN


def test_container_entries(spark):
    c = spark.createDataFrame([("a", ["en"]), ("b", ["en", "xx"]), ("c", []), ("d", None), ("a", ["en"])], "sid string, languages array<string>")
    e = spark.createDataFrame([("a", 7, 100, 200), ("a", 8, 5_000, 9_000), ("a", 9, 4_000_000, 4_001_000), ("b", 1, 0, 1_000), ("d", 2, 0, 1_000)], "sid string, idx long, s long, e long")
    got = sorted((r.id, r.idx) for r in exports.container_entries(c, e, ["en", "de"]).collect())
    assert got == [("a_0001", 8), ("a_0002", 9)]
    with pytest.raises(ValueError):
        exports.unique_ids(e, "sid")


def test_fact_merge_and_identity(spark):
    base = spark.createDataFrame([("a", "1", 1, "x"), ("a", "2", 2, "y")], "sid string, k string, f long, t string")
    new = spark.createDataFrame([("a", "2", 1, None), ("b", "1", 9, "w"), ("b", "1", 8, "v")], "sid string, k string, f long, t string")
    got = sorted((r.sid, r.k, r.t) for r in exports.merged_facts(base, new, ["sid", "k"], "f").collect())
    assert got == [("a", "1", "x"), ("a", "2", None), ("b", "1", "w")]
    files = spark.createDataFrame([("v1", "a"), ("v1", "b"), ("v2", "c")], "v string, n string")
    ident = spark.createDataFrame([("v1", "s2"), ("v1", "s1")], "v string, sample_id string")
    got = {r.n: (r.sample_id, r.status) for r in exports.identified_files(files, ident, "v", "n").collect()}
    assert got == {"a": ("s1", "matched"), "b": ("s1", "duplicate"), "c": (None, "missing")}


def test_lines(spark):
    assert column(spark, ['{"id": "a\\"b", "x": 1}', '{"x": "id"}', "torn", None], exports.raw_line_id) == ['a\\"b', None, None, None]
    good = '[{"label":"a","score":0.5},{"label":"b","score":0.1}]'
    df = spark.createDataFrame([(1, good), (2, "no"), (3, '[{"label":"a","score":1},{"label":"a","score":2}]'), (4, "[]"), (5, '[{"score":1}]')], "k int, j string")
    assert sorted((r.k, r.label) for r in exports.parsed_scores(df, "k", "j", strict=False).collect()) == [(1, "a"), (1, "b")]
    with pytest.raises(ValueError):
        exports.parsed_scores(df, "k", "j")
    assert exports.parsed_scores(df.where("k = 1"), "k", "j").count() == 2


def test_testset_and_failures(spark):
    r = spark.createDataFrame([("a", 10.0), ("b", 100.0), ("c", None)], "sid string, duration double")
    t = spark.createDataFrame([("a", 1, -5, 20), ("a", 2, 9_000, 12_000), ("a", 3, 10_000, 11_000), ("b", 4, 0, 5), ("c", 5, 0, 5)], "sid string, idx long, s long, e long")
    assert sorted((x.idx, x.s, x.e) for x in exports.packed_testset(r, t, 5, 50).collect()) == [(1, 0, 20), (2, 9_000, 10_000)]
    assert [tuple(x) for x in exports.permanent_failures(spark.createDataFrame([("a",)] * 3 + [("b",)] * 2, "k string"), "k").collect()] == [("a", 3)]


def test_track_export(spark, tmp_path):
    t = spark.createDataFrame([(1,)], "x int")
    root = str(tmp_path / "out")
    with pytest.raises(ValueError):
        exports.export_tracks({"partial": t}, root)
    assert not exports.exported(spark, root)
    exports.export_tracks({k: t for k in exports.TRACKS}, root)
    assert exports.exported(spark, root)
    exports.export_tracks({k: t.union(t) for k in exports.TRACKS}, root)  # what is there is kept
    assert spark.read.parquet(f"{root}/all_longs").count() == 1
    for form in ("jsonl", "tsv"):
        exports.export_rows(t, f"{root}/{form}", form)
    with pytest.raises(ValueError):
        exports.export_rows(t, f"{root}/z", "xml")


def test_guarded_append(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int"), spark.createDataFrame([("b", 3)], "id string, v int")
    assert sinks.guarded_append(one, path, "id") == 2
    with pytest.raises(ValueError):
        sinks.guarded_append(two, path, "id")
    with pytest.raises(ValueError):
        sinks.guarded_append(two.union(two).withColumn("id", F.lit("z")), path, "id")
    assert sinks.guarded_append(two.withColumn("id", F.lit("c")), path, "id") == 1
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "t.lock").write_text("")
    with pytest.raises(RuntimeError):
        sinks.guarded_append(two.withColumn("id", F.lit("d")), path, "id")
    (tmp_path / "t.lock").unlink()
    assert spark.read.parquet(path).count() == 3


def test_replace_keeps_the_old_rows_when_the_source_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.replace_table(spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    sinks.replace_table(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_settled_tables(spark):
    df, path = lineage.settle_table(spark.range(5))
    assert df.count() == 5
    lineage.discard(spark, path)
    lineage.discard(spark, None)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_sums_over_ranges(spark):
    rng = random.Random(1)
    rows = [(f"u{i:03}", rng.choice([0, 5, 40, None])) for i in range(200)]
    df = spark.createDataFrame(rows, "u string, n long")
    want, total = {}, 0
    for u, n in rows:
        want[u] = total
        total += n or 0
    assert {r.u: r.b for r in ordered.ranged_sum(df, "u", "n", "b").collect()} == want
    assert {r.u: r.batch for r in incremental.assigned_batches(df, "u", "n", 100).collect()} == {u: b // 100 for u, b in want.items()}
    assert {r.u for r in folds.budgeted(df, "u", "n", 100).collect()} == {u for u, b in want.items() if b < 100}
    assert ordered.ranged_sum(df.limit(0), "u", "n", "b").count() == 0


def test_restricted_posterior(spark):
    rows = [("a", "en", 3, ["en", "de"]), ("a", "de", 1, ["en", "de"]), ("a", "fr", 4, ["en", "de"]), ("b", "fr", 4, ["en"]), ("c", "fr", 1, None), ("c", "es", 3, None)]
    df = spark.createDataFrame(rows, "sid string, lang string, w long, ok array<string>")
    got = {(r.sid, r.lang): r.share for r in folds.restricted(df, ["sid"], "lang", "w", "ok").collect()}
    assert got == {("a", "en"): 0.75, ("a", "de"): 0.25, ("b", "fr"): 1.0, ("c", "fr"): 0.25, ("c", "es"): 0.75}


def test_overlay_and_enrichment(spark):
    base = spark.createDataFrame([("a", "old", 1), ("b", "old", 2)], "k string, t string, n int")
    side = spark.createDataFrame([("a", None, "x")], "k string, t string, extra string")
    assert sorted((r.k, r.t, r.n, r.extra, r.overlaid) for r in joins.overlaid(base, side, "k").collect()) == [("a", None, 1, "x", True), ("b", "old", 2, None, False)]
    rows = spark.createDataFrame([(["x", "x"], 1), (["x", "y"], 0), (["y"], 0), ([], 1)], "tags array<string>, ok int")
    got = {r.tag: (r.n_with, r.n_without, r.rate_with, r.rate_without, r.ratio) for r in folds.enriched(rows, "tags", "ok").collect()}
    assert got == {"x": (2, 2, 0.5, 0.5, 1.0), "y": (2, 2, 0.0, 1.0, 0.0)}


def test_members_and_units(spark):
    rows = [("a", 1, 0, 1_000, "x", 2.0, "EN"), ("a", 2, 1_500, 3_000, "x", None, "de"), ("a", 3, 3_100, 24_000, "x", 3.0, "de "), ("a", 4, 24_500, 25_000, "x", 4.0, None), ("a", 5, 40_000, 41_000, None, 1.0, "unknown")]
    df = spark.createDataFrame(rows, "sid string, idx long, s long, e long, spk string, q double, lang string")
    got = sorted(tuple(r) for r in sequences.unit_metrics(df).collect())
    assert got == [("a", 0, 2, 2.5, 2.0, "en"), ("a", 3_100, 1, 20.9, 3.0, "de"), ("a", 24_500, 1, 0.5, 4.0, None), ("a", 40_000, 1, 1.0, 1.0, None)]
    placed = {r.idx: (r.win, r.place) for r in sequences.placed_members(sequences.gap_windows(df)).collect()}
    assert placed == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (0, 4), 5: (40_000, 1)}
    assert sequences.unit_metrics(df.limit(0)).count() == 0


def test_files_of_a_folder(spark, tmp_path):
    import json

    from phonoloom.sources import files

    for p in ("a/x.wav", "a/b/y.FLAC", "a/z.txt", "a_processed/w.wav"):
        (tmp_path / "in" / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / p).write_bytes(b"12")
    got = {r.name: r.size for r in files.recordings(spark, str(tmp_path / "in")).collect()}
    assert got == {"x": 2, "y": 2}
    assert [r.name for r in files.recordings(spark, str(tmp_path / "in"), spark.createDataFrame([("x",)], "name string")).collect()] == ["y"]
    for p, v in (("r1/r1.json", [{"s": 1.0}, {"s": 2.0}]), ("r1/r1.long.json", [{"s": 3.0}]), ("r1/other.json", [{"s": 9.0}]), ("_tmp/_tmp.json", [{"s": 9.0}]), ("r2/r2.dialogue.json", [])):
        (tmp_path / "rec" / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "rec" / p).write_text(json.dumps(v, indent=1))
    (tmp_path / "rec/r2/r2.json").write_text("{torn")
    got = sorted((r.rec, r.track, r.s) for r in files.record_files(spark, str(tmp_path / "rec"), "struct<s:double>").collect())
    assert got == [("r1", "long", 3.0), ("r1", "short", 1.0), ("r1", "short", 2.0)]
    (tmp_path / "now").symlink_to(tmp_path / "rec")
    assert files.pinned(str(tmp_path / "now")) == str((tmp_path / "rec").resolve()) and files.pinned("s3://b/k") == "s3://b/k"


def test_sidecars(spark):
    from phonoloom.sources import files

    rows = [("t", "a.json", b'{"n": 1}'), ("t", "b.json", b"{torn"), ("t", "c.wav", b'{"n": 1}'), ("t", "d.json", None)]
    got = files.sidecars(spark.createDataFrame(rows, "archive string, member string, data binary"), "struct<n:int>").collect()
    assert [(r.member, r.j.n) for r in got] == [("a.json", 1)]


def test_carrier_windows(spark):
    from phonoloom.sources import files

    rows = [(0, 100, 200, 48_000, 10_000), (1, -1, 5, 48_000, 10_000), (2, 5, 5, 48_000, 10_000), (3, 0, 6 * 3600 * 16_000 + 1, 16_000, 10**9), (4, 0, 4_000, 48_000, 11_000), (5, 0, 4_000, 48_000, 10_900), (6, None, 5, 48_000, 1), (7, 101, 200, 44_100, 10_000)]
    df = spark.createDataFrame(rows, "i int, a long, b long, r int, n long")
    why, lo, hi = files.carrier_window(F.col("a"), F.col("b"), 16_000, F.col("r"), F.col("n"))
    got = [tuple(r)[1:] for r in df.select("i", why.alias("w"), lo.alias("lo"), hi.alias("hi")).orderBy("i").collect()]
    assert got == [(None, 300, 600), ("bad_bounds", None, None), ("bad_bounds", None, None), ("too_long", None, None), ("padded", 0, 12_000), ("past_end", None, None), ("missing", None, None), (None, 101 * 44_100 // 16_000, 200 * 44_100 // 16_000)]


def test_stages(spark):
    from phonoloom.operators import stages

    seen = []
    mk = lambda n, f: stages.Stage(n, f, lambda: seen.append(f"+{n}"), lambda: seen.append(f"-{n}"))
    got = stages.run_stages(spark.range(3), [mk("a", lambda d: d.where("id > 0")), mk("b", lambda d: d.withColumn("v", F.col("id") * 2))], lambda d: sorted(r.v for r in d.collect()))
    assert got == [2, 4] and seen == ["+a", "+b", "-b", "-a"]
    seen.clear()
    with pytest.raises(ZeroDivisionError):
        stages.run_stages(spark.range(1), [mk("a", lambda d: 1 / 0)], lambda d: d)
    assert seen == ["+a", "-a"]
    with pytest.raises(ValueError):
        stages.run_stages(spark.range(1), [mk("a", lambda d: d)] * 2, lambda d: d)


def test_hints_and_captions(spark):
    from phonoloom.operators import stages

    df = spark.createDataFrame([(i, h, f"t{i}") for i, h in enumerate(["en", "de", None] * 20)], "i int, h string, t string")
    got = {r.i: r.o for r in stages.by_hint(df, "h", "t", "o", lambda h, xs: [f"{h}:{x}" for x in xs]).collect()}
    assert got == {i: f"{h}:t{i}" for i, h in enumerate(["en", "de", None] * 20)}
    with pytest.raises(Exception, match="results for"):
        stages.by_hint(df, "h", "t", "o", lambda h, xs: []).collect()

    def some(xs):
        if "t3" in xs:
            raise ValueError("no")
        return [x.upper() for x in xs]

    got = {r.i: r.o for r in stages.captioned(df.coalesce(1), "t", "o", some).collect()}
    assert got[3] is None and got[4] == "T4" and sum(v is None for v in got.values()) == 1

    def none(xs):
        raise ValueError("no")

    with pytest.raises(Exception, match="failed in a row"):
        stages.captioned(df, "t", "o", none).collect()


def test_work_that_is_done(spark, tmp_path):
    from phonoloom.operators import stages

    pub, fin = spark.createDataFrame([("a",), ("b",), ("a",)], "k string"), spark.createDataFrame([("b",), ("z",)], "k string")
    assert [r.k for r in stages.pending(pub, fin, ["k"]).collect()] == ["a"]
    entries = spark.createDataFrame([("p", 1), ("p", 5), ("q", 2), ("q", 9)], "u string, t int")
    marks = spark.createDataFrame([("p", 2, 5), ("q", 1, 2), ("r", 0, None)], "u string, n long, latest int")
    assert sorted(r.u for r in stages.drained(entries, marks, "u", "t").collect()) == ["p", "r"]
    path = str(tmp_path / "t")
    stages.append_rows(pub, path)
    stages.append_rows(fin, path)
    stages.append_rows(fin, None)
    assert spark.read.parquet(path).count() == 5


def test_insertions_can_be_undone(spark):
    rng = random.Random(9)
    for _ in range(200):
        t = "".join(rng.choice("ab[].") for _ in range(rng.randrange(30)))
        marks = [(rng.randrange(len(t) + 1), rng.choice(["Sigh", "Cough"])) for _ in range(rng.randrange(5))]
        marks = sorted({p: (p, g) for p, g in marks}.values())
        assert rules.without_insertions(rules.with_insertions(t, marks), marks) == t
    with pytest.raises(ValueError):
        rules.without_insertions("abc", [(1, "Sigh")])
    df = spark.createDataFrame([(1, "one, two. three", 65.0), (2, None, 90.0), (3, "short", 5.0)], "id int, text string, seconds double")
    got = {r.id: (r.n_tags, r.lossless) for r in rules.tagged_texts(df).collect()}
    assert got == {1: (2, 1), 3: (0, 1)}
    assert column(spark, [7680, 7681, None], lambda c: rules.prompt_fits(c, 512), "int") == [True, False, False]


def test_posteriors_and_phases(spark):
    rows = [("a", 1, 2, "x", 0.5), ("a", 1, 2, "y", 0.5), ("a", 2, 6, "x", 1.0), ("b", 3, 0, "x", 1.0)]
    df = spark.createDataFrame(rows, "sid string, row int, w long, label string, p double")
    assert {(r.sid, r.label): r.mean for r in folds.posterior_fold(df, ["sid"]).collect()} == {("a", "x"): 0.875, ("a", "y"): 0.125, ("b", "x"): None}
    got = {r.sid: (r.label, r.agreement, r.top3) for r in folds.accent_fold(df.where("sid = 'a'"), ["sid"], F.struct("row", "label")).collect()}
    assert got == {"a": ("x", 0.875, "x=0.875 y=0.125")}
    tie = spark.createDataFrame([("a", 2, 1, "x", 0.5), ("a", 1, 1, "y", 0.5)], "sid string, row int, w long, label string, p double")
    assert folds.accent_fold(tie, ["sid"], F.struct("row", "label")).first().label == "y"
    segs = [("a", i, t * 1000, (t + d) * 1000, v) for i, (t, d, v) in enumerate([(0, 60, "x"), (60, 40, "y"), (100, 1, "x"), (101, 59, "y"), (160, 40, None), (200, 100, "x")])] + [("b", 9, 0, 1000, "x")]
    df = spark.createDataFrame(segs, "sid string, idx int, s long, e long, spk string")
    assert [tuple(r) for r in sequences.phase_line(df, "spk").collect()] == [("a", 3, "x (0:00-1:00) > y (1:00-2:40) > x (3:20-5:00)")]


def test_gates_fills_and_deltas(spark):
    df = spark.createDataFrame([(0, "joy", 0.5), (1, "joy", 0.49999), (2, "unknown", 0.9), (3, None, 0.9), (4, "joy", None), (5, "", 1.0), (6, "joy", float("nan"))], "i int, l string, c double")
    label, sure = rules.gated_label(F.col("l"), F.col("c"), 0.5)
    assert [r.x for r in df.select("i", label.alias("x")).orderBy("i").collect()] == ["joy"] + [None] * 6
    for tau in (-0.1, 1.1):
        with pytest.raises(ValueError):
            rules.gated_label(F.col("l"), F.col("c"), tau)
    segs = spark.createDataFrame([("a", 1, 0, 10, "en"), ("a", 2, 20, 30, None), ("b", 3, 0, 10, None), ("c", 4, 0, 10, None), ("d", 5, 0, 1, None)], "sid string, idx long, s long, e long, lang string")
    cont = spark.createDataFrame([("b", ["de"]), ("c", ["de", "fr"]), ("a", ["xx"])], "sid string, languages array<string>")
    got = {r.idx: (r.label, r.source) for r in joins.filled_labels(segs, "lang", cont).collect()}
    assert got == {1: ("en", "own"), 2: ("en", "nearest"), 3: ("de", "container"), 4: (None, None), 5: (None, None)}
    base = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v int")
    new, gone = spark.createDataFrame([("b", 9)], "id string, v int"), spark.createDataFrame([("c",)], "id string")
    out, n, m = joins.checked_delta(base, new, gone, "id", expected=sinks.fingerprint(base))
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 9)] and (n, m) == (3, 2)
    assert joins.checked_delta(base, new, gone, "id", result=sinks.fingerprint(out))[2] == 2
    for bad in ((base.union(base), new, gone, None), (base, new.union(new), gone, None), (base, new, new.select("id"), None), (base, new, gone, "0-0-0")):
        with pytest.raises(ValueError):
            joins.checked_delta(*bad[:3], "id", expected=bad[3])
    assert column(spark, ["abc de", None, ""], lambda c: X.text_rate(c, F.lit(2.0))) == [3.0, None, None]
    assert column(spark, ["abc, de"], lambda c: X.heard_rate(c, F.lit(60.0))) == [5 / 30]


def test_gathering_must_be_whole(spark):
    base = spark.createDataFrame([(f"k{i:02}",) for i in range(30)], "k string")
    parts = [base.where(F.crc32("k") % 3 == n).withColumn("n", F.lit(n)) for n in range(3)]
    got = [(r.k, r.position) for r in joins.gathered(parts, base, "k").orderBy("position").collect()]
    assert got == [(f"k{i:02}", i + 1) for i in range(30)]
    for bad in (parts[:2], [*parts, parts[0]], [*parts, spark.createDataFrame([("z", 9)], "k string, n int")]):
        with pytest.raises(ValueError):
            joins.gathered(bad, base, "k")
