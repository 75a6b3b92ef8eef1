import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from phonoloom.functions import scalars as X
from phonoloom.operators import folds as A
from phonoloom.operators import joins as J
from phonoloom.operators import ordered, periods, records, sequences, timelines, verdicts

SEG = "sid string, idx long, s long, e long, spk string, q double, lang string, txt string"


def make(rng, n, sids=("hot", "b")):
    rows, at = [], {s: 0 for s in sids}
    for i in range(n):
        sid = sids[0] if rng.random() < 0.7 else rng.choice(sids)
        at[sid] += rng.choice([0, 300, 900, 2500, 7000, 12_000, 1_900_000])
        rows.append((sid, i, at[sid], at[sid] + rng.choice([200, 900, 4000, 25_000]), rng.choice(["A", "B", "C", None]), rng.choice([None, 1.5, 2.5, 3.5]), rng.choice(["en", "de", None]), rng.choice([None, "", " x ", "y z"])))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make(random.Random(3), 500)


@pytest.fixture(scope="module")
def segs(spark, rows):
    return spark.createDataFrame(rows, SEG)


def by_sid(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        out[r[0]].append(r)
    return out


def test_ordered_helpers(spark, rows, segs):
    d = sequences.hourly(segs)
    far = {r.idx: r.far for r in ordered.carry_max(d, ["sid"], "hour", ["s", "idx"], "e", "far").collect()}
    last = {r.idx: r.x for r in ordered.carry_last(d, ["sid"], "hour", ["s", "idx"], "lang", "x").collect()}
    prev = {r.idx: (r.has_prev, r.prev_e) for r in ordered.carry_previous(d, ["sid"], "hour", ["s", "idx"], ["e"]).collect()}
    rank = {r.idx: r.k for r in ordered.bucketed_rank(segs, ["sid"], "s", ["idx"], 3_600_000, "k").collect()}
    for rs in by_sid(rows).values():
        top = lang = before = None
        for k, r in enumerate(rs):
            assert far[r[1]] == top and rank[r[1]] == k + 1 and prev[r[1]] == (before is not None, before)
            top, lang, before = max(top or 0, r[3]), r[6] or lang, r[3]
            assert last[r[1]] == lang
    got = sorted((r.sid, r.spk, r.first_idx, r.last_idx, r.n_rows) for r in ordered.runs(d.withColumn("spk", F.coalesce("spk", F.lit("-"))), ["sid"], "hour", ["s", "idx"], "spk", ["idx"]).collect())
    want = []
    for sid, rs in by_sid(rows).items():
        for r in rs:
            if want and want[-1][0] == sid and want[-1][1] == (r[4] or "-"):
                want[-1][3:] = [r[1], want[-1][4] + 1]
            else:
                want.append([sid, r[4] or "-", r[1], r[1], 1])
    assert got == sorted(map(tuple, want))


def test_capped_units_as_loop(rows, segs):
    got = sorted((r.sid, r.spk, r.unit_start, r.unit_end, r.n_seg) for r in sequences.capped_units(segs).collect())
    want = []
    for rs in by_sid(rows).values():
        u = None
        for sid, _, s, e, spk, *_ in rs:
            spk = spk or ""
            if u and u[1] == spk and s - u[3] < 3000 and e - u[2] <= 20_000:
                u[3:] = [e, u[4] + 1]
            else:
                u = [sid, spk, s, e, 1]
                want.append(u)
    assert got == sorted(map(tuple, want))


def test_windows_and_coverage_as_sweep(rows, segs):
    m = {(r.sid, r.win_start): r for r in sequences.window_metrics(segs).collect()}
    seen = 0
    for sid, rs in by_sid(rows).items():
        wins, far = [], None
        for r in rs:
            if far is None or r[2] - far > 6000:
                wins.append([])
            wins[-1].append(r)
            far = max(far or 0, r[3])
        for w in wins:
            seen += 1
            x = m[sid, w[0][2]]
            pts = sorted({p for r in w for p in r[2:4]})
            active = [(b - a, {r[4] for r in w if r[2] <= a and r[3] >= b}) for a, b in zip(pts, pts[1:])]
            assert x.n_seg == len(w) and x.win_end == max(r[3] for r in w)
            assert x.union_ms == sum(d for d, a in active if a)
            assert x.overlap_share == pytest.approx(sum(d for d, a in active if len(a) > 1) / (x.win_end - x.win_start), abs=1e-6)
    assert seen == len(m)
    reasons = {r.reason for r in sequences.gate_windows(sequences.window_metrics(segs)).collect()}
    assert "too_short" in reasons


def test_periods_as_merge(spark):
    rng = random.Random(9)
    frames = []
    for i in range(600):
        s = rng.randrange(0, 30_000_000, 500) if rng.random() < 0.8 else rng.randrange(0, 40_000, 500)
        frames.append(("hot" if rng.random() < 0.6 else "b", i, s / 1000, (s + rng.choice([-500, 0, 500, 2000, 700_000])) / 1000, rng.choice(["A", "B", "", None])))
    frames += frames[:30] + [("b", 900, None, 1.0, "A"), ("b", 901, 1.0, float("nan"), "A"), (None, 902, 1.0, 2.0, "A")]
    df = spark.createDataFrame(frames, "sid string, frame_idx int, start_s double, end_s double, speaker string")
    for c in ("s", "e", "k", "n", "t", "side", "x", "kind"):
        df = df.withColumn(c, F.lit("clash"))
    got = sorted((r.sid, r.speaker, r.kind, r.start_ms, r.end_ms, r.n or 0) for r in periods.periods_and_gaps(periods.interval_rows(df, ["sid", "speaker"], ["sid", "frame_idx"], "start_s", "end_s"), ["sid", "speaker"]).collect())
    by, want = defaultdict(list), []
    for sid, i, s, e, sp in set(frames):
        if sid and sp and s is not None and e is not None and e == e and e > s:
            by[sid, sp].append((round(s * 1000), round(e * 1000)))
    for (sid, sp), iv in by.items():
        cur = None
        for s, e in sorted(iv):
            if cur and s <= cur[1]:
                cur[1:] = [max(cur[1], e), cur[2] + 1]
            else:
                if cur:
                    want += [(sid, sp, "period", *cur), (sid, sp, "gap", cur[1], s, 0)]
                cur = [s, e, 1]
        want.append((sid, sp, "period", *cur))
    assert got == sorted(want)
    assert periods.periods_and_gaps(periods.interval_rows(df.limit(0), ["sid", "speaker"], ["sid", "frame_idx"], "start_s", "end_s"), ["sid", "speaker"]).count() == 0


def naive_values(values, weights, delta=0.15, short=4000):
    runs = [[i] for i in range(len(values))]

    def val(r):
        w = sum(weights[i] for i in r if values[i] is not None)
        return sum(values[i] * weights[i] for i in r if values[i] is not None) / w if w else None

    def far(a, b):
        x, y = val(a), val(b)
        return 0.0 if x is None or y is None or max(abs(x), abs(y)) == 0 else abs(x - y) / max(abs(x), abs(y))

    while len(runs) > 1:
        d, i = min((far(runs[i], runs[i + 1]), i) for i in range(len(runs) - 1))
        if d < delta:
            runs[i : i + 2] = [runs[i] + runs[i + 1]]
            continue
        for i, r in enumerate(runs):
            if sum(weights[k] for k in r) < short:
                j = min([x for x in (i - 1, i + 1) if 0 <= x < len(runs)], key=lambda x: (far(r, runs[x]), -sum(weights[k] for k in runs[x])))
                lo = min(i, j)
                runs[lo : lo + 2] = [runs[lo] + runs[lo + 1]]
                break
        else:
            break
    return runs


def naive_labels(labels, weights, short=4000):
    size = lambda r: sum(weights[i] for i in r)

    def vote(r):
        v = defaultdict(float)
        for i in r:
            if labels[i] is not None:
                v[labels[i]] += weights[i]
        return max(v.items(), key=lambda x: (x[1], x[0]))[0] if v else None

    def joined(runs):
        out = []
        for lab, r in runs:
            if out and out[-1][0] == lab:
                out[-1][1].extend(r)
            else:
                out.append((lab, list(r)))
        return out

    runs = joined([(x, [i]) for i, x in enumerate(labels)])
    while len(runs) > 1 and (i := next((i for i, (_, r) in enumerate(runs) if size(r) < short), None)) is not None:
        left, right = (size(runs[i - 1][1]) if i else -1), (size(runs[i + 1][1]) if i + 1 < len(runs) else -1)
        j = i - 1 if left >= right else i + 1
        runs[j] = (runs[j][0], sorted(runs[j][1] + runs[i][1]))
        runs.pop(i)
        runs = joined(runs)
    runs = [r for _, r in runs]
    i = 0
    while i < len(runs) - 1:
        if vote(runs[i]) == vote(runs[i + 1]):
            runs[i : i + 2] = [runs[i] + runs[i + 1]]
            i = 0
        else:
            i += 1
    return [(r, vote(r)) for r in runs]


@pytest.mark.parametrize("seed", range(60))
def test_timelines_as_restarting_loops(seed):
    rng = random.Random(seed)
    n = rng.randrange(0, 40)
    w = [float(rng.choice([600, 1500, 2500, 4000, 9000])) for _ in range(n)]
    v = [rng.choice([None, float(rng.randrange(1, 31))]) if rng.random() < 0.3 else float(rng.randrange(1, 31)) for _ in range(n)]
    lab = [rng.choice(["en", "de", "zh", None]) for _ in range(n)]
    assert timelines.value_runs(v, w) == (naive_values(v, w) if n else [])
    assert timelines.label_spans(lab, w) == (naive_labels(lab, w) if n else [])


def test_timeline_frames(segs, rows):
    for t in (timelines.value_timeline(segs, "q"), timelines.label_timeline(segs, "lang")):
        got = t.collect()
        assert sum(r.n_seg for r in got) == len(rows)
        assert sum(r.speech_ms for r in got) == sum(r[3] - r[2] for r in rows)
    assert timelines.value_timeline(segs.limit(0), "q").count() == 0


def test_interval_joins_as_loops(spark, rows):
    rng = random.Random(1)
    a = [("r", i, s, s + rng.choice([500, 5000, 130_000])) for i, s in enumerate(rng.sample(range(0, 600_000, 100), 60))]
    b = [("r", i, s, s + rng.choice([700, 5000, 90_000])) for i, s in enumerate(rng.sample(range(0, 600_000, 100), 60))]
    A_, B_ = spark.createDataFrame(a, "sid string, a_idx long, as long, ae long"), spark.createDataFrame(b, "sid string, b_idx long, bs long, be long")
    got = sorted((r.a_idx, r.b_idx) for r in J.overlaps(A_, B_, ["sid"]).collect())
    assert got == sorted((x[1], y[1]) for x in a for y in b if x[2] < y[3] and y[2] < x[3])
    best = {r.a_idx: r.b_idx for r in J.best_overlap(A_, B_, 0.3).collect()}
    for x in a:
        c = [((min(x[3], y[3]) - max(x[2], y[2])) / (max(x[3], y[3]) - min(x[2], y[2])), -y[2], y[1]) for y in b if x[2] < y[3] and y[2] < x[3]]
        top = max(c, default=(0,))
        assert best.get(x[1]) == (top[2] if top[0] >= 0.3 else None)
    pts = spark.createDataFrame([("r", t, t) for t in range(0, 600_000, 9_999)], "sid string, p long, t long")
    at = {r.p: r.idx for r in J.at_point(pts, B_.select("sid", F.col("b_idx").alias("idx"), F.col("bs").alias("s"), F.col("be").alias("e"))).collect()}
    for t in range(0, 600_000, 9_999):
        c = [(y[3] - y[2], y[1]) for y in b if y[2] <= t <= y[3]]
        assert at.get(t) == (min(c)[1] if c else None)
    assert J.best_overlap(A_.limit(0), B_).count() == 0


def test_nearest_label_as_loop(rows, segs):
    got = {r.idx: r.label for r in J.nearest_label(segs, "lang").collect()}
    for rs in by_sid(rows).values():
        have = [(r[2] + r[3], r[1], r[6]) for r in rs if r[6]]
        for r in rs:
            mid = r[2] + r[3]
            near = min(have, key=lambda h: (abs(h[0] - mid), h[0] > mid))
            if not r[6]:
                assert abs(near[0] - mid) in {abs(h[0] - mid) for h in have if h[2] == got[r[1]]}
            else:
                assert got[r[1]] == r[6]


def test_merges_fail_closed(spark):
    base, stage = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string"), spark.createDataFrame([(1, "t")], "id long, y string")
    assert sorted((r.id, r.y) for r in J.merged(base, stage, "id").collect()) == [(1, "t"), (2, None)]
    for b, s, partial in ((base.union(base), stage, True), (base, stage.union(stage), True), (base.where("id = 2"), stage, True), (base, stage, False)):
        with pytest.raises(ValueError):
            J.merged(b, s, "id", partial)
    d = J.applied_delta(base, spark.createDataFrame([(1, "c")], base.schema), base.where("id = 2"), "id")
    assert [(r.id, r.x) for r in d.collect()] == [(1, "c")]
    with pytest.raises(ValueError):
        J.applied_delta(base, spark.createDataFrame([(9, "c")], base.schema), base.limit(0), "id")
    r = spark.createDataFrame([(i % 2, i) for i in range(50)], "k long, v long").repartition(4)
    assert sorted((x.k, x.v) for x in J.ranked_within(r, ["k"], [F.desc("v")], 2).collect()) == [(0, 46), (0, 48), (1, 47), (1, 49)]


def test_scalars_at_their_borders(spark):
    import math
    import zlib
    from hashlib import md5

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    lit = F.lit
    assert [one(X.bucket(lit(v), (-27.0, -19.0), ("a", "b", "c"))) for v in (-27.1, -27.0, -19.0, -18.9, math.nan)] == ["a", "b", "b", "c", None]
    assert one(X.char_count(lit(" a-b, 字。　"))) == 3 and one(X.char_count(lit(None).cast("string"))) is None
    assert [one(X.seconds_per_char_ok(lit(s), lit(n), lit(g))) for s, n, g in ((0.015, 1, "en"), (0.0149, 1, "en"), (0.04, 1, " ZH "), (2.01, 1, "ja"), (1.0, 0, "en"))] == [True, False, True, False, False]
    assert [one(X.speech_rate(lit(n), lit(s))) for n, s in ((10, 0.5), (10, 0.49), (0, 1.0))] == [20.0, None, None]
    assert [one(X.age_band(lit(a))) for a in (12.9, 13.0, 18.0, 43.0, 60.0)] == ["child", "teen", "young", "middle", "senior"] and one(X.age_band(lit(50.0), lit("child"))) == "child"
    assert one(X.hex_modulo(F.md5(lit("q").cast("binary")), 97)) == int(md5(b"q").hexdigest(), 16) % 97
    assert one(X.crc_shard(lit("parent"), 7)) == zlib.crc32(b"parent") % 7
    assert [one(X.nearest_sample(lit(t), 2)) for t in (0.25, 0.75, 1.0)] == [0, 2, 2] and one(X.truncated_sample(lit(1.99), 2, lit(3))) == 3
    assert [one(X.round_robin(lit(i), [2, 1])) for i in range(4)] == [0, 1, 0, 0]
    assert one(X.clipped(lit("aaaa bbbb cc"), 10)) == "aaaa bbbb ..." and one(X.clipped(lit("a bbbbbbbbbbb"), 10)) == "a bbbbbbbb ..." and one(X.clipped(lit("short"), 10)) == "short"
    assert one(X.relative_distance(lit(0.0), lit(0.0))) == 0.0 and one(X.relative_distance(lit(3.0), lit(4.0))) == 0.25
    clean, tags = X.split_tags(lit("hi [Cough]  there [x1] [Throat-clearing]"))
    assert one(clean) == "hi there [x1]" and one(tags) == ["Cough", "Throat-clearing"]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], SEG)
    for df in (sequences.window_metrics(none), sequences.capped_units(none), sequences.long_chunks(none), sequences.label_runs(none, "lang"), sequences.cut_windows(none), sequences.transcript(sequences.gap_windows(none)), A.weighted_vote(none, ["sid"], "lang", F.col("e") - F.col("s")), A.covering_labels(none, ["sid"], "lang", F.col("e")), A.indexed_quantiles(none, ["sid"], "q", [0.5]), A.grouped_voices(none, "sid", "spk"), J.nearest_label(none, "lang")):
        assert df.count() == 0


def test_vote_ties_and_zero_weights(spark):
    df = spark.createDataFrame([("r", "a", 2), ("r", "b", 2), ("r", None, 9), ("r", "", 9), ("z", "a", 0)], "sid string, lab string, w long")
    assert {r.sid: (r.label, r.share) for r in A.weighted_vote(df, ["sid"], "lab", F.col("w")).collect()} == {"r": ("b", 0.5), "z": ("a", None)}


def test_speaker_cuts_as_loop(spark):
    rng = random.Random(12)
    rows = []
    at = 0
    for i in range(400):
        at += rng.choice([0, 200, 1500, 2900, 3000, 9000, 2_000_000])
        rows.append((rng.choice(["hot", "hot", "b"]), i, at, at + rng.choice([100, 400, 3000, 14_000, 29_000, 70_300]), rng.choice(["A", "A", "B"])))
    got = sorted((r.sid, r.spk, r.unit_start, r.unit_end, r.n) for r in records.speaker_cuts(spark.createDataFrame(rows, "sid string, idx long, s long, e long, spk string")).collect())
    want = []
    for rs in by_sid([(r[0], r[1], r[2], r[3], r[4]) for r in rows]).values():
        out = []
        for sid, _, s, e, spk in rs:
            if out and out[-1][1] == spk and e - s <= 30_000 and s - out[-1][3] < 3000 and e - out[-1][2] <= 30_000:
                out[-1][3] = max(out[-1][3], e)
                out[-1][4] += 1
            else:
                out += [[sid, spk, x, min(x + 30_000, e), 1] for x in range(s, e, 30_000)]
        want += [tuple(u) for u in out if u[3] - u[2] >= 500]
    assert got == sorted(want)


def test_records_fail_closed(spark):
    spans = spark.createDataFrame([("r", 0, 5, "A", "old"), ("r", 5, 9, "A", "old")], "sid string, s long, e long, spk string, tag string")
    dec = "sid string, s long, e long, spk string, verdict string, tag string"
    got = records.synced_spans(spans, spark.createDataFrame([("r", 0, 5, "A", "drop", None), ("r", 9, 12, "B", "replace", "new"), ("r", 20, 22, "B", "keep", None)], dec)).collect()
    assert sorted((r.s, r.tag) for r in got) == [(5, "old"), (9, "new")]
    with pytest.raises(ValueError):
        records.synced_spans(spans, spark.createDataFrame([("r", 0, 5, "A", "drop", None), ("r", 0, 5, "A", "keep", None)], dec))
    index = spark.createDataFrame([("a", 1), ("b", None)], "id string, at long")
    one = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert records.strict_selection(one("a"), index, "id", ["at"]).count() == 1
    for bad in (one("a", "a"), one("b"), one("c")):
        with pytest.raises(ValueError):
            records.strict_selection(bad, index, "id", ["at"])


def test_repeats():
    assert verdicts.most_repeats(None) == verdicts.most_repeats("a b c") == 1
    assert verdicts.most_repeats("a b c d e f " * 4) == 4 and verdicts.most_repeats("abcdefghij" * 3) == 3
    assert verdicts.repeated_share(["w"] * 17) == 0.0 and verdicts.repeated_share(["a", "b", "c", "d"] * 6) == 1.0
    assert verdicts.repeated_share([str(i) for i in range(40)]) == 0.0


def test_every_row_has_its_rank(spark):
    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.8 else "b", i, rng.choice([1.0, 1.0, 2.5, float("inf")])) for i in range(400)] + [("c", 400, None)]
    got = ordered.ranged_rank(spark.createDataFrame(rows, "sid string, idx long, key double").repartition(7), ["sid"], [F.asc_nulls_last("key"), F.asc("idx")], "rank").collect()
    assert len(got) == len(rows)
    for sid in ("hot", "b", "c"):
        want = [i for _, i, _ in sorted((r for r in rows if r[0] == sid), key=lambda r: (r[2] is None, r[2] or 0, r[1]))]
        assert [r.idx for r in sorted((r for r in got if r.sid == sid), key=lambda r: r["rank"])] == want
        assert sorted(r["rank"] for r in got if r.sid == sid) == list(range(1, len(want) + 1))


def test_repeated_share_of_texts_without_spaces(spark):
    texts = ["我们今天去公园散步吧" * 8, "今日は、とても良い天気ですね。" * 8, "ฉันไปตลาดทุกวันเลย" * 8, "城里的人们在等火车因为它晚点了没有人知道为什么这已经是第三次了他们问发生了什么事", "短い" * 10, "a b c d " * 6, None]
    got = {r.k: r.share for r in verdicts.with_repeated_share(spark.createDataFrame(list(enumerate(texts)), "k long, text string"), "k", "text").collect()}
    assert got[0] == got[1] == 1.0 and got[2] >= 0.8 and got[5] == 1.0
    assert got[3] == got[4] == got[6] == 0.0


def test_points_in_gaps_take_the_nearest_segment(spark):
    rng = random.Random(5)
    segs = [("r" if i % 3 else "h", i, s, s + rng.choice([400, 5000, 60_000])) for i, s in enumerate(rng.sample(range(0, 40_000_000, 500), 50))]
    pts = [(sid, t, t) for sid in ("r", "h", "none") for t in range(-5_000_000, 50_000_000, 777_750)]
    got = J.at_or_nearest(spark.createDataFrame(pts, "sid string, p long, t long"), spark.createDataFrame(segs, "sid string, idx long, s long, e long")).collect()
    want = {}
    for sid, p, t in pts:
        of = [x for x in segs if x[0] == sid]
        held = [(e - s, i) for _, i, s, e in of if s <= t <= e]
        if of:
            want[sid, p] = (min(held)[1], "inside") if held else (min((min(abs(t - s), abs(t - e)), i) for _, i, s, e in of)[1], "nearest")
    assert len(got) == len(want) and {(r.sid, r.p): (r.idx, r.source) for r in got} == want and {x for _, x in want.values()} >= {"nearest"}
