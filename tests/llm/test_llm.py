import os
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from phonoloom.llm import groups, labels, language, mixing, packing, pieces, queries, repetition, sentences, tokens, turns
from phonoloom.llm.speakers import is_person, speaker_key

SEG = "seg_id long, sid string, seg_index string, start_s double, end_s double, speaker string, text string, language string, dnsmos double, ingested_at timestamp"


def seg_rows(spark, rows, extra=""):
    """rows: (seg_id, sid, start, end, speaker, text, language)."""
    return spark.createDataFrame([(a, b, None, s, e, sp, t, g, None, None) for a, b, s, e, sp, t, g in rows], SEG)


def clashing(df):
    """The frame with extra columns named like the operators' own."""
    for c in ("hour", "ms", "named", "words", "spoken", "k", "b", "s", "e", "lo", "hi", "bin", "n", "m", "h", "root", "size", "budget", "epochs", "piece", "v1", "grp", "low", "rest", "upto"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


# p1


@pytest.mark.parametrize(
    "label,key",
    [
        (None, None), ("", None), ("  ", None), ("?", None), ("UNKNOWN", None), ("n/a", None), ("SPEAKER_01", "S1"), ("SPK-02", "S2"), ("ＳＰＫ３", "S3"), ("<spk:0>", "S0"), ("[S4]", "S4"), (" s05 ", "S5"),
        ("Speaker 007:", "S7"), ("说话人 1", "S1"), ("話者2", "S2"), ("화자3", "S3"), ("Спикер1", "S1"), ("ผู้พูด 4", "S4"), ("वक्ता3", "S3"), ("Ann  Lee", "ann lee"), ("ANN_LEE", "ann lee"), ("Ann Lee (host)", "ann lee"),
        ("Ann Lee [guest]", "ann lee"), ("Ann Lee - moderator", "ann lee"), ("Ann Lee:", "ann lee"), ("host", None), ("...", None),
    ],
)
def test_speaker_key(label, key):
    assert speaker_key(label) == key
    assert is_person(key) == (key is not None and not (key[0] == "S" and key[1:].isdigit()))


@pytest.mark.parametrize(
    "text,who,words",
    [
        (None, None, ""), ("", None, ""), ("   ", None, ""), ("♪ ♪ ♪", None, ""), ("uhm, hmmm.", None, ""), ("[00:00:03] (laughs)", None, ""), ("00:01:05,310 --> 00:01:08,310 mm <noise>", None, ""),
        ("SPK2 - (06:01) [Cough] The orchard.", "S2", "The orchard."), ("Speaker 0: erm, We bought it.", "S0", "We bought it."), ("[Ann Lee] We bought it.", "ann lee", "We bought it."), ("ANN LEE: Yes.", "ann lee", "Yes."),
        ("話者 1: 嗯、静かな村です。", "S1", "静かな村です。"), ("Ann asked: who came?", None, "Ann asked: who came?"), ("[S1] *sighs*", "S1", ""), ("en el 2020 llegamos", None, "en el 2020 llegamos"),
    ],
)
def test_tagger(text, who, words):
    assert turns.tag(turns.Tagger.fit([]), text, None) == (who, words)


def test_tagger_decodes_as_brute_force():
    from itertools import product

    t = turns.Tagger.fit([])
    rng = random.Random(1)
    for _ in range(20):
        obs = [rng.randrange(turns.N_OBS) for _ in range(5)]

        def score(p):
            return t.start[p[0]] + t.emit[p[0]][obs[0]] + sum(t.step[a][b] + t.emit[b][o] for a, b, o in zip(p, p[1:], obs[1:]))

        assert score(t._viterbi(tuple(obs))) == pytest.approx(max(score(p) for p in product(range(turns.N_STATES), repeat=5)))


def test_the_sequence_model_decides():
    # the training rule takes a doubtful sound beside a word for speech; in the sequences it is hesitation before a mark, and speech between words
    texts = ["er, we left the town", "so, um, they came home, late", "[00:10] um, yes, of course", "er, er, who knows"] * 30 + ["wir sahen, dass er kam"]
    t = turns.Tagger.fit([turns.observed(turns.tokens(x), x, None) for x in texts])
    for text, want in (("Dr. Fox opened er, the tunnel", "Dr. Fox opened, the tunnel"), ("dass er heute kam", "dass er heute kam")):
        assert turns.tag(t, text, None)[1] == want
    obs = turns.observed(toks := turns.tokens("Dr. Fox opened er, the tunnel"), "Dr. Fox opened er, the tunnel", None)
    assert len(toks) and t.decode(obs) != [turns.SPEECH if x == turns.MARK else x for x in turns.weak_states(obs)]


def brute_turns(rows):
    out, tagger = [], turns.Tagger.fit([])
    by = defaultdict(dict)
    for r in rows:
        if r[1] is not None and r[2] is not None:
            by[r[1]][r[0]] = r
    for sid, segs in by.items():
        cur = last = None
        for r in sorted(segs.values(), key=lambda r: (r[2], r[0])):
            who, words = turns.tag(tagger, r[5], r[6])
            cur = speaker_key(r[4]) or who or cur
            if words and cur:
                if last and last[1] == cur:
                    last[3] = r[0]
                else:
                    last = [sid, cur, r[0], r[0]]
                    out.append(last)
    return sorted(map(tuple, out))


def test_turns_across_hours(spark):
    rng = random.Random(7)
    rows = []
    for sid in ("hot", "b", "c"):
        at = 0.0
        for i in range(400 if sid == "hot" else 25):
            at += rng.choice([0.7, 4.0, 900.0, 5000.0])
            rows.append((len(rows), sid, at, at + 1, rng.choice([None, None, "SPEAKER_01", "spk 2", "Ann Lee", "?"]), rng.choice([None, "", "hmm...", "We saw it.", "S3: Yes it is.", "♪"]), None))
    rows += rows[:40] + [(9999, None, 1.0, 2.0, "x", "y", None), (9998, "b", None, 2.0, "x", "y", None)]
    df = clashing(seg_rows(spark, rows))
    got = turns.speaker_turns(turns.tagged_segments(df, turns.fit_tagger(df)))
    assert sorted((r.sid, r.speaker, r.first_seg, r.last_seg) for r in got.collect()) == brute_turns(rows)
    none = seg_rows(spark, [])
    assert turns.speaker_turns(turns.tagged_segments(none, turns.fit_tagger(none)), with_times=True).count() == 0


def test_both_branches_pass_over_labels_that_name_nobody():
    t = turns.Tagger.fit([])
    for text, who in (("[Host] Speaker 2: we saw it.", "S2"), ("[Interviewer] Speaker 3: hi there", "S3"), ("[Host] we saw it.", None), ("We saw it. Speaker 2: yes", None)):
        assert turns.tag(t, text, "en")[0] == turns.tag(t, text, "en", clean_text=False)[0] == who


def test_turns_with_text(spark):
    rows = [
        (1, "r", 0.0, 2.0, "spk 1", "S1: Uh, we saw it.", "en"), (2, "r", 3000.0, 3001.5, None, "[00:12] It was red.", "en"), (3, "r", 3599.0, 3590.0, None, "[music]", "en"),
        (4, "r", 3700.0, None, "spk 1", "And then gone.", "en"), (5, "r", 3701.0, 3702.0, "Ann Lee", "Really?", "en"), (6, "r", 7300.0, 7200.0, "Ann Lee", "Yes.", "en"),
        (2, "r", 3000.0, 3001.5, None, "[00:12] It was red.", "en"),
    ]
    df = clashing(seg_rows(spark, rows))
    got = turns.speaker_turns(turns.tagged_segments(df, turns.fit_tagger(df)), with_times=True, with_text=True).orderBy("start_ms").collect()
    assert [(r.speaker, r.first_seg, r.last_seg, r.n_segments, r.start_ms, r.last_start_ms, r.end_ms) for r in got] == [
        ("S1", 1, 4, 3, 0, 3_700_000, 3_001_500), ("ann lee", 5, 6, 2, 3_701_000, 7_300_000, 3_702_000)]
    assert [r.text for r in got] == ["we saw it. It was red. And then gone.", "Really? Yes."]
    assert "p1_turns" in queries.queries()


# p2


def brute_share(text, words=8, chars=20):
    us, by_char = repetition.units(text)
    n = chars if by_char else words
    seen, hit = set(), [False] * len(us)
    for i in range(len(us) - n + 1):
        g = tuple(us[i : i + n])
        if g in seen:
            hit[i : i + n] = [True] * n
        seen.add(g)
    return sum(len(u) for u, h in zip(us, hit) if h) / max(1, sum(map(len, us)))


def test_shares_as_brute_force():
    rng = random.Random(3)
    texts = [None, "", "  ", "...", "one", "a b c d e f g h i", "A b, c d! e f g h. a B c d e f g h?", "同じ言葉を何度も言います。" * 6, "ฉันคิดว่า" * 30, "word " * 30_000]
    for _ in range(60):
        base = [rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa lam mu".split()) for _ in range(rng.randrange(40))]
        texts.append(" ".join(base * rng.choice([1, 1, 2, 3])) + rng.choice(["", " end."]))
    got = repetition.shares(texts)[:, 0]
    want = [brute_share(t) if t else 0.0 for t in texts]
    np.testing.assert_allclose(got, want, atol=1e-9)


@pytest.mark.parametrize("spam", [0.05, 0.5, 1.0])
def test_outliers_lose_no_repetitive_text(spark, spam):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(160):
        t = " ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 60)))
        rows.append(("t", str(i), t + (" " + t) * 3 if rng.random() < spam else t, rng.choice(["en", "xx", None]), rng.choice(["a", None])))
    rows += rows[:10] + [("t", None, "x y", None, None), ("t", "null", None, "en", "a"), ("t", "blank", " ", "en", "a")]
    df = clashing(spark.createDataFrame(rows, "tbl string, row_key string, text string, label string, source string"))
    got = sorted(r.row_key for r in repetition.repetitive(repetition.statistics(df)).collect())
    assert got == sorted({r[1] for r in rows if r[1] and r[2] and brute_share(r[2]) >= 1 / 3})


def cells_of(x, grid=repetition.GRID):
    import pandas as pd

    cell = pd.factorize(pd.Series(map(tuple, np.floor(x * grid).astype(int))))[0]
    n = np.bincount(cell).astype(float)
    sums = np.stack([np.bincount(cell, x[:, i]) for i in range(3)], 1)
    products = np.stack([[np.bincount(cell, x[:, i] * x[:, j]) for i in range(3)] for j in range(3)]).transpose(2, 0, 1)
    return n, sums, products


def test_least_determinant_as_every_subset():
    from itertools import combinations

    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal((0.2, 0.3, 0.7), 0.05, (8, 3)), rng.normal((0.9, 1.0, 0.3), 0.02, (5, 3))])
    n, sums, products = cells_of(x, 10_000)  # every row its own cell
    half = (len(x) + 4) // 2
    ridge = np.eye(3) * repetition.RIDGE**2
    best = min((np.linalg.slogdet(np.cov(x[list(c)].T, bias=True) + ridge)[1], c) for c in combinations(range(len(x)), half))
    want = x[list(best[1])]
    m, cov = want.mean(0), np.cov(want.T, bias=True) * repetition.consistency(half / len(x)) + ridge
    near = x[repetition._far(x, m, cov) <= repetition.CHI2_3]
    m, cov = near.mean(0), np.cov(near.T, bias=True) * repetition.consistency(0.975) + ridge
    got = repetition.mcd(n, sums, products)
    np.testing.assert_allclose(got[0], m, atol=1e-9)
    np.testing.assert_allclose(got[1], cov, atol=1e-9)


@pytest.mark.parametrize("spam", [0.0, 0.2, 0.45])
def test_estimate_ignores_spam(spam):
    rng = np.random.default_rng(4)
    clean = np.clip(rng.normal((0.1, 0.2, 0.9), (0.04, 0.06, 0.03), (2000, 3)), 0, 1)
    bad = rng.normal((1.0, 1.05, 0.5), 0.05, (int(2000 * spam / (1 - spam)), 3))
    m, cov = repetition.mcd(*cells_of(np.vstack([clean, bad])))
    np.testing.assert_allclose(m, clean.mean(0), atol=0.02)
    assert np.all(np.sqrt(np.diag(cov)) < 0.1) and not repetition.broken(m, cov)
    assert (repetition._far(bad, m, cov) > repetition.CHI2_3).all()


def test_rejection_is_by_group(spark):
    # one vector, in a group where it is usual, in one where it is not, in one made of repetition, and in one too small
    def row(k, source, v):
        return ("t", str(k), "en", source, float(np.sin(v[0]) ** 2), *map(float, v))

    rng = np.random.default_rng(6)
    usual = rng.normal((0.3, 0.4, 0.8), (0.13, 0.13, 0.05), (600, 3))
    clean = np.clip(rng.normal((0.02, 0.1, 0.9), (0.02, 0.05, 0.05), (900, 3)), 0, 1)
    spam = rng.normal((1.1, 1.1, 0.5), 0.03, (200, 3))
    rows = [row(i, s, v) for i, (s, v) in enumerate([("usual", v) for v in usual] + [("clean", v) for v in clean] + [("spam", v) for v in spam])]
    probe = (0.62, 0.6, 0.78)
    rows += [row(f"probe_{s}", s, probe) for s in ("usual", "clean", "spam", "small")]
    df = spark.createDataFrame(rows, "tbl string, row_key string, lang string, source string, share double, v1 double, v2 double, v3 double")
    got = {r.row_key: r.grp for r in repetition.outliers(df).collect()}
    assert {k for k in got if k.startswith("probe")} == {"probe_clean", "probe_spam", "probe_small"}  # the estimate decides, not the share
    assert got["probe_clean"] == "en|clean" and got["probe_spam"] == "*" and got["probe_small"] == "*"
    assert sum(r[3] == "spam" and r[1] in got for r in rows) == 201
    assert repetition.repetitive(df).where("row_key like 'probe%'").count() == 3


def test_no_texts_no_outliers(spark):
    none = spark.createDataFrame([], "tbl string, row_key string, text string, label string, source string")
    assert repetition.repetitive(repetition.statistics(none)).count() == 0


# p3

SAMPLES = {
    "en": "the people of the town were waiting for the train because it was late and nobody knew why; this was the third time and they asked what had happened",
    "de": "die leute der stadt warteten auf den zug weil er zu spät war und niemand wusste warum; das war schon das dritte mal und sie fragten was geschehen sei",
    "fr": "les gens de la ville attendaient le train parce qu'il était en retard et personne ne savait pourquoi; elles demandaient ce qui était arrivé",
    "es": "la gente de la ciudad esperaba el tren porque llegaba tarde y nadie sabía por qué; era la tercera vez y ellos preguntaron qué había pasado",
    "pt": "as pessoas da cidade esperavam o trem porque estava atrasado e ninguém sabia por quê; era a terceira vez e eles perguntaram o que tinha acontecido",
    "ru": "люди города ждали поезд потому что он опаздывал и никто не знал почему; это было уже в третий раз и они спросили что случилось",
    "uk": "люди міста чекали на потяг тому що він запізнювався і ніхто не знав чому; це було вже втретє і вони запитали що сталося",
    "zh": "城里的人们在等火车，因为它晚点了，没有人知道为什么，这已经是第三次了，他们问发生了什么事",
    "ja": "町の人々は電車を待っていましたが、遅れていて、誰も理由を知りませんでした。これで三回目でした",
    "ko": "마을 사람들은 기차를 기다리고 있었지만 늦어서 아무도 그 이유를 몰랐습니다 벌써 세 번째였습니다",
    "th": "ชาวเมืองกำลังรอรถไฟเพราะมันมาสายและไม่มีใครรู้ว่าทำไมนี่เป็นครั้งที่สามแล้ว",
    "hi": "शहर के लोग ट्रेन का इंतज़ार कर रहे थे क्योंकि वह देर से थी और किसी को पता नहीं था कि क्यों",
}


def profiles():
    from collections import Counter

    counts = {}
    for g, t in SAMPLES.items():
        counts[g] = Counter(n for w in language.stretches(t)[0] for n in language.ngrams(w))
    return language.Profiles(counts)


@pytest.mark.parametrize("top", [None, 5])
def test_out_of_place_as_brute_force(top):
    from collections import Counter

    p = profiles()
    rank = {}
    counts = {g: Counter(n for w in language.stretches(t)[0] for n in language.ngrams(w)) for g, t in SAMPLES.items()}
    for code, c in counts.items():
        rank[code] = {g: r for r, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[: p.depth])}
    texts = ["the old town", "banana banana und der zug", "zzzz qqqq", "ab", "когда поезд поезд"]
    words = [language.stretches(t)[0] for t in texts]
    ids = np.array([p.id_of(w) for ws in words for w in ws])
    gram, size = p.spelled(ids)
    got = p.out_of_place(np.repeat(np.repeat(np.arange(len(texts)), [len(w) for w in words]), size), gram, len(texts) + 1, top)
    for i, ws in enumerate(words):
        own = Counter(n for w in ws for n in language.ngrams(w))
        place = {g: sum(c > own[g] for c in own.values()) for g in own}
        use = [g for g in own if top is None or place[g] < top]
        for j, code in enumerate(language.CODES):
            want = sum(abs(place[g] - rank[code][g]) / p.depth if g in rank[code] else 1.0 for g in use)
            assert got[i, j] == pytest.approx(want, abs=1e-4)
        assert got[i, -1] == len(use)
    assert not got[-1].any()


@pytest.mark.parametrize("top", [None, 5])
def test_slices_change_nothing(top):
    p, rng = profiles(), random.Random(3)
    vocab = [w for t in SAMPLES.values() for w in language.stretches(t)[0]]
    lens = [3, 0, 40, 1, 200, 7, 7, 0]
    words = np.array([p.id_of(rng.choice(vocab)) for _ in range(sum(lens))])
    item = np.repeat(np.arange(len(lens)), lens)
    want = p.of_words(words, item, len(lens), top)
    for most in (1, 5, 10, 50):
        np.testing.assert_allclose(p.of_words(words, item, len(lens), top, most), want, rtol=1e-5)


def test_a_texts_own_ranks_decide():
    # the profiles hold the same n-grams, in another order: only the text's own order tells them apart
    from collections import Counter

    p = language.Profiles({"en": Counter({"a": 100, "b": 50, "c": 10, "d": 5}), "de": Counter({"a": 5, "b": 10, "c": 50, "d": 100})}, depth=4)
    gram = np.array([p.row[g] for g in "aaaabbbccd" + "ddddcccbba"])
    far = p.out_of_place(np.repeat([0, 1], 10), gram, 2)
    en, de = language.CODES.index("en"), language.CODES.index("de")
    assert far[0, en] == 0 < far[0, de] and far[1, de] == 0 < far[1, en]


def test_languages_single_and_mixed():
    p = profiles()
    halves = {g: t[: len(t) // 2] if g in ("zh", "th") else t.rsplit(" ", 8)[0] for g, t in SAMPLES.items()}
    got = language.languages(p, list(halves.values()))
    assert [x[0][0] for x in got] == list(halves) and all(len(x) == 1 and 0 <= x[0][1] <= 1 for x in got)
    for a, b in (("en", "ja"), ("ru", "th"), ("de", "hi"), ("zh", "ko"), ("fr", "uk"), ("en", "de"), ("es", "ru")):
        pair = language.languages(p, [SAMPLES[a] + ". " + SAMPLES[b]])[0]
        assert {x for x, _ in pair} == {a, b}
    assert language.languages(p, [None, "", " ", "...", "12 34", "[music] (laughs)", "hmm, uh.", "э-э, ммм.", "えーと……", "เอ่อ……"]) == [[] for _ in range(10)]
    # names are no language of their own
    assert [x for x, _ in language.languages(p, ["Boris Vangdra: " + SAMPLES["ru"] + " Anna Krevlisk."])[0]] == ["ru"]


def test_parts_of_mixed_texts():
    p, S = profiles(), SAMPLES
    for langs in (("en", "de", "en"), ("en", "ru", "ja"), ("de", "hi", "de", "ko"), ("en", "fr", "es"), ("ru", "uk", "ru")):
        text = "[S1] " + ". ".join(S[g] for g in langs)
        found, parts = language.spoken(p, [text])[0]
        assert {g for g, _ in found} == set(langs) and len(found) == len(set(langs))
        assert [g for _, _, g, _ in parts] == list(langs) and all(0 <= c <= 1 for *_, c in parts)
        at = 5
        for g, (s, e, _, _) in zip(langs, parts):
            # parts begin and end at words, marks between them lie in none
            assert abs(s - at) <= 2 and abs(e - (at + len(S[g]))) <= 2
            at += len(S[g]) + 2
    assert [x[1] for x in language.spoken(p, [None, " ", "...", S["ko"]])[:3]] == [[], [], []]
    assert [(s, e, g) for s, e, g, _ in language.spoken(p, [S["ko"]])[0][1]] == [(0, len(S["ko"]), "ko")]


def test_identified_gives_a_row_per_part(spark):
    text = ". ".join(SAMPLES[g] for g in ("en", "hi", "en"))
    df = spark.createDataFrame([("t", "1", text, "en")], "tbl string, row_key string, text string, label string")
    got = language.identified(df, profiles()).orderBy("start_char").collect()
    assert [(r.lang, r.n_langs) for r in got] == [("en", 2), ("hi", 2), ("en", 2)] and all(r.start_char < r.end_char for r in got)
    assert sorted(r.lang for r in language.mislabelled(language.identified(df, profiles())).collect()) == ["en", "hi"]


def test_label_codes():
    assert [labels.label_code(x) for x in (None, "", "und", "EN", "en_GB", "zh-Hans", "cmn", "Portuguese", "pt-BR", "es_419", "??", "zxx")] == [None, None, None, "en", "en", "zh", "zh", "pt", "pt", "es", None, None]


def test_mislabelled_rows(spark):
    rows = [("t", g, SAMPLES[g], lab) for g, lab in zip(SAMPLES, ("en-US", "en", None, "spa", "und", "ru", "ru", "cmn", "Japanese", "ko", "", "hi"))]
    rows += rows + [("t", "mix", SAMPLES["en"] + ". " + SAMPLES["hi"], "en"), ("t", None, "x", "en"), ("t", "n", None, None), ("t", "b", "  ", None)]
    df = clashing(spark.createDataFrame(rows, "tbl string, row_key string, text string, label string"))
    got = sorted((r.row_key, r.lang) for r in language.mislabelled(language.identified(df, profiles())).collect())
    assert got == sorted([("de", "de"), ("fr", "fr"), ("pt", "pt"), ("uk", "uk"), ("th", "th"), ("mix", "en"), ("mix", "hi")])
    fitted = language.fit_profiles(spark.createDataFrame([(str(i), t, g) for i, (g, t) in enumerate(SAMPLES.items())] + [("z", None, "en"), (None, "q", None)], "key string, text string, label string"))
    assert language.languages(fitted, [SAMPLES["ko"]])[0][0][0] == "ko"
    assert language.mislabelled(language.identified(df.limit(0), fitted)).count() == 0


# p4


def test_components_as_union_find(spark):
    rng = random.Random(11)
    edges = [(f"n{rng.randrange(80):02d}", f"n{rng.randrange(80):02d}") for _ in range(60)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(70)] + [("hub", f"q{i:03d}") for i in range(200)]
    edges = [(a, b) for a, b in edges if a != b] * 2
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in groups.hash_to_min(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert groups.hash_to_min(spark.createDataFrame([], "u string, v string")).count() == 0


def test_groups_and_splits(spark):
    rec = "id string, n_speakers int, speakers map<string, struct<speaker:string,gender:string>>"
    v = lambda *names: {f"S{i}": {"speaker": n, "gender": None} for i, n in enumerate(names)}
    rows = [("a", 1, v("vx_01", "SPEAKER_00")), ("b", 2, v(" VX-01 ", None)), ("c", 1, v("SPEAKER_00", "unknown", "")), ("d", 1, None), ("e", 1, v("n/a")), ("f", None, v("vx9")), ("a", 1, v("vx_01", "SPEAKER_00")), (None, 1, v("vx9"))]
    records = clashing(spark.createDataFrame(rows, rec))
    recordings = clashing(spark.createDataFrame([("b", "Studio  One 5"), ("d", "studio_one_5."), ("c", "Anonymous"), ("e", "ANONYMOUS"), ("zz", "Studio One 5"), (None, "Studio One 5"), ("f", None)], "sid string, author string"))
    segments = seg_rows(spark, [(1, "e", 0.0, 1.0, "Ann Lee (host)", "x", None), (2, "f", 0.0, 1.0, "ANN_LEE", "x", None), (3, "c", 0.0, 1.0, "SPEAKER_01", "x", None), (4, "a", 0.0, 1.0, "SPEAKER_01", "x", None), (5, None, 0.0, 1.0, "Ann Lee", None, None)])
    got = {r.id: r.group_id for r in groups.groups(records, recordings, segments).collect()}
    assert got == {"a": "a", "b": "a", "d": "a", "c": "c", "e": "e", "f": "e"}
    placed = groups.splits(records, recordings, segments)
    split = {r.id: r.split for r in placed.collect()}
    assert split["a"] == split["b"] == split["d"] and split["e"] == split["f"]
    nv = spark.createDataFrame([("a_D0000_t0001", None), ("a_D0000_t0001", None), ("b", "b"), ("zz_D1", None), (None, None)], "id string, parent_id string")
    assert {r.id: r.split for r in groups.split_rows(nv, placed).collect()} == {"a_D0000_t0001": split["a"], "b": split["b"], "zz_D1": None}
    assert groups.groups(records.limit(0), recordings, segments).count() == 0


def test_proportions_reached(spark):
    placed = spark.createDataFrame([("a", "a", "train"), ("b", "a", "train"), ("c", "c", "train"), ("d", "d", "test")], "id string, group_id string, split string")
    nv = groups.split_rows(spark.createDataFrame([("a_D0",), ("a_D1",), ("d",), ("zz",)], "id string"), placed)
    got = {r.split: tuple(r)[1:] for r in groups.reached(placed, nv).collect()}
    assert got == {"train": (0.8, 2, 3, 0.75, 2, 0.5), "validation": (0.1, 0, 0, 0.0, 0, 0.0), "test": (0.1, 1, 1, 0.25, 1, 0.25), None: (None, 0, 0, 0.0, 1, 0.25)}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the given tables")
def test_every_record_has_a_split(spark):
    d = "/root/testdata/sf0.001"
    ids = spark.read.parquet(f"{d}/dialogue_records.parquet").where("id is not null").select("id").distinct()
    placed = queries.queries()["p4_records"](spark, d)
    assert sorted(r.id for r in placed.where("split is not null").collect()) == sorted(r.id for r in ids.collect())
    assert placed.groupBy("group_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    got = queries.queries()["p4_proportions"](spark, d).collect()
    assert sum(r.n_records for r in got) == ids.count()


def test_rendezvous_proportions(spark):
    w = {"train": 0.7, "validation": 0.2, "test": 0.1}
    n = {r.s: r["count"] for r in spark.range(20_000).select(groups.rendezvous(F.col("id").cast("string"), w).alias("s")).groupBy("s").count().collect()}
    assert all(abs(n[k] / 20_000 - v) < 0.02 for k, v in w.items())


# p6


def test_cut_pieces():
    rng = random.Random(2)
    for _ in range(400):
        start, limit, overlap = rng.randrange(5000), 30_000, rng.choice([0, 1000])
        end = start + rng.randrange(30_001, 200_000)
        ps = sorted((x, min(end, x + rng.choice([0, 300, 4000, 40_000]))) for x in (rng.randrange(start, end) for _ in range(rng.randrange(12))))
        got, forced = pieces.cut(start, end, ps, limit, overlap)
        assert got[0][0] == start and got[-1][1] == end and all(0 < b - a <= limit for a, b, _ in got)
        assert all(x[1] - y[0] == overlap and x[0] < y[0] for x, y in zip(got, got[1:]))
        at, want = start, False
        for lo, hi in [*ps, (end, end)]:
            want, at = want or lo - at > limit, max(at, hi)
        assert forced == want
        for a, b, hard in got[:-1]:  # a cut that isn't hard has a pause at its end or at the next start
            if not hard:
                assert any(lo <= b <= hi or lo <= b - overlap <= hi for lo, hi in ps)
        assert forced == any(h for *_, h in got)  # hard only where it must be
    assert pieces.cut(0, 10, [], 30, 1) == ([(0, 10, False)], False)


def test_cut_has_fewest_hard_cuts():
    from functools import lru_cache

    rng = random.Random(12)
    for _ in range(300):
        limit, overlap, end = rng.randrange(3, 8), rng.randrange(0, 3), rng.randrange(9, 40)
        ps = [(x, min(end, x + rng.randrange(4))) for x in (rng.randrange(end) for _ in range(rng.randrange(7)))]
        natural = {x for x in range(end) if any(lo <= x <= hi or lo <= x + overlap <= hi for lo, hi in ps)}

        @lru_cache(None)
        def least(x):
            if end - x <= limit:
                return 0
            return min((x + d not in natural) + least(x + d) for d in range(1, limit - overlap + 1))

        got, _ = pieces.cut(0, end, ps, limit, overlap)
        assert sum(h for *_, h in got) == least(0)


def test_cut_looks_ahead():
    got, forced = pieces.cut(0, 97_000, [(13_801, 16_201), (29_481, 29_694), (59_646, 60_542), (80_000, 80_100)], 30_000, 1000)
    assert not forced and not any(h for *_, h in got)


def test_pieces_of_rows(spark):
    nan = float("nan")
    rows = [(1, "a", 0.0, 70.0, None, None, None), (2, "a", 0.0, 30.0, None, None, None), (3, "a", 5.0, None, None, None, None), (4, "a", 5.0, nan, None, None, None), (5, "a", 50.0, 5.0, None, None, None), (6, None, 0.0, 99.0, None, None, None), (None, "a", 0.0, 99.0, None, None, None)]
    br = spark.createDataFrame([("a", 25.0, 26.0), ("a", 25.0, 26.0), ("a", 50.0, None), ("a", 52.0, 53.0), ("a", 69.0, 71.0), (None, 1.0, 2.0), ("b", 10.0, 11.0)], "sid string, lo double, hi double")
    df = clashing(seg_rows(spark, rows + rows[:1]))
    got = sorted((r.seg_id, r.piece, r.start_ms, r.end_ms, r.hard_cut, r.forced_cut) for r in pieces.cut_pieces(df, br, 30_000, 1000).collect())
    assert [g for g in got if g[0] == 1] == [(1, 0, 0, 26_000, 0, 0), (1, 1, 25_000, 53_000, 0, 0), (1, 2, 52_000, 70_000, 0, 0)]
    assert {g[0]: g[5] for g in got} == {1: 0, 6: 1}
    sure = {r.seg_id: (r.start_ms, r.end_ms, r.within_limit, r.overlaps, r.natural, r.forced_cut) for r in pieces.checked(pieces.cut_pieces(df, br, 30_000, 1000), br, 30_000, 1000).collect()}
    assert sure == {1: (0, 70_000, 1, 1, 1, 0), 6: (0, 99_000, 1, 1, 1, 1)}
    assert pieces.cut_pieces(df.limit(0), br, 30_000, 1000).count() == 0
    with pytest.raises(ValueError):
        pieces.cut_pieces(df, br, 1000, 1000)


# p7


def test_best_fit_is_best_fit():
    rng = random.Random(4)
    sizes = [rng.randrange(0, 101) for _ in range(300)]
    got = packing.best_fit(sizes, 100)
    assert sorted(i for b in got for i in b) == list(range(300)) and all(sum(sizes[i] for i in b) <= 100 for b in got)
    rooms, bins = [], []
    for i in sorted(range(300), key=lambda i: (-sizes[i], i)):
        fit = [(rooms[b] - sizes[i], b) for b in range(len(bins)) if rooms[b] >= sizes[i]]
        b = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([])
            rooms.append(100)
        bins[b].append(i)
        rooms[b] -= sizes[i]
    assert len(got) == len(bins)


def test_pack_whole(spark):
    rng = random.Random(6)
    items = [(i, rng.choice([0, 1, 40, 333, 1000, 1001, 2500])) for i in range(3000)] + [(None, 5), (9999, None)]
    df = clashing(spark.createDataFrame(items, "doc_id long, tokens long")).repartition(6)
    got = packing.pack(df, 1000, per_task=100).toPandas()
    by = got.groupby("doc_id").tokens.sum().to_dict()
    assert by == {i: t for i, t in items if i is not None and t is not None}
    fill = got.groupby("container_id").tokens.sum()
    assert fill.max() <= 1000 and (got[got.doc_tokens <= 1000].piece == 0).all()
    assert len(fill) <= 1.03 * sum(by.values()) / 1000 + 1
    assert packing.pack(df.limit(0), 1000).count() == 0


def test_items_that_never_go_together(spark):
    # six tenths of a container each: no round can join two, and no task grows beyond its width
    df = spark.createDataFrame([(i, 600) for i in range(2000)], "doc_id long, tokens long").repartition(5)
    got = packing.fill(packing.pack(df, 1000, per_task=50), 1000).toPandas()
    assert len(got) == 2000 and (got.n_items == 1).all() and (got.fill == 0.6).all() and (got.room == 400).all()
    mixed = spark.createDataFrame([(i, 600 if i % 2 else 390) for i in range(2000)], "doc_id long, tokens long").repartition(5)
    got = packing.fill(packing.pack(mixed, 1000, per_task=200), 1000).toPandas()
    assert got["size"].sum() == 1000 * 990 and len(got) <= 1060


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "字" * 5000), (5, "a" * 20_000)], "doc_id long, text string")
    n = {r.doc_id: r.tokens for r in tokens.token_counts(df, ["doc_id"]).collect()}
    assert n[1] == len(tokens.encoding(tokens.VOCABULARY).encode_ordinary("hello world")) and n[2] == n[3] == 0 and n[4] >= 2500 and n[5] > 100


# p8


def test_budgets():
    L = lambda path, share, most: mixing.Leaf(tuple(path.split("/")), share, most)
    x = [L("d/en/a", 0.25, 10), L("d/en/b", 0.25, 1000), L("d/fr/c", 0.5, 1000)]
    mixing.budgets(x, 100)
    assert [round(v.budget) for v in x] == [10, 40, 50]
    x = [L("d/en/a", 0.25, 10), L("d/en/b", 0.25, 30), L("d/fr/c", 0.5, 1000)]
    mixing.budgets(x, 100)
    assert [round(v.budget) for v in x] == [10, 30, 60]
    x = [L("d/en/a", 0.5, 10), L("d/fr/c", 0.5, 10)]
    mixing.budgets(x, 100)
    assert [round(v.budget) for v in x] == [10, 10]
    mixing.budgets([], 100)


def test_mixture(spark):
    rng = random.Random(8)
    docs = [(i, rng.choice(["big"] * 8 + ["mid", "tiny"]), "en", rng.randrange(1, 50)) for i in range(2000)] + [(5000, None, "en", 10), (None, "big", "en", 3), (5001, "other", None, 7)]
    sized = clashing(spark.createDataFrame(docs, "doc_id long, source string, language string, tokens long").withColumn("domain", F.when(F.col("source") != "mid", "long"))).drop("size")
    targets = spark.createDataFrame([("big", 0.3, 4), ("mid", 0.3, 4), ("tiny", 0.3, 1), ("none", 0.1, 3), (None, 0.0, 1)], "source string, target_share double, max_repeats int")
    planned = mixing.plan(sized, targets)
    got = mixing.select(spark, sized, planned).toPandas()
    rep = mixing.report(spark, mixing.select(spark, sized, planned), planned).toPandas().set_index("source")
    total = sum(d[3] for d in docs)
    assert {p[0]: p[1:3] for p in planned} == {"big": ("long", "en"), "mid": ("none", "en"), "tiny": ("long", "en"), "none": ("none", "und")}
    for s, budget in ((p[0], p[6]) for p in planned):
        own = got[got.source == s]
        used = (own.tokens * own.times).sum()
        assert budget - 50 <= used <= budget + 1e-6 and (own.times <= rep.max_repeats[s]).all()
        assert rep.used[s] == used
    assert bool(rep.short["tiny"]) and bool(rep.short["none"]) and not bool(rep.short["big"])
    assert rep.actual_share.sum() == pytest.approx(1) and rep.used.sum() <= total
    again = mixing.select(spark, sized.repartition(3), planned).toPandas()
    assert set(zip(got.doc_id, got.times)) == set(zip(again.doc_id, again.times))
    empty = mixing.plan(sized.limit(0), targets)
    assert mixing.select(spark, sized.limit(0), empty).count() == 0 and mixing.report(spark, mixing.select(spark, sized.limit(0), empty), empty).count() == 4


# p9


@pytest.mark.parametrize(
    "text,want",
    [
        (None, []), ("", []), (" \n ", []), ("[S1]", []), ("One.", ["One."]),
        ("Dr. Lee saw it. They left!", ["Dr. Lee saw it.", "They left!"]), ("At 8 p.m. we left. At 9 p.m. The end?!", ["At 8 p.m. we left.", "At 9 p.m.", "The end?!"]),
        ("Version 3.4.1 costs 5.20 euros. J. R. Lee and J.-P. Roy paid, e.g. twice, etc. And more.", ["Version 3.4.1 costs 5.20 euros.", "J. R. Lee and J.-P. Roy paid, e.g. twice, etc.", "And more."]),
        ("“Is it there? We hope so!” said Mr. Lee. Ann asked, \"Who?\" They left.", ["“Is it there? We hope so!” said Mr. Lee.", "Ann asked, \"Who?\"", "They left."]),
        ("Well... the boat left. It was far… Then it came.", ["Well... the boat left.", "It was far…", "Then it came."]), ("a b.\n[S1] c. [S2] d", ["a b.", "[S1] c.", "[S2] d"]),
        ("Er rief: „Wer kam?“. Am 9. März ging er, z. B. nach Bonn usw. Und dann.", ["Er rief: „Wer kam?“.", "Am 9. März ging er, z. B. nach Bonn usw.", "Und dann."]),
        ("« Où sont-ils ? Je ne sais pas ! » disait Mme Roy. Env. 3 personnes.", ["« Où sont-ils ? Je ne sais pas ! » disait Mme Roy.", "Env. 3 personnes."]),
        ("Жители ул. Лесной, д. 3, и т. д. Они ушли.Потом «Где? Там!» — сказал он.", ["Жители ул. Лесной, д. 3, и т. д.", "Они ушли.", "Потом «Где? Там!» — сказал он."]),
        ("他说：“在哪里？我不知道！”，然后走了。老师问：“谁来了？”我们走了。这个……好像是3.5度。", ["他说：“在哪里？我不知道！”，然后走了。", "老师问：“谁来了？”", "我们走了。", "这个……好像是3.5度。"]),
        ("彼は「どこですか。知りません！」と言った。この橋は……たぶん森です！", ["彼は「どこですか。知りません！」と言った。", "この橋は……たぶん森です！"]),
        ("그 배...이라는 말에 “몰라요!”라고 했어요. 그래서 갔어요?", ["그 배...이라는 말에 “몰라요!”라고 했어요.", "그래서 갔어요?"]),
        ("[S1] เราเดิน 10.3 กิโลเมตรแล้ว เขาถามว่า“อยู่ที่ไหน”แล้วไป รุ่น 5 ดี", ["[S1] เราเดิน 10.3 กิโลเมตรแล้ว", "เขาถามว่า“อยู่ที่ไหน”แล้วไป", "รุ่น 5 ดี"]),
        ("उसने कहा “कहाँ है? पता नहीं!” और गया। डॉ. राम आए।", ["उसने कहा “कहाँ है? पता नहीं!” और गया।", "डॉ. राम आए।"]),
        ("they left. the boat, p. [Cough] ej. one, came? yes [Sigh] it did.", ["they left.", "the boat, p. [Cough] ej. one, came?", "yes [Sigh] it did."]),
    ],
)
def test_sentences(text, want):
    spans = sentences.sentence_spans(text)
    assert [text[s:e] for s, e in spans] == want
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_sentences_of_rows(spark):
    rows = [(1, "ab cd. Ef gh."), (2, "ab cd. Ef gh."), (3, None), (4, ""), (None, "X."), (5, "Long one. " * 20_000)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sentences.sentences(df, with_text=True).toPandas()
    assert got.groupby("doc_id").size().to_dict() == {1: 2, 2: 2, 5: 20_000}
    assert (got.end_char - got.start_char == got.sentence.str.len()).all()
    assert sentences.sentences(df.limit(0)).count() == sentences.sentences(df.where("text = ''"), with_text=True).count() == 0


def test_lattice_prefers_words():
    costs = {"我们": 2.0, "我": 3.0, "们": 5.0, "天气": 3.0}
    assert sentences.lattice_words("我们天气好", costs) == ["我们", "天气", "好"]
    assert sentences.lattice_words("", costs) == []


def test_lattice_as_every_cut():
    from itertools import product

    rng = random.Random(8)
    costs = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))): rng.uniform(1, 6) for _ in range(8)}
    for _ in range(60):
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        price = lambda ws: sum(costs.get(w, 12.0 if len(w) == 1 else 1e9) if len(w) > 1 else min(costs.get(w, 12.0), 12.0) for w in ws)
        cuts = []
        for mask in product([0, 1], repeat=len(t) - 1):
            ws, at = [], 0
            for i, m in enumerate(mask, 1):
                if m:
                    ws.append(t[at:i])
                    at = i
            cuts.append(price([*ws, t[at:]]))
        assert price(sentences.lattice_words(t, costs)) == pytest.approx(min(cuts))


def test_fitted_dictionary_decides():
    # without the word the lattice takes its first character for a particle that carries on
    texts = ["彼はとても元気です。", "今日、とても暑い。", "犬もとても好きだ。", "海がとても青い。", "母は「はい」と答えた。", "私は彼と話した。", "犬と猫がいる。", "父と行く。", "これはとても良い。", "それもとても安い。"] * 4
    fitted = sentences.Lexicon.fit(texts)
    assert "とても" in fitted.costs["ja"]
    text = "彼は「行く。」とても静かだった。"
    assert len(sentences.sentence_spans(text, fitted)) == 2 and len(sentences.sentence_spans(text)) == 1
    assert len(sentences.sentence_spans("彼は「行く。」と言った。", fitted)) == 1
    import pickle

    again = pickle.loads(pickle.dumps(fitted))
    assert again.costs == fitted.costs and len(sentences.sentence_spans(text, again)) == 2
    assert sentences.Lexicon.fit([]).costs == sentences.BUILT_IN.costs


def test_fit_lexicon_of_rows(spark):
    rows = [(1, "彼はとても元気です。"), (2, None), (3, "plain words only"), (4, "")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "です" in sentences.fit_lexicon(df).costs["ja"]
    assert sentences.fit_lexicon(df.where("false")).costs == sentences.BUILT_IN.costs


def spaceless_texts(n):
    rng = random.Random(5)
    words = {"ja": ["とても", "静か", "だった", "です", "彼は", "海が", "青い", "犬", "猫", "と", "行く"], "zh": ["今天", "天气", "很好", "我们", "去", "公园", "然后", "回家"], "th": ["วันนี้", "อากาศ", "ดี", "มาก", "เรา", "ไป"]}
    out = []
    for k in range(n):
        g = rng.choice(["ja", "zh", "th", "ja", "zh", "th", "en"])
        part = lambda: "".join(rng.choice(words[g]) for _ in range(rng.randrange(1, 6)))  # noqa: E731, B023
        out.append("plain words only." if g == "en" else rng.choice(["", "\0", "A", "「", "々"]) + part() + rng.choice("。、 」\n") + part() + rng.choice(["", "。", "!", "x"]))
    return out


def test_dictionary_of_all_documents(spark, monkeypatch):
    # more rows than any sample held, with repeated ids and texts, rows without an id and several chunks of each script
    texts = spaceless_texts(5000)
    rows = [(None if k % 50 == 0 else k // 2, t) for k, t in enumerate(texts)] + [(7, None), (8, "")]
    monkeypatch.setattr(sentences, "CHUNK", 2000)
    got = sentences.fit_lexicon(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).costs
    assert got == sentences.Lexicon.fit(texts).costs and "とても" in got["ja"] and "今天" in got["zh"] and "อากาศ" in got["th"]


def test_rare_words_of_all_documents_decide(spark, tmp_path):
    seen = ["彼はとても元気です。", "今日、とても暑い。", "犬もとても好きだ。", "海がとても青い。", "これはとても良い。", "父と行く。", "犬と猫がいる。"] * 2
    asked = ["彼は「行く。」とても静かだった。", "彼は「行く。」と言った。", '他说"好。"然后走了。', "เขาพูดว่า “ไป!”แล้วกลับบ้าน", "He said “go.” Then he left.", None, " "]
    texts = ["plain words only"] * 12000 + seen + asked
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    fitted = sentences.Lexicon.fit([t for t in texts if t])
    want = sorted((i, s, e) for i, t in enumerate(texts) for s, e in sentences.sentence_spans(t, fitted))
    got = sorted(map(tuple, queries.p9_found(spark, str(tmp_path)).collect()))
    assert got == want and sum(i == 12000 + len(seen) for i, _, _ in got) == 2


def test_counts_along_shared_beginnings(monkeypatch):
    rng = random.Random(6)
    runs = sorted({("".join(rng.choice("一二三") for _ in range(rng.randrange(1, 9))), rng.choice(["", "a", "b"]), rng.choice(["", "c"]), rng.randrange(1, 4)) for _ in range(200)})
    longest, count, sides = 4, defaultdict(int), defaultdict(lambda: (set(), set()))
    for run, before, after, n in runs:
        for i in range(len(run)):
            for j in range(i + 1, min(len(run), i + longest) + 1):
                count[run[i:j]] += n
                sides[run[i:j]][0].add(run[i - 1] if i else before)
                sides[run[i:j]][1].add(run[j] if j < len(run) else after)
    for rows in (30, 10_000):
        monkeypatch.setattr(sentences, "_ROWS", rows)
        found, near = defaultdict(int), defaultdict(lambda: (set(), set()))
        for part in sentences._strings(runs, longest):
            for w, n, left, right in part:
                found[w] += n
                near[w][0].update(left)
                near[w][1].update(right)
        assert found == count
        assert all(min(len(x), 3) <= len(near[w][k]) <= len(x) for w, both in sides.items() if len(w) > 1 for k, x in enumerate(both))
    costs = {w: rng.uniform(1, 6) for w in rng.sample(sorted(count), 20)}
    want = defaultdict(int)
    for run, _, _, n in runs:
        for w in sentences.lattice_words(run, costs, longest):
            want[w] += n
    assert sentences._path_words([(run, n) for run, _, _, n in runs], costs, longest) == want


# the checks that registered queries run on results


def test_checks_see_what_is_wrong(spark):
    placed = spark.createDataFrame([("a", "a", "train"), ("b", "a", "test"), ("c", "c", "train"), ("d", "d", "other")], "id string, group_id string, split string")
    assert {r.id: r.together for r in groups.checked(placed).collect()} == {"a": 0, "b": 0, "c": 1, "d": 0}
    rows = [("x", 1, 0, 60, 60), ("x", 2, 0, 50, 50), ("y", 3, 0, 100, 130), ("z", 3, 1, 30, 130), ("w", 4, 0, 10, 20), ("w", 5, 0, 5, 10), ("v", 5, 1, 5, 10)]
    packed = spark.createDataFrame(rows, "container_id string, doc_id long, piece int, tokens long, doc_tokens long")
    got = {r.doc_id: (r.within, r.complete) for r in packing.checked(packed, 100).collect()}
    assert got == {1: (0, 1), 2: (0, 1), 3: (1, 1), 4: (1, 0), 5: (1, 0)}
    docs = spark.createDataFrame([(1, "One. Two."), (2, "One. Two."), (3, "One. Two."), (4, "[S1]"), (5, None)], "doc_id long, text string")
    spans = spark.createDataFrame([(1, 0, 4), (1, 5, 9), (2, 0, 4), (3, 0, 5), (3, 4, 9)], "doc_id long, start_char int, end_char int")
    got = {r.doc_id: (r.within, r.trimmed, r.covered) for r in sentences.checked(spans, docs).collect()}
    assert got == {1: (1, 1, 1), 2: (1, 1, 0), 3: (0, 0, 1)}
    planned = [("a", "d", "en", 100, 0.5, 2, 150.0, False), ("b", "d", "en", 10, 0.5, 1, 10.0, True)]
    chosen = spark.createDataFrame([(1, "a", 50, 2), (2, "a", 50, 1), (3, "b", 10, 2)], "doc_id long, source string, tokens long, times long")
    got = {r.source: (r.within_repeats, r.within_budget, r.met) for r in mixing.checked(spark, chosen, planned).collect()}
    assert got == {"a": (1, 1, 1), "b": (0, 0, 1)}
