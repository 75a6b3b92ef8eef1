"""P1: raw transcript segments into clean speaker turns.

Tokens of a segment are observed as shape classes; a hidden Markov model over the states speaker,
timestamp, annotation, filler and speech is decoded by Viterbi, and turns are assembled from the
labels. The model is fitted here, by counting over a bounded sample of rows labelled by their shape
(``train_rows``, the only bound); every row is decoded.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import settle
from ..operators.ordered import bucket_of, carry_last, millis, runs
from .samples import lowest_hash
from .speakers import ROLES, speaker_key

# signs between words are a state of their own while decoding, and speech in the result
SPEAKER, TIME, NOTE, FILLER, SPEECH, MARK = range(6)
STATES = ("speaker", "timestamp", "annotation", "filler", "speech", "speech")
(TIME_BRACKET, TIME_BARE, NOTE_BRACKET, NUMBER_BRACKET, NAME_BRACKET, NUMBER_LABEL, NAME_LABEL, MUSIC, HESITATION, UNSURE, HINTED_UNSURE, WORD, SIGN) = range(13)
N_OBS, N_STATES = 13, 6

# Hesitation sounds, with doubled letters and more reduced to one.
HESITATIONS = frozenset(
    "uh um er erm hm mm m uhm mhm huh ah oh eh ehm em ahm äh ähm öh öhm hum euh heu ahn hã é hmm ehh ah "
    "э-э э эм хм м гм ем е-е е мгм эээ "
    "嗯 呃 唔 额 えっと えと えーと えーっと うーん うんと あのー あの ええと んー "
    "음 어 에 으음 음음 저기 เอ่อ เอิ่ม อืม อื้ม अं उम्म उम हम्म हम अँ".split()
)
# Those that are also plain words of some language; alone between signs they are hesitation.
ALSO_WORDS = frozenset("um er em hum é e eh m oh ah э е м あの 어 에 저기 額 额 हम".split())
# Spoken-language hints under which a doubtful sound is hesitation even amid words.
HINTED = {"um": "en", "er": "en", "eh": "es", "em": "es", "hum": "fr pt", "어": "ko", "에": "ko", "э": "ru", "м": "ru uk", "е": "uk"}

_TOKEN = re.compile(
    r"""
    (?P<range>\d{1,3}:\d{2}(?::\d{2})?[.,]\d{1,3}\s*-->\s*\d{1,3}:\d{2}(?::\d{2})?[.,]\d{1,3})
  | (?P<bare>(?<![\w:])\d{1,3}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?![\w:]))
  | (?P<bracket>\[[^\[\]]{1,60}\]|\([^()]{1,60}\)|\{[^{}]{1,60}\}|<[^<>]{1,60}>|【[^【】]{1,60}】|（[^（）]{1,60}）|［[^［］]{1,60}］)
  | (?P<star>\*[^*\n]{1,40}\*)
  | (?P<music>[♪♫♬♩]+)
  | (?P<word>[^\W_]+(?:[̀-ͯऀ-ःऺ-ॏ॑-ॗัิ-ฺ็-๎'’\-]+[^\W_]*)*)
  | (?P<sign>\S)
    """,
    re.X,
)
_TIME = re.compile(r"^(?:t\s*=\s*)?\d[\d:.,\s]*\s*(?:s|sec|ms|m|h|min)?$", re.I)
_NUMBERED = re.compile(r"^[^\W\d_]+[ऀ-ॗัิ-ฺ็-๎]*(?:[^\W\d_]|[ऀ-ॗัิ-ฺ็-๎])*[\s_\-#]*\d{1,4}$")
_NAME = re.compile(r"^[^\W\d_a-z][^\W\d_]*(?:[  _]+[^\W\d_a-z][^\W\d_]*){1,3}$")
# a label before the words it introduces: numbered voice or name, perhaps a role, then a colon or a dash
_LABEL = re.compile(
    r"(?P<num>[^\W\d_](?:[^\W\d_]|[ऀ-ॗัิ-ฺ็-๎]){0,15}[ _\-]?\d{1,4})(?:\s*[:：]|\s+[-–—](?=\s|$))"
    r"|(?P<name>[^\W\d_]+(?:[  _]+[^\W\d_]+){1,3})(?:\s*\([a-z\- ]{2,20}\)|\s*\[[a-z\- ]{2,20}\]|\s+-\s+[a-z\-]{2,20})?\s*[:：](?=\s|$)"
)


@lru_cache(maxsize=50_000)
def _sound(word: str) -> int:
    w = unicodedata.normalize("NFC", word).lower().strip("'’-")
    once = re.sub(r"(.)\1+", r"\1", w)
    twice = len(once) < len(w)
    if w in HESITATIONS or once in HESITATIONS:
        return UNSURE if (w in ALSO_WORDS or once in ALSO_WORDS) and not (twice and w != "oo") else HESITATION
    return WORD


def tokens(text: str) -> list[tuple[int, int, int]]:
    """(observation, start, end) of every token of a text."""
    out: list[tuple[int, int, int]] = []
    at, n, opening = 0, len(text), True
    while at < n:
        if opening:
            while at < n and (text[at].isspace() or text[at] in "-–—•>"):
                at += 1
            if at < n and (m := _LABEL.match(text, at)):
                name = m["name"]
                if m["num"] or all(w[:1].isupper() for w in re.split(r"[  _]+", name)):
                    out.append((NUMBER_LABEL if m["num"] else NAME_LABEL, at, m.end()))
                    at = m.end()
                    continue
        m = _TOKEN.search(text, at)
        if not m:
            break
        kind, s, e = m.lastgroup, m.start(), m.end()
        at = e
        if kind in ("range", "bare"):
            o = TIME_BARE
        elif kind == "bracket":
            inner = text[s + 1 : e - 1].strip()
            if _TIME.match(inner):
                o = TIME_BRACKET
            elif text[s] in "[<" and _NUMBERED.match(inner):
                o = NUMBER_BRACKET
            elif text[s] == "[" and _NAME.match(inner):
                o = NAME_BRACKET
            elif inner.lower() in ROLES:
                o = NAME_BRACKET
            else:
                o = NOTE_BRACKET
        elif kind == "star":
            o = NOTE_BRACKET
        elif kind == "music":
            o = MUSIC
        elif kind == "word":
            o = _sound(m[0])
            opening = False if o in (WORD, UNSURE) else opening
        else:
            o = SIGN
        out.append((o, s, e))
    return out


def observed(toks: list[tuple[int, int, int]], text: str, lang: str | None) -> list[int]:
    """Observations of tokens; a doubtful sound in a language where it is usually hesitation has a class of its own."""
    obs = [o for o, _, _ in toks]
    hint = (lang or "").lower()[:2]
    for i, o in enumerate(obs):
        if o == UNSURE and hint and hint in HINTED.get(text[toks[i][1] : toks[i][2]].lower(), "").split():
            obs[i] = HINTED_UNSURE
    return obs


def weak_states(obs: list[int]) -> list[int]:
    """Training labels by shape and neighbours: a label counts as a speaker only before the first word, a doubtful sound
    as hesitation where no word stands beside it."""
    out, opening = [], True
    for i, o in enumerate(obs):
        if o in (TIME_BRACKET, TIME_BARE):
            s = TIME
        elif o in (NOTE_BRACKET, MUSIC):
            s = NOTE
        elif o in (HESITATION, HINTED_UNSURE):
            s = FILLER
        elif o == UNSURE:
            s = SPEECH if WORD in obs[max(0, i - 1) : i + 2] else FILLER
        elif o in (NUMBER_LABEL, NUMBER_BRACKET, NAME_LABEL, NAME_BRACKET) and opening:
            s = SPEAKER
        else:
            s = MARK if o == SIGN else SPEECH
        # signs don't end the opening of a text, nor what was found before them
        opening = opening and s not in (SPEECH, MARK)
        out.append(s)
    return out


class Tagger:
    """Hidden Markov model over token shapes; plain tables, so it pickles into tasks."""

    def __init__(self, start: Counter, step: Counter, emit: Counter):
        def table(counts: Counter, rows: int, cols: int, add: float) -> list[list[float]]:
            return [[math.log((counts[r, c] + add) / (sum(counts[r, k] for k in range(cols)) + add * cols)) for c in range(cols)] for r in range(rows)]

        self.start = table(Counter({(0, c): n for c, n in start.items()}), 1, N_STATES, 0.5)[0]
        self.step, self.emit = table(step, N_STATES, N_STATES, 0.5), table(emit, N_STATES, N_OBS, 0.05)
        self._known: dict[tuple[int, ...], tuple[int, ...]] = {}

    @classmethod
    def fit(cls, sequences: list[list[int]]) -> Tagger:
        """Counts over weakly labelled observation sequences; the built-in lines make every state occur."""
        start, step, emit = Counter(), Counter(), Counter()
        for obs in sequences + _SEED_LINES:
            states = weak_states(obs)
            if states:
                start[states[0]] += 1
            for a, b in zip(states, states[1:]):
                step[a, b] += 1
            for s, o in zip(states, obs):
                emit[s, o] += 1
        return cls(start, step, emit)

    def decode(self, obs: list[int]) -> list[int]:
        """Viterbi path. Runs of plain words and signs are one step, and known shapes are kept."""
        short, back = [], []
        for o in obs:
            if not (short and o == short[-1] and o in (WORD, SIGN)):
                short.append(o)
            back.append(len(short) - 1)
        key = tuple(short)
        path = self._known.get(key)
        if path is None:
            path = self._viterbi(key)
            if len(self._known) < 50_000:
                self._known[key] = path
        return [SPEECH if path[i] == MARK else path[i] for i in back]

    def _viterbi(self, obs: tuple[int, ...]) -> tuple[int, ...]:
        if not obs:
            return ()
        score, links = [self.start[s] + self.emit[s][obs[0]] for s in range(N_STATES)], []
        for o in obs[1:]:
            best = [max(range(N_STATES), key=lambda a, b=b: score[a] + self.step[a][b]) for b in range(N_STATES)]
            score = [score[best[b]] + self.step[best[b]][b] + self.emit[b][o] for b in range(N_STATES)]
            links.append(best)
        path = [max(range(N_STATES), key=score.__getitem__)]
        for best in reversed(links):
            path.append(best[path[-1]])
        return tuple(reversed(path))


_SEED_LINES = [
    [NUMBER_LABEL, WORD, WORD, SIGN], [NAME_LABEL, TIME_BRACKET, WORD, SIGN], [NUMBER_BRACKET, NOTE_BRACKET], [NAME_BRACKET, TIME_BARE, WORD],
    [TIME_BARE, NOTE_BRACKET, WORD], [TIME_BRACKET, HESITATION, SIGN, WORD, NOTE_BRACKET], [MUSIC, MUSIC], [HESITATION, SIGN, HESITATION], [WORD, HESITATION, WORD, TIME_BRACKET],
]


def _named(o: int, raw: str) -> str | None:
    """The speaker a label token names."""
    if o in (NUMBER_LABEL, NUMBER_BRACKET, NAME_BRACKET):
        raw = re.sub(r"\s+[-–—]\s*$|[:：]\s*$", "", raw).strip("[]<>")
    return speaker_key(raw)


def has_words(text: str, toks: list[tuple[int, int, int]], states: list[int]) -> bool:
    """Whether any token tagged as speech holds a letter or digit."""
    return any(st == SPEECH and (o == WORD or any(c.isalnum() for c in text[s:e])) for (o, s, e), st in zip(toks, states))


def opening_speaker(text: str, toks: list[tuple[int, int, int]], states: list[int]) -> str | None:
    """The speaker named first before the first word; labels that name nobody are passed over."""
    for (o, s, e), st in zip(toks, states):
        if st == SPEAKER:
            if who := _named(o, text[s:e]):
                return who
        elif st == SPEECH and o != SIGN:
            break
    return None


def tag(tagger: Tagger, text: str | None, lang: str | None, clean_text: bool = True) -> tuple[str | None, str]:
    """(speaker the text opens with, the words left as speech). Null and blank texts give (None, "").

    Without ``clean_text`` the words are only told from none, as "x" and "".
    """
    if not text or text.isspace():
        return None, ""
    toks = tokens(text)
    states = tagger.decode(observed(toks, text, lang))
    who = opening_speaker(text, toks, states)
    if not clean_text:
        return who, "x" if has_words(text, toks, states) else ""
    keep, cut = [], 0
    for (_, s, e), st in zip(toks, states):
        if st != SPEECH:
            keep.append(text[cut:s])
            cut = e
    keep.append(text[cut:])
    clean = re.sub(r"\s+(?=[,.;!?，、。])", "", " ".join(" ".join(keep).split()))
    return who, clean.strip(" ,、，;；:：-–—") if any(c.isalnum() for c in clean) else ""


def fit_tagger(segments: DataFrame, train_rows: int = 2000) -> Tagger:
    """Fits the model on at most ``train_rows`` texts, those of the lowest hash of their id."""
    rows = lowest_hash(segments.select("text", "language", "seg_id"), F.col("seg_id"), train_rows).where("text is not null").collect()
    return Tagger.fit([observed(tokens(r.text), r.text, r.language) for r in rows])


def tagged_segments(segments: DataFrame, tagger: Tagger, clean_text: bool = True) -> DataFrame:
    """seg_id, sid, ms, end_ms, ``named`` (by label or text), ``words``: one row per input row, redelivered ones included.

    Without ``clean_text`` the words come as "x" where there are any, which turns need no more than.
    """
    schema = "seg_id long, sid string, ms long, end_ms long, named string, words string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [tag(tagger, t, g, clean_text) for t, g in zip(b["text"], b["language"])]
            by_label = [speaker_key(x) for x in b["speaker"]]
            yield pd.DataFrame({"seg_id": b["seg_id"], "sid": b["sid"], "ms": b["ms"], "end_ms": b["end_ms"].astype("Int64"), "named": [a or w for a, (w, _) in zip(by_label, got)], "words": [w for _, w in got]})

    cols = segments.select("seg_id", "sid", millis(F.col("start_s")).alias("ms"), millis(F.col("end_s")).alias("end_ms"), "speaker", "text", "language")
    return cols.where("sid is not null and ms is not null and seg_id is not null").mapInPandas(run, schema)


def speaker_turns(tags: DataFrame, with_times: bool = False, hour_ms: int = 3_600_000, with_text: bool = False) -> DataFrame:
    """Turns of tagged segments: sid, speaker, first_seg, last_seg, n_segments (and start_ms, last_start_ms).

    ``with_text`` adds end_ms, the latest end of a segment that doesn't end before its start (null where
    there is none), and text, the words of its segments in order; ``tags`` must carry the clean text then.

    Redelivered segments count once; a segment nobody is named for takes the speaker of the segment
    before; segments without words are left out, then equal neighbours join. Segments before the first
    known speaker form no turn. Ties of time go by seg_id. Empty input, empty output.
    """
    more = [F.when(F.col("end_ms") >= F.col("ms"), F.col("end_ms")).alias("end_ms"), F.col("words").alias("text")] if with_text else []
    t = tags.select("sid", "ms", "seg_id", "named", (F.length("words") > 0).alias("spoken"), bucket_of(F.col("ms"), hour_ms).alias("hour"), *more)
    # the tagger runs once; the passes over the order read its narrow result
    t = settle(t.repartition("sid", "hour").dropDuplicates(["sid", "hour", "ms", "seg_id"]))
    t = carry_last(t, ["sid"], "hour", ["ms", "seg_id"], "named", "speaker").where("spoken and speaker is not null").drop("named")
    extra = {"top": ["end_ms"], "joined": ["text"]} if with_text else {}
    out = runs(t, ["sid"], "hour", ["ms", "seg_id"], "speaker", ["seg_id", "ms"] if with_times else ["seg_id"], **extra)
    times = [F.col("first_ms").alias("start_ms"), F.col("last_ms").alias("last_start_ms")] if with_times else []
    return out.select("sid", "speaker", F.col("first_seg_id").alias("first_seg"), F.col("last_seg_id").alias("last_seg"), F.col("n_rows").alias("n_segments"), *times, *(["end_ms", "text"] if with_text else []))
