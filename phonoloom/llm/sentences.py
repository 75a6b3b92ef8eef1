"""P9: sentence boundaries across languages and scripts, as code-point offsets.

A text is first cut at line breaks and before turn tags. Inside such a block every final mark, every
quotation closing after a final mark and, in Thai, every space is a candidate. In scripts without
spaces a mark may close a quotation that the sentence contains or goes on after: there the words on
both sides come from the cheapest path through a dictionary word lattice, and the gap is classed by
final particles, opening words and words that carry on. The dictionary is fitted on all texts, as
tables: no task and no driver holds more of it than the words that one chunk of text has. For spaced
scripts the candidates form a terminator lattice: each is scored by what stands before and after it,
and the best path through the lattice is taken, on which no piece is without words.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import settle

# Abbreviations that never end a sentence (titles, units of address, "for example").
NEVER = frozenset(
    "mr mrs ms dr prof sr sra srta dra st jr mme mlle mgr me av avda env ca bzw vs approx cf fig no nr str hr fr tel vol pp ed est dept univ gen "
    "col lt sgt capt rev hon pres gov sen rep e.g i.e z.b d.h u.a o.ä evtl ggf inkl bspw sog vgl dipl ing ex ej p.ej p.ex aprox pág núm apdo dña ud uds exmo exma "
    "ул вул буд пр просп пл пер обл см напр тыс тис млн млрд проф акад им ім св рис г-н г-жа гр стр зв т.е т.к т.н т.зв डॉ प्रो श्री सुश्री".split()
)
# Abbreviations that often stand last, and those of the time of day.
FINAL = frozenset("etc usw usf т.д т.п др ін u.s.w".split())
CLOCK = frozenset("p.m a.m".split())
# Last parts that with the part before make one abbreviation ("т. д.", "p. m.").
PAIRS = {("т", "д"): "т.д", ("т", "п"): "т.п", ("т", "е"): "т.е", ("т", "к"): "т.к", ("т", "н"): "т.н", ("т", "зв"): "т.зв", ("p", "m"): "p.m", ("a", "m"): "a.m", ("z", "b"): "z.b", ("d", "h"): "d.h", ("u", "a"): "u.a", ("p", "ex"): "p.ex", ("p", "ej"): "p.ej", ("par", "ex"): "p.ex"}
# Months after a German ordinal; openers after which an ellipsis only hesitates.
MONTHS = frozenset("januar jänner februar märz april mai juni juli august september oktober november dezember".split())
OPENERS = frozenset(
    "well so oh ah um uh hmm er erm now anyway ну так вот хм э bueno pues vale eh este bon ben bah alors euh hein also tja na ja äh ähm hm genau "
    "bem bom pois é ahn então ладно отже так-от 음 어 글쎄 वैसे अच्छा".split()
)
# Fixed values for the word lattice: what carries on after a closing quotation, final particles, opening words.
CARRY_ON = {
    "ja": "と という といって といった って とか は が を に の も で な だ です よ ね".split(),
    "zh": "的 地 然后 然後 并 並 而 就 便 但 还 還 之后 之後 后 後 时 時 来 來".split(),
    "ko": "라고 이라고 라는 이라는 라며 라면서 고 하고 는 은 이 가 를 을 도 와 과 에 의 로".split(),
    "th": "แล้ว และ ว่า กับ แต่ จึง ก็".split(),
}
FINAL_PARTICLES = {"ja": "です ます でした ました ません ください ね よ か だ た".split(), "zh": "了 吗 嗎 呢 吧 啊 呀 的".split(), "th": "ครับ ค่ะ คะ นะ จ้ะ เลย แล้ว".split()}
OPENING = {
    "ja": "それから それに だから その後 最後に 実は もし 昨日 今朝 ところで 正直に この その あの 彼は 彼女は 私たち 誰も 近所の いつものように".split(),
    "zh": "我们 我 他 她 他们 这个 这些 那个 后来 所以 另外 其实 如果 今天 昨天 最后 顺便 老实说 和平时 没有 在 邻居".split(),
    "th": "เรา ฉัน เขา เธอ พวกเขา แล้ว ถ้า เพราะ ดังนั้น นอกจากนี้ ต่อมา เมื่อ เช้า สุดท้าย ข้าง มี ไม่มี รุ่น เพื่อน จริงๆ อย่างไรก็ตาม เหมือนเดิม".split(),
}
_ENDS = ".!?…。！？．।॥؟"
_CLOSERS = "”»」』)）］】’›"
_PARTNER = {"„": "“”", "“": "”", "«": "»", "「": "」", "『": "』", '"': '"', "‹": "›", "＂": "＂"}
_BLOCK = re.compile(r"[\n\r\x0b\x0c\x85  ]+|(?=\[S\d{1,4}\])")
_SOUND = r"\[(?!S\d)[^\[\]\n]{1,40}\]|【[^【】\n]{1,40}】|（[^（）\n]{1,40}）|\([^()\n]{1,40}\)|<[^<>\n]{1,40}>|\{[^{}\n]{1,40}\}|\*[^*\n]{1,30}\*"
_SCAN = re.compile(rf"(?P<sound>{_SOUND})|(?P<quote>[„“«「『\"‹＂])|(?P<mark>[{re.escape(_ENDS)}]+)|(?P<space>(?<=[฀-๿])[  ]+|[  ]+(?=[฀-๿]))")
_SKIP = re.compile(rf"(?:\s|{_SOUND})*")
_WORD_AFTER = re.compile(r"(?:[^\W_]|[ऀ-ॿ'’\-])*")
_TAG = re.compile(r"(?:\s*\[S\d{1,4}\])+\s*")


def script(c: str) -> str:
    """ja (kana), zh (han), ko, th, hi or "" for spaced alphabets and anything else."""
    if "぀" <= c <= "ヿ":
        return "ja"
    if "㐀" <= c <= "鿿" or c == "々":
        return "zh"
    if "가" <= c <= "힯":
        return "ko"
    if "฀" <= c <= "๿":
        return "th"
    return "hi" if "ऀ" <= c <= "ॿ" else ""


def lattice_words(text: str, costs: dict[str, float], longest: int = 10, unknown: float = 12.0) -> list[str]:
    """Cheapest path through the word lattice of a spaceless stretch: dictionary words at their cost, other characters at ``unknown`` each."""
    n = len(text)
    best, back = [0.0] + [1e9] * n, [0] * (n + 1)
    for i in range(n):
        here = best[i]
        if here + unknown < best[i + 1]:
            best[i + 1], back[i + 1] = here + unknown, i
        for j in range(i + 1, min(n, i + longest) + 1):
            c = costs.get(text[i:j])
            if c is not None and here + c < best[j]:
                best[j], back[j] = here + c, i
    out, j = [], n
    while j:
        out.append(text[back[j] : j])
        j = back[j]
    return out[::-1]


# what the lattices are of: scripts whose words stand without spaces
_RUNS = re.compile(r"(?P<han>[㐀-鿿々぀-ヿー]+)|(?P<th>[฀-๿]+)")
_LONGEST = {"zh": 4, "ja": 6, "th": 10}
_THAI_TAIL, _THAI_LEAD = re.compile("[ะัาำิีึืฺุูๅ็-๎]"), "เแโใไ"


class Lexicon:
    """Word costs of each spaceless script: what carries on, final particles and opening words, and the words of the texts it is fitted on."""

    def __init__(self, words: dict[str, dict[str, float]] | None = None):
        self.costs = {g: dict((words or {}).get(g, {})) for g in ("ja", "zh", "ko", "th")}
        for g, known in self.costs.items():
            for w in {*CARRY_ON.get(g, ()), *FINAL_PARTICLES.get(g, ()), *OPENING.get(g, ())}:
                known.setdefault(w, 8.0)
        self._heads: dict[tuple[str, str], list[str]] = {}

    def __getstate__(self):
        return self.costs

    def __setstate__(self, state):
        self.costs, self._heads = state, {}

    def words(self, text: str, lang: str) -> list[str]:
        """Words of a short stretch; stretches met before are kept."""
        key = (lang, text)
        got = self._heads.get(key)
        if got is None:
            got = lattice_words(text, self.costs[lang])
            if len(self._heads) < 100_000:
                self._heads[key] = got
        return got

    @classmethod
    def fit(cls, texts: list[str], rounds: int = 3, least: int = 4) -> Lexicon:
        """Words of the given texts: strings met ``least`` times or more with varied characters on both sides, with
        their costs by rounds of cutting the texts along the cheapest path and counting the words on it."""
        stretches: dict[str, list[tuple[str, str, str]]] = {"zh": [], "ja": [], "th": []}
        for t in texts:
            kana = script_of_han(t)
            for m in _RUNS.finditer(t):
                s, e = m.span()
                stretches["th" if m["th"] else kana].append((m[0], t[s - 1 : s], t[e : e + 1]))
        return cls({g: _fit_words(held, _LONGEST[g], rounds, least) for g, held in stretches.items() if held})


def script_of_han(text: str) -> str:
    """ja where a text has kana, else zh."""
    return "ja" if re.search("[぀-ヺ]", text) else "zh"


def _whole(w: str) -> bool:
    """Whether a string can be a word: Thai vowels and tone signs hang on the consonant before or after them."""
    return not (_THAI_TAIL.match(w) or w[-1] in _THAI_LEAD)


def _fit_words(held: list[tuple[str, str, str]], longest: int, rounds: int, least: int) -> dict[str, float]:
    count: Counter = Counter()
    left, right = defaultdict(set), defaultdict(set)
    for run, before, after in held:
        for i in range(len(run)):
            for j in range(i + 1, min(len(run), i + longest) + 1):
                count[run[i:j]] += 1
    often = {w for w, n in count.items() if n >= least}
    for run, before, after in held:
        for i in range(len(run)):
            x = run[i - 1] if i else before
            for j in range(i + 1, min(len(run), i + longest) + 1):
                w = run[i:j]
                if w in often:
                    left[w].add(x)
                    right[w].add(run[j] if j < len(run) else after)
    words = {w: count[w] * len(w) ** 2 for w in often if len(w) == 1 or (_whole(w) and min(len(left[w]), len(right[w])) >= 3)}
    for _ in range(rounds):
        total = math.log(sum(words.values()) + 1)
        costs = {w: total - math.log(n) for w, n in words.items()}
        used: Counter = Counter()
        for run, _, _ in held:
            used.update(lattice_words(run, costs, longest))
        words = {w: n for w, n in used.items() if n >= 2}
    total = math.log(sum(words.values()) + 1)
    return {w: total - math.log(n) for w, n in words.items()}


BUILT_IN = Lexicon()
WINDOW = 10  # characters segmented on each side of a gap


def gap_class(before: str, after: str, lang: str, lexicon: Lexicon = BUILT_IN) -> float:
    """Score of a gap between spaceless stretches: above 0 where a sentence may end, below where it carries on.

    Both sides are cut into words; only a whole word counts as what carries on, as an opening word or as a
    final particle, so the first character of a longer word of the dictionary is none.
    """
    head = lexicon.words(after[:WINDOW], lang)
    score = 0.0
    if head and head[0] in CARRY_ON[lang]:
        score -= 2
    if head and head[0] in OPENING.get(lang, ()):
        score += 1
    tail = lexicon.words(before[-WINDOW:].rstrip(_ENDS + _CLOSERS + "“\""), lang)
    if tail and tail[-1] in FINAL_PARTICLES.get(lang, ()):
        score += 0.5
    return score


class _Case:
    """How a text uses case: ``low`` where its sentences begin with small letters, ``caps`` where all is in capitals."""

    _GAP = re.compile(r"(?:(?<=[^\W\d_]{4})[.!?…]|[!?])[\"”»“]?\s+(?=([^\W\d_]))")

    def __init__(self, text: str):
        up = low = 0
        self.caps = text.upper() == text and text.lower() != text
        for m in self._GAP.finditer(text):
            up, low = up + m[1].isupper(), low + m[1].islower()
        if up == low:
            for line in _BLOCK.split(text):
                m = re.search(r"[^\W\d_]", re.sub(_SOUND, " ", _TAG.sub(" ", line)))
                if m:
                    up, low = up + m[0].isupper(), low + m[0].islower()
        self.low = low > up


_SECOND = frozenset(k for _, k in PAIRS)


def _word_before(text: str, start: int, at: int) -> str:
    """The letters, digits, dots, hyphens and apostrophes that end at ``at``."""
    i = at
    while i > start and ((c := text[i - 1]).isalnum() or c in "'’-." or "ऀ" <= c <= "ॿ" or "฀" <= c <= "๿"):
        i -= 1
    return text[i:at]


def _abbreviation(text: str, dot: int, start: int) -> str:
    """The word a full stop at ``dot`` closes, joined with the part before it where both make one abbreviation."""
    w = re.sub(r"^.*[\u3040-\u30ff\u3400-\u9fff]", "", _word_before(text, max(start, dot - 40), dot)) or text[dot - 1 : dot]
    if "." in w and (any(len(x) > 3 for x in w.split(".")[:-1]) or (w.rpartition(".")[2].lower() in NEVER and w.lower() not in NEVER)):  # the sentence before ended without a space
        w = w.rpartition(".")[2]
    key = w.lower().strip("'’-")
    if key not in _SECOND:
        return w
    clean = re.sub(rf"(?:{_SOUND}|\s)+$", "", text[max(start, dot - len(w) - 48) : dot - len(w)])
    prev = re.search(r"([^\W\d_]+)(\.?)$", clean)
    if prev and (prev[2] or key == "ex") and (pair := PAIRS.get((prev[1].lower(), key))):
        return pair
    return w


def _stop_score(text: str, a: int, s: int, e: int, b: int, case: _Case) -> float:
    """Score of a mark run text[s:e] in the block [a, b)."""
    low, run, nxt = case.low, text[s:e], text[e] if e < b else ""
    before = text[s - 1] if s > a else ""
    after_at = _SKIP.match(text, e, b).end()
    after = text[after_at] if after_at < b else ""
    if not after:
        return 3.0
    spaced = after_at > e
    g0, g1 = script(before), script(after)
    if "…" in run or ".." in run:
        if not set(run) <= {"…", "."}:
            return 3.0  # with a mark of its own
        if g0 in ("zh", "ja") or g1 in ("zh", "ja") and not spaced:
            return -3.0
        word = _word_before(text, max(a, s - 40), s).lower()
        if word in OPENERS and (after.islower() or low or case.caps or g0 in ("ko", "hi")):
            return -3.0
        if not spaced:
            return 1.0 if after.isupper() or after in "„“«\"¿¡" else -3.0
        if after in ",;:":
            return -3.0
        return 1.0 if low or not after.islower() else -1.0
    if not set(run) <= {"."}:
        if nxt and nxt in ",;，、；" and set(run) <= set("!?！？"):
            return -2.0
        return 3.0
    # a single full stop
    if before.isdigit() and nxt.isdigit():
        return -5.0
    if nxt and nxt in ",;:)-–'’/%":
        return -3.0
    name = _abbreviation(text, s, a)
    key = name.lower()
    solo = len(key) == 1 and key.isalpha()
    if not spaced:
        if g0 in ("zh", "ja", "th") or g1 in ("zh", "ja", "th"):
            return 2.0 if g0 else -2.0
        if key in FINAL:
            return 2.0 if after.isupper() or after in "[„“«\"¿¡" or low else -2.0
        if key in NEVER or key in CLOCK or (solo and not before.isdigit()):
            return -3.0
        if after.isupper() or after in "[„“«\"¿¡":
            return 2.0
        ahead = _WORD_AFTER.match(text, after_at)[0]
        return 1.0 if low and after.islower() and len(key) > 2 and len(ahead) > 1 and "." not in key else -3.0
    if key in NEVER:
        return -4.0
    if key in CLOCK:
        return 1.0 if after.isupper() and not case.caps else -3.0
    if key in FINAL:
        return 2.0 if low or not after.islower() else -2.0
    if key.isdigit():
        ahead = _WORD_AFTER.match(text, after_at)[0].lower()
        if ahead in MONTHS or not text[a : s - len(name)].strip():
            return -3.0
        return 2.0 if low or not after.islower() else -1.0
    if solo or re.fullmatch(r"(?:[^\W\d_]\.?-?)+", name) and "." in name and all(len(x) <= 1 for x in re.split(r"[.\-]", name)):
        return -3.0 if after.isupper() or not name.isupper() or after.islower() else 1.0
    return 2.0


def _quote_score(text: str, a: int, o: int, e: int, b: int, case: _Case, lexicon: Lexicon) -> float:
    """Score of the end of a quotation text[o:e] whose own last mark is final."""
    after_at = _SKIP.match(text, e, b).end()
    after = text[after_at] if after_at < b else ""
    if not after:
        return 3.0
    if after in ",，、;；:：—–-":
        return -3.0
    spaced, g = after_at > e, script(after)
    if g in ("ja", "zh") or (g in ("ko", "th") and not spaced):
        lang = "ja" if text[o] in "「『" else g
        return 1.0 + gap_class(text[max(a, o) : e], text[after_at : min(b, after_at + WINDOW)], lang, lexicon) if lang != "ko" else -2.0
    if g == "hi":
        return -2.0 if re.match(r"(?:और|फिर|कहकर|कह|तो|ने|यह|वह कहा)\b", text[after_at : after_at + 8]) else 1.0
    if after.islower() or (case.caps and after.isupper()):
        lead = text[a:o].rstrip()
        return 1.0 if (case.low or case.caps) and lead[-1:] in (":", ",", "：", "，") else -2.0
    return 2.0


def sentence_spans(text: str | None, lexicon: Lexicon = BUILT_IN) -> list[tuple[int, int]]:
    """(start, end) of each sentence, end exclusive, white space stripped. Null and blank texts have none."""
    if not text:
        return []
    case, out = _Case(text), []
    edges = [0]
    for m in _BLOCK.finditer(text):
        edges += [m.start(), m.end()]
    edges.append(len(text))
    for a, b in zip(edges[::2], edges[1::2]):
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a == b:
            continue
        head = _TAG.match(text, a, b)
        body = head.end() if head else a
        if body >= b:
            continue  # a turn tag alone
        cands: list[tuple[int, float]] = []
        at = body
        while at < b and (m := _SCAN.search(text, at, b)):
            s, e = m.span()
            kind, at = m.lastgroup, e
            if kind == "quote":
                ends = [k for c in _PARTNER[text[s]] if (k := text.find(c, s + 1, b)) > 0]
                if not ends:
                    continue
                q = min(ends)
                inner = re.sub(rf"(?:\s|{_SOUND})+$", "", text[s + 1 : q])
                at = q + 1
                if inner and inner[-1] in _ENDS:
                    follow = re.match(rf"[{re.escape(_ENDS)}]+", text[at:b])
                    if follow:
                        at += follow.end()
                        cands.append((at, 3.0))
                    else:
                        cands.append((at, _quote_score(text, body, s, at, b, case, lexicon)))
            elif kind == "mark":
                score = _stop_score(text, body, s, e, b, case)
                while e < b and text[e] in _CLOSERS:
                    e += 1
                at = e
                cands.append((e, score))
            elif kind == "space":
                x, y = text[s - 1 : s], text[e : e + 1]
                if not (x.isdigit() or y.isdigit() or x in _ENDS + _CLOSERS + ",，;]" or y in "[(<{“„«,，" or s <= body):
                    cands.append((s, 1.0))  # a space ends a Thai sentence whatever the words beside it
        out += _best_path(text, a, body, b, cands)
    return out


_LETTER_RUN = re.compile(rf"(?:{_SOUND}|[\W_])*+[^\W_]")


def _worded(text: str, s: int, e: int) -> bool:
    """Whether a stretch holds a letter or digit outside bracketed sounds."""
    return _LETTER_RUN.match(text, s, e) is not None


def _best_path(text: str, a: int, body: int, b: int, cands: list[tuple[int, float]]) -> list[tuple[int, int]]:
    """The spans along the best path through the lattice of candidates.

    A path's worth is the sum of its boundaries' scores, and a piece without words makes it worthless.
    Candidates without a word between them exclude each other and all others are independent, so
    the best path takes the highest of each such group, the later at ties, if it is above 0.
    """
    cuts, best = [a], 0.0
    for e, score in cands:
        if score <= 0 or e >= b:
            continue
        if _worded(text, max(cuts[-1], body), e):
            cuts.append(e)
            best = score
        elif len(cuts) > 1 and score >= best:
            cuts[-1], best = e, score
    if len(cuts) > 1 and not _worded(text, cuts[-1], b):
        cuts.pop()
    cuts.append(b)
    spans = []
    for s, e in zip(cuts, cuts[1:]):
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        if s < e:
            spans.append((s, e))
    return spans


CHUNK = 100_000  # characters cut at a time with the words they have
_ROWS = 200_000  # rows that a task holds before it passes them on
_EDGE = "\ud800"  # stands for the edge of a text among the neighbours; no text has it
_SPACELESS = "[\u0e00-\u0e7f\u3005\u3040-\u30ff\u3400-\u9fff]"
_BLANK = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"
# a quotation that may end in a mark, before a spaceless script, a sound perhaps between
_QUOTED = rf"[{re.escape(_ENDS)}\])】）>}}*]{_BLANK}[“”»」』\"›＂]{_BLANK}(?:{_SPACELESS}|[\[【（(<{{*])"


def _stretches(documents: DataFrame) -> DataFrame:
    """chunk, g, run, before, after, n: each distinct spaceless stretch with its neighbours and how often it comes.

    Chunks are neighbours in order, about ``CHUNK`` characters of one script, so that they share words and beginnings."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            met: Counter = Counter()
            for t in batch["text"]:
                kana = script_of_han(t)
                for m in _RUNS.finditer(t):
                    s, e = m.span()
                    met["th" if m["th"] else kana, m[0], t[s - 1 : s], t[e : e + 1]] += 1
            if met:
                yield pd.DataFrame([(*k, n) for k, n in met.items()], columns=["g", "run", "before", "after", "n"])

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, size, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            ids = []
            for g, run in zip(batch["g"], batch["run"]):
                if last not in (None, g) or size > CHUNK:
                    at, size = at + 1, 0
                size, last = size + len(run), g
                ids.append(at)
            yield batch.assign(chunk=ids)[["chunk", "g", "run", "before", "after", "n"]]

    key = ["g", "run", "before", "after"]
    schema = "g string, run string, before string, after string, n long"
    met = documents.select("text").where(F.col("text").rlike(_SPACELESS)).mapInPandas(read, schema).groupBy(*key).agg(F.sum("n").alias("n"))
    return settle(met.repartitionByRange("g", "run").sortWithinPartitions(*key).mapInPandas(number, f"chunk long, {schema}"))


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))


def _strings(rows: list[tuple[str, str, str, int]], longest: int) -> Iterator[list[tuple[str, int, str, str]]]:
    """(string, count, up to three characters before it, up to three after it), in parts, of the stretches (run, before, after, n) in order.

    What stretches share at their beginning is counted once, with the number of all that share it. Strings are counted up
    to one character more than a word may have: a longer string tells what stands beside the shorter two in it."""
    count: dict[str, int] = defaultdict(int)
    sides: dict[str, list[str]] = {}

    def beside(w: str, side: int, c: str) -> None:
        x = sides.get(w)
        if x is None:
            x = sides[w] = ["", ""]
        if len(x[side]) < 3 and c not in x[side]:
            x[side] += c

    def part() -> list[tuple[str, int, str, str]]:
        for w in count:
            if len(w) > 2:
                for part_of, side, c in ((w[:-1], 1, w[-1]), (w[1:], 0, w[0])):
                    x = sides.get(part_of)
                    if x is None:
                        x = sides[part_of] = ["", ""]
                    if len(x[side]) < 3 and c not in x[side]:
                        x[side] += c
        for w in count:
            if len(w) <= longest and w not in sides:
                sides[w] = ["", ""]
        return [(w, count.get(w, 0), *x) for w, x in sides.items() if len(w) == 1 or _whole(w)]

    last, beyond, held = "", "", [0]  # held[j]: stretches that go through the first j characters of ``last``
    for run, before, after, n in [*rows, ("", "", "", 0)]:
        p = _shared(last, run)
        for j in range(len(last), p, -1):  # what ends at j is complete
            m = held.pop()
            held[-1] += m
            for i in range(max(0, j - longest - 1), j):
                count[last[i:j]] += m
            if len(count) > _ROWS:
                yield part()
                count.clear()
                sides.clear()
                beyond = ""
        if not run:
            break
        held += [0] * (len(run) - p)
        held[-1] += n
        before, most = before or _EDGE, min(len(run), longest) + 1
        for j in range(max(2, p + 1) if before == beyond else 2, most):
            beside(run[:j], 0, before)
        for j in range(2, most):
            beside(run[-j:], 1, after or _EDGE)
        last, beyond = run, before
    yield part()


def _path_words(runs: list[tuple[str, int]], costs: dict[str, float], longest: int, unknown: float = 12.0) -> dict[str, int]:
    """How often each word is on the cheapest paths of the stretches (run, n) in order: ``lattice_words`` that goes on from the beginning a stretch shares with the one before."""
    used: dict[str, int] = defaultdict(int)
    best, back, last, get = [0.0], [0], "", costs.get
    held = [0]  # held[j]: stretches whose path has an edge after the first j characters of ``last``
    for run, n in [*runs, ("", 0)]:
        p = _shared(last, run)
        for j in range(len(last), p, -1):
            if m := held.pop():
                used[last[back[j] : j]] += m
                held[back[j]] += m
        del best[p + 1 :], back[p + 1 :]
        for j in range(p + 1, len(run) + 1):
            low, at = 1e9, 0
            for i in range(max(0, j - longest), j - 1):
                c = get(run[i:j])
                if c is not None and best[i] + c < low:
                    low, at = best[i] + c, i
            here = best[j - 1]
            if here + unknown < low:
                low, at = here + unknown, j - 1
            c = get(run[j - 1])
            if c is not None and here + c < low:
                low, at = here + c, j - 1
            best.append(low)
            back.append(at)
        held += [0] * (len(run) - p)
        held[-1] += n
        last = run
    return used


def _totals(words: DataFrame) -> dict[str, float]:
    """Logarithm of the summed counts of each script, from which a word's cost is reckoned."""
    return {r.g: math.log(r.n + 1) for r in words.groupBy("g").agg(F.sum("n").alias("n")).collect()}


def fitted_words(documents: DataFrame, rounds: int = 3, least: int = 4) -> DataFrame:
    """g, w, n: the words of ``Lexicon.fit`` over all texts and how often they are on the paths, as a table.

    Every chunk of stretches is cut with those words of the dictionary that it has as strings, so the
    dictionary may be of any size."""
    texts = _stretches(documents)

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(rows: list[tuple]) -> Iterator[pd.DataFrame]:
            chunk, g = rows[0][:2]
            for part in _strings([r[2:] for r in rows], _LONGEST[g]):
                for k in range(0, len(part), 50_000):
                    w, n, *sides = zip(*part[k : k + 50_000])
                    lefts, rights = ([["" if c == _EDGE else c for c in x] for x in side] for side in sides)
                    yield pd.DataFrame({"chunk": chunk, "g": g, "w": w, "n": n, "lefts": lefts, "rights": rights})

        rows: list[tuple] = []
        for batch in batches:
            for r in batch.itertuples(index=False, name=None):
                if rows and rows[0][0] != r[0]:
                    yield from out(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield from out(rows)

    met = settle(texts.mapInPandas(strings, "chunk long, g string, w string, n long, lefts array<string>, rights array<string>"))
    varied = lambda c: F.size(F.array_distinct(F.flatten(F.collect_set(c))))
    seen = met.groupBy("g", "w").agg(F.sum("n").alias("n"), F.least(varied("lefts"), varied("rights")).alias("sides"))
    size = F.length("w")
    words = settle(seen.where((F.col("n") >= least) & ((size == 1) | (F.col("sides") >= 3))).select("g", "w", (F.col("n") * size * size).alias("n")))
    # a character that is no word yet may become one
    own = met.select("chunk", "g", "w")
    own = settle(own.where(size == 1).unionByName(own.where(size > 1).join(words.select("g", "w"), ["g", "w"], "left_semi").select("chunk", "g", "w")))
    for _ in range(rounds):
        total = _totals(words)

        def cut(runs: pd.DataFrame, priced: pd.DataFrame) -> pd.DataFrame:
            g = runs["g"].iloc[0]
            costs = {w: total[g] - math.log(n) for w, n in zip(priced["w"], priced["n"])}  # noqa: B023 (the round ends with the settled table)
            met: Counter = Counter()
            for run, n in zip(runs["run"], runs["n"]):
                met[run] += n
            used = _path_words(sorted(met.items()), costs, _LONGEST[g])
            return pd.DataFrame({"g": g, "w": list(used), "n": list(used.values())})

        priced = own.join(words, ["g", "w"]).select("chunk", "w", "n")
        cuts = texts.select("chunk", "g", "run", "n").groupBy("chunk").cogroup(priced.groupBy("chunk")).applyInPandas(cut, "g string, w string, n long")
        words = settle(cuts.groupBy("g", "w").agg(F.sum("n").alias("n")).where("n >= 2"))
    return words


def fit_lexicon(documents: DataFrame) -> Lexicon:
    """The dictionary fitted on all documents as one object. ``fitted_sentences`` needs no such object."""
    words = fitted_words(documents)
    total, costs = _totals(words), defaultdict(dict)
    for r in words.toLocalIterator():
        costs[r.g][r.w] = total[r.g] - math.log(r.n)
    return Lexicon(costs)


class _Asked(Lexicon):
    """Notes which stretches are to be cut."""

    def __init__(self):
        super().__init__()
        self.asked: set[tuple[str, str]] = set()

    def words(self, text: str, lang: str) -> list[str]:
        if text.startswith(self._first[lang]) or text.endswith(self._final[lang]):  # else no way to cut it has such a word there
            self.asked.add((lang, text))
        return []

    _first = {g: (*CARRY_ON.get(g, ()), *OPENING.get(g, ())) for g in _LONGEST}
    _final = {g: tuple(FINAL_PARTICLES.get(g, ())) for g in _LONGEST}


def fitted_sentences(documents: DataFrame) -> DataFrame:
    """``sentences`` with the dictionary fitted on all documents.

    Only texts with a quotation before a spaceless script may ask the dictionary; they are cut in chunks, each with the
    words that stand beside its quotations. All others are cut in one pass without a shuffle."""
    docs = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    asks = F.col("text").rlike(_SPACELESS) & F.col("text").rlike(_QUOTED)
    quoted = settle(docs.where(asks))
    chunks = (quoted.agg(F.sum(F.length("text"))).first()[0] or 0) // CHUNK + 1
    quoted = quoted.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    words = fitted_words(documents)
    total = _totals(words)

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            met = set()
            for chunk, part in batch.groupby("chunk"):
                noted = _Asked()
                for t in part["text"]:
                    sentence_spans(t, noted)
                met |= {(chunk, g, t[i:j]) for g, t in noted.asked for i in range(len(t)) for j in range(i + 1, min(len(t), i + _LONGEST[g]) + 1)}
            if met:
                yield pd.DataFrame(list(met), columns=["chunk", "g", "w"])

    def cut(texts: pd.DataFrame, priced: pd.DataFrame) -> pd.DataFrame:
        costs: dict = defaultdict(dict)
        for g, w, n in zip(priced["g"], priced["w"], priced["n"]):
            costs[g][w] = total[g] - math.log(n)
        return _spans(texts, Lexicon(costs))

    priced = quoted.select("chunk", "text").mapInPandas(strings, "chunk long, g string, w string").distinct().join(words, ["g", "w"])
    cuts = quoted.groupBy("chunk").cogroup(priced.groupBy("chunk")).applyInPandas(cut, _SPANS)
    return sentences(docs.where(~asks)).unionByName(cuts)


_SPANS = "doc_id long, start_char int, end_char int"


def _spans(batch: pd.DataFrame, lexicon: Lexicon, with_text: bool = False) -> pd.DataFrame:
    ids, starts, ends, parts = [], [], [], []
    for i, t in zip(batch["doc_id"], batch["text"]):
        for s, e in sentence_spans(t, lexicon):
            ids.append(i)
            starts.append(s)
            ends.append(e)
            if with_text:
                parts.append(t[s:e])
    return pd.DataFrame({"doc_id": ids, "start_char": starts, "end_char": ends} | ({"sentence": parts} if with_text else {}))


def sentences(documents: DataFrame, with_text: bool = False, lexicon: Lexicon = BUILT_IN) -> DataFrame:
    """doc_id, start_char, end_char (and ``sentence``) for whole texts; one pass, no shuffle.

    Equal texts under several ids come out under each id; null and blank texts give no row.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _spans(batch, lexicon, with_text)
            if len(found):
                yield found

    return documents.where("doc_id is not null and text is not null").select("doc_id", "text").mapInPandas(run, _SPANS + ", sentence string" * with_text)


def checked(found: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, within, trimmed, covered: per document with sentences 1 where they lie in the text, have no white space at their ends, and hold all its letters.

    A text of turn tags alone has no sentences and no row."""
    spans = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start_char", "end_char"))).alias("spans"))  # bounded by one text
    d = documents.where("doc_id is not null and text is not null").select("doc_id", "text").join(spans, "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t, ss in zip(b["doc_id"], b["text"], b["spans"]):
                at, ok, trim, lost = 0, 1, 1, []
                for x in ss:
                    s, e = int(x["start_char"]), int(x["end_char"])
                    ok &= int(at <= s < e <= len(t))
                    part = t[s:e]
                    trim &= int(part == part.strip())
                    lost.append(t[at:s])
                    at = e
                lost.append(t[at:])
                rest = _TAG.sub(" ", "\n".join(lost))
                rows.append((i, ok, trim, int(not any(c.isalpha() for c in rest))))
            yield pd.DataFrame(rows, columns=["doc_id", "within", "trimmed", "covered"])

    return d.mapInPandas(run, "doc_id long, within int, trimmed int, covered int")
