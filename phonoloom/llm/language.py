"""P3: the language of texts, and of each part of a text that mixes languages, by rank-order profiles.

A language profile ranks the n-grams (one to four letters, words padded) of its training texts. A text's
own n-grams are ranked by how often they occur, equal ones alike, and its out-of-place distance to a
profile is the sum over its most frequent n-grams of how far their rank is from the profile's,
n-grams outside the profile being furthest. Texts are cut into stretches of a few words at marks,
line breaks and changes of script, each ranked and measured in the same way. A text in one language
has that of the least distance as a whole; the pair of languages that together explain the
stretches best is chosen where both speak clearly; further languages join a pair by the same
evidence, and the stretches are then parted among the chosen ones.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import LANGUAGES, label_code
from .samples import lowest_hash
from .turns import HESITATIONS

CODES = tuple(LANGUAGES)
DEPTH = 1200  # ranks kept of each profile
PAIRS = np.array(list(combinations(range(len(CODES)), 2)))
STRETCH = 6  # words
ABSENT = 3.0  # stands for a rank no other comes near: 1 out of place
SLICE = 50_000  # words measured at a time
TOP = 400  # ranks compared of a text as a whole
# what is no language of its own: annotations, time marks, opening labels, turn tags
_NOISE = re.compile(
    r"\d+:\d\d(?::\d\d)?[.,]\d+\s*-->\s*\d+:\d\d(?::\d\d)?[.,]\d+|\[[^\[\]]{1,60}\]|\([^()]{1,60}\)|\{[^{}]{1,60}\}|<[^<>]{1,60}>|【[^【】]{1,60}】|（[^（）]{1,60}）|\*[^*\n]{1,40}\*"
    r"|(?:^|(?<=\n))\s*(?:[^\W\d_][^\s:：]{0,14}[ _-]?\d{1,4}(?:\s*[:：]|\s+[-–—]\s)|[^\W\d_a-z][^\W\d_]+ [^\W\d_a-z][^\W\d_]+(?: \([a-z]+\))?[:：] )"
)
_NOISY = re.compile(r"[\[(<{【（*:：>-]")
# one token of a script, or a gap: scripts without spaces fall into short pieces that recur
_TOKENS = re.compile(
    r"([A-Za-zÀ-ÖØ-öø-ɏ]+(?:['’][A-Za-zÀ-ÖØ-öø-ɏ]+)*)|([Ѐ-ԯ]+(?:['’ʼ][Ѐ-ԯ]+)*)|([一-鿿㐀-䶿々]{1,2})|([぀-ヿ]{1,3})|([฀-๿]{1,3})|([가-힯]+)|([ऀ-ॿ]+)|[.!?…。！？।—–\n：:;；，]+"
)
_THAI_SOUNDS = re.compile(r"(?<![\u0e00-\u0e7f])(?:เอ่อ+|เอิ่ม+|อืม+|อื้ม+)(?![\u0e00-\u0e7f])")


def is_sound(word: str) -> bool:
    """Whether a word is a hesitation sound of any language, which is no evidence for one."""
    w = word.lower()
    return w in HESITATIONS or re.sub(r"(.)\1+", r"\1", w) in HESITATIONS


def ngrams(word: str) -> list[str]:
    """N-grams of one to four letters of a word in lower case, padded with one space on each side."""
    w = f" {word.lower()} "
    return [w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1) if n > 1 or w[i] != " "]


class Profiles:
    """Rank tables of all languages, and the n-grams of the words already met."""

    def __init__(self, counts: dict[str, Counter], depth: int = DEPTH):
        self.row: dict[str, int] = {}
        ranks: list[np.ndarray] = []
        for i, code in enumerate(CODES):
            for r, (g, _) in enumerate(sorted(counts.get(code, Counter()).items(), key=lambda x: (-x[1], x[0]))[:depth]):
                at = self.row.setdefault(g, len(self.row))
                if at == len(ranks):
                    ranks.append(np.full(len(CODES), ABSENT, np.float32))
                ranks[at][i] = r / depth
        # the last row is that of n-grams in no profile: furthest out of place
        self.ranks, self.depth = np.array([*ranks, np.full(len(CODES), ABSENT)], np.float32), depth
        self.forget()

    def forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.other: dict[str, int] = {}
        self.flat, self.at = array("q"), array("q", [0])

    def id_of(self, word: str) -> int:
        """Number of a word whose n-grams stand in ``flat[at[i] : at[i + 1]]``; -1 for a hesitation sound."""
        i = self.ids.get(word)
        if i is None:
            if is_sound(word):
                i = self.ids[word] = -1
            else:
                known, base, other = self.row, len(self.row), self.other
                for g in ngrams(word):
                    n = known.get(g)
                    self.flat.append(n if n is not None else base + other.setdefault(g, len(other)))
                i = self.ids[word] = len(self.at) - 1
                self.at.append(len(self.flat))
        return i

    def __getstate__(self):
        return {"row": self.row, "ranks": self.ranks, "depth": self.depth}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.forget()

    def spelled(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of word numbers one after the other, and how many each word has."""
        at = np.frombuffer(self.at, np.int64)
        size = at[words + 1] - at[words]
        pos = np.repeat(at[words] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
        return np.frombuffer(self.flat, np.int64)[pos], size

    def out_of_place(self, item: np.ndarray, gram: np.ndarray, n_items: int, top: int | None = None) -> np.ndarray:
        """``compared`` of the n-grams of all items, one after the other."""
        if not len(item):
            return np.zeros((n_items, len(CODES) + 1))
        # each n-gram of an item once, with the number of times it occurs
        bits = int(gram.max()).bit_length()
        key = (item << bits) | gram
        key.sort()
        new = _starts(key)
        times = np.diff(new, append=len(key))
        key = key[new]
        return self.compared(key >> bits, key & ((1 << bits) - 1), times, n_items, top)

    def of_words(self, words: np.ndarray, item: np.ndarray, n_items: int, top: int | None = None, most: int = SLICE) -> np.ndarray:
        """``out_of_place`` of word numbers with the rising number of the item each stands in, in slices of about ``most`` words.

        Slices hold whole items; one of more words is counted slice by slice over all n-grams met, so a text of any length needs no more room.
        """
        out = np.zeros((n_items, len(CODES) + 1))
        if not len(words):
            return out
        first = _starts(item)
        edge = np.append(first, len(words))
        a = 0
        while a < len(first):
            b = max(a + 1, int(np.searchsorted(edge, edge[a] + most, "right")) - 1)
            lo, hi, i = edge[a], edge[b], item[first[a]]
            if hi - lo <= most:
                gram, size = self.spelled(words[lo:hi])
                n = item[hi - 1] - i + 1
                out[i : i + n] = self.out_of_place(np.repeat(item[lo:hi] - i, size), gram, n, top)
            else:
                count = np.zeros(len(self.row) + len(self.other), np.int64)
                for at in range(lo, hi, most):
                    count += np.bincount(self.spelled(words[at : min(hi, at + most)])[0], minlength=len(count))
                gram = np.flatnonzero(count)
                out[i] = self.compared(np.zeros(len(gram), np.int64), gram, count[gram], 1, top)[0]
            a = b
        return out

    def compared(self, item: np.ndarray, gram: np.ndarray, times: np.ndarray, n_items: int, top: int | None = None) -> np.ndarray:
        """Per item the out-of-place distance to each language and the number of n-grams compared, from each n-gram of an item once, by item.

        An item's n-grams are ranked by how often they occur, equal ones alike; the distance is the sum over them
        of how far the rank is from the profile's, as a part of the profile's depth, and 1 where the profile lacks the
        n-gram. With ``top`` only ranks below it are compared.
        """
        out = np.zeros((n_items, len(CODES) + 1))
        first = _starts(item)
        # those that occur once come behind all others of their item, alike; only the others are sorted
        many = times > 1
        held = np.add.reduceat(many.astype(np.int64), first)
        rank = np.repeat(held, np.diff(np.append(first, len(item))))
        often = np.flatnonzero(many)
        if len(often):
            order = often[np.lexsort((-times[often], item[often]))]
            i, t = item[order], times[order]
            new = np.append(True, (i[1:] != i[:-1]) | (t[1:] != t[:-1]))
            start = np.append(True, i[1:] != i[:-1])
            seat = np.arange(len(order))
            rank[order] = seat[new][np.cumsum(new) - 1] - seat[start][np.cumsum(start) - 1]
        if top is not None:
            use = rank < top
            item, gram, rank = item[use], gram[use], rank[use]
        far = len(self.ranks) - 1
        place = (rank / self.depth).astype(np.float32)[:, None]
        gram = np.minimum(gram, far)
        first = _starts(item) if top is not None else first
        edge = np.append(first, len(item))
        # tables of about 20,000 rows, whole items each
        cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, len(item), 20_000)), len(first)))
        for a, b in zip(cuts, cuts[1:]):
            d = self.ranks.take(gram[edge[a] : edge[b]], axis=0)
            d -= place[edge[a] : edge[b]]
            np.abs(d, out=d)
            np.minimum(d, 1, out=d)
            out[item[first[a:b]], :-1] = np.add.reduceat(d, first[a:b] - edge[a], axis=0)
        out[item[first], -1] = np.diff(edge)
        return out


def _starts(rising: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.empty(len(rising), bool)
    new[:1] = True
    np.not_equal(rising[1:], rising[:-1], out=new[1:])
    return np.flatnonzero(new)


def stretches(text: str, spans: list[list[int]] | None = None) -> tuple[list[str], list[int], list[int]]:
    """Words of a text, the number of the first word of each stretch, and the script of each stretch.

    ``spans`` takes the start and end of each stretch in the text.
    """
    # blanks of equal length, so that offsets stay those of the text
    if _NOISY.search(text):
        text = _NOISE.sub(lambda m: "\n" + " " * (len(m[0]) - 1), text)
    if "อ" in text:
        text = _THAI_SOUNDS.sub(lambda m: " " * len(m[0]), text)
    words, firsts, scripts = [], [], []
    held, most, script, before = 0, 0, 0, ""
    for m in _TOKENS.finditer(text):
        g = m.lastindex
        if g is None:
            script = 0
            continue
        if g == 4:
            g = 3
        if g != script or held == most:
            if spans is not None:
                if scripts:
                    spans[-1][1] = last.end()
                spans.append([m.start(), 0])
            held, script, most = 0, g, STRETCH * (3 if g == 3 or g == 5 else 1)
            scripts.append(g)
            firsts.append(len(words))
        last = m
        w = m[0]
        if w != before:  # else a false start
            before = w
            held += 1
            words.append(w)
    if spans is not None and scripts:
        spans[-1][1] = last.end()
    return words, firsts, scripts


def languages(profiles: Profiles, texts: Iterable[str | None]) -> list[list[tuple[str, float]]]:
    """Per text its languages with a confidence, the stronger of the first two first; [] without words."""
    return [found for found, _ in spoken(profiles, texts)]


def spoken(profiles: Profiles, texts: Iterable[str | None]) -> list[tuple[list[tuple[str, float]], list[tuple[int, int, str, float]]]]:
    """Per text its languages as ``languages`` gives them, and its parts (start, end, language, confidence).

    A part is a run of neighbouring stretches of one language, from its first word to its last; every
    word lies in one. Parts begin and end at stretches, so to within six words without a mark between.
    """
    texts = list(texts)
    out: list[tuple[list, list]] = []
    lo = size = 0
    for hi, t in enumerate(texts):  # bounds the arrays, not the texts
        size += len(t) if isinstance(t, str) else 0
        if size > 400_000 or hi == len(texts) - 1:
            out += _spoken(profiles, texts[lo : hi + 1])
            lo, size = hi + 1, 0
    return out


def _spoken(profiles: Profiles, texts: list[str | None]) -> list[tuple[list, list]]:
    if len(profiles.flat) > 20_000_000:
        profiles.forget()
    ids, firsts, doc, scr, spans, known = [], [], [], [], [], profiles.ids
    for d, t in enumerate(texts):
        if not t or t.isspace():
            continue
        words, first, scripts = stretches(t, spans)
        n = len(ids)
        firsts += [n + k for k in first]
        ids += [known[w] if w in known else profiles.id_of(w) for w in words]
        doc += [d] * len(scripts)
        scr += scripts
    out: list[tuple[list, list]] = [([], []) for _ in texts]
    if not ids:
        return out
    ids, doc, scr, base = np.array(ids), np.array(doc), np.array(scr), len(scr)
    seg = np.repeat(np.arange(base), np.diff([*firsts, len(ids)]))
    real = ids >= 0
    held = np.bincount(seg[real], minlength=base)
    words, item = ids[real], seg[real]
    return _choose(out, profiles, words, item, profiles.of_words(words, item, base), held, doc, scr, spans)


def _choose(out: list, profiles: Profiles, words: np.ndarray, item: np.ndarray, sums: np.ndarray, held: np.ndarray, doc: np.ndarray, scr: np.ndarray, spans: list) -> list:
    k = len(CODES)
    dist, n = sums[:, :k], np.maximum(sums[:, k], 1)
    # a Latin stretch of one or two words beside another script is a name, and no stretch of its own
    latin = scr == 1
    other = np.bincount(doc[~latin], held[~latin], minlength=len(out)) > 0
    solid = held >= np.where(scr == 1, 3, np.where((scr == 3) | (scr == 5), 3, 2))
    use = held > 0
    use &= ~(latin & other[doc] & (held <= 2))
    pos = np.flatnonzero(use)
    if not len(pos):
        return out
    d, dd, nn, sol = doc[pos], dist[pos], n[pos], solid[pos]
    starts = np.flatnonzero(np.diff(d, prepend=-1))
    # the language of a text as a whole: its own ranking against the profiles
    total, weight = np.add.reduceat(dd, starts, axis=0), np.add.reduceat(nn, starts)
    several = np.bincount(d, minlength=len(out)) > 1
    mine = (use & several[doc])[item]
    if mine.any():
        whole = profiles.of_words(words[mine], doc[item[mine]], len(out), top=TOP)[d[starts]]
        more = several[d[starts]]
        total[more], weight[more] = whole[more, :k], np.maximum(whole[more, k], 1)
    best = total.argmin(1)
    ends = np.append(starts[1:], len(pos))
    # texts of several stretches: the pair that explains them best, and what each of the two would gain over the other
    wide = np.flatnonzero(ends - starts > 1)
    pair, maybe = np.zeros(len(starts), np.int64), np.zeros(len(starts), bool)
    if len(wide):
        at = np.flatnonzero(several[d])
        cut = _starts(d[at])
        rows = dd[at].astype(np.float32)
        low = np.empty((len(wide), len(PAIRS)), np.float32)
        for q, (x, y) in enumerate(PAIRS):
            low[:, q] = np.add.reduceat(np.minimum(rows[:, x], rows[:, y]), cut)
        pair[wide] = low.argmin(1)
        number = np.repeat(pair[wide], (ends - starts)[wide])
        edge = dd[at, PAIRS[number, 0]] - dd[at, PAIRS[number, 1]]
        # no run of either can gain more than all its stretches together
        maybe[wide] = np.minimum(np.add.reduceat(np.maximum(edge, 0), cut), np.add.reduceat(np.maximum(-edge, 0), cut)) >= MIX_GAIN
    second = np.partition(total, 1, axis=1)[:, 1]
    sure_of = np.clip((second - total[np.arange(len(best)), best]) / weight * 8, 0, 1).tolist()
    first, last = np.searchsorted(doc, d[starts]).tolist(), np.searchsorted(doc, d[starts], "right").tolist()
    for j, (s, e, t, b, sure, mixed) in enumerate(zip(starts.tolist(), ends.tolist(), d[starts].tolist(), best.tolist(), sure_of, maybe.tolist())):
        found, chosen = [(CODES[b], sure)], [b]
        if mixed:
            x, y = PAIRS[pair[j]]
            edge = dd[s:e, x] - dd[s:e, y]  # above 0: nearer to y
            mine, yours = _part(-edge, nn[s:e], sol[s:e]), _part(edge, nn[s:e], sol[s:e])
            if min(mine[0], yours[0]) > 0:
                a, c = (x, y) if np.minimum(edge, 0).sum() + np.maximum(edge, 0).sum() <= 0 else (y, x)
                found = [(CODES[a], float(np.clip(max(mine[1], yours[1]), 0, 1))), (CODES[c], float(np.clip(min(mine[1], yours[1]), 0, 1)))]
                chosen = _further([a, c], found, dd[s:e], nn[s:e], sol[s:e])
        lo, hi = first[j], last[j]
        if len(chosen) == 1:
            parts = [(spans[lo][0], spans[hi - 1][1], CODES[b], sure)]
        else:
            parts = _parts(chosen, dd[s:e], nn[s:e], pos[s:e], spans, lo, hi)
        out[t] = (found, parts)
    return out


# least evidence for a second language: summed gain of neighbouring stretches, and gain per n-gram
MIX_GAIN, MIX_MEAN = 7.5, 0.055


def _further(chosen: list[int], found: list, dist: np.ndarray, n: np.ndarray, solid: np.ndarray) -> list[int]:
    """Lets further languages join the chosen ones while each of all then speaks clearly somewhere, the best first."""
    while True:
        low, best = dist[:, chosen].min(1), None
        gain = np.clip(low[:, None] - dist, 0, None).sum(0)
        for x in np.flatnonzero(gain >= MIX_GAIN).tolist():
            good, mean = _part(low - dist[:, x], n, solid)
            if good and all(_part(dist[:, [z for z in (*chosen, x) if z != y]].min(1) - dist[:, y], n, solid)[0] for y in chosen):
                if best is None or gain[x] > best[0]:
                    best = (gain[x], x, mean)
        if best is None:
            return chosen
        chosen = [*chosen, best[1]]
        found.append((CODES[best[1]], float(np.clip(best[2], 0, 1))))


def _parts(chosen: list[int], dist: np.ndarray, n: np.ndarray, pos: np.ndarray, spans: list, lo: int, hi: int) -> list[tuple[int, int, str, float]]:
    """Parts of a text in several languages: the cheapest path over its stretches, where a change costs half of MIX_GAIN.

    A run inside another language must so gain MIX_GAIN, as in ``_part``, and every chosen language has a
    part. Stretches without evidence go with the one before, the first ones with the one after.
    """
    cost, links = dist[0, chosen].tolist(), []
    for row in dist[1:, chosen].tolist():
        at = min(range(len(cost)), key=cost.__getitem__)
        turn = cost[at] + MIX_GAIN / 2
        links.append([i if c <= turn else at for i, c in enumerate(cost)])
        cost = [min(c, turn) + r for c, r in zip(cost, row)]
    path = [min(range(len(cost)), key=cost.__getitem__)]
    for back in reversed(links):
        path.append(back[path[-1]])
    path.reverse()
    out, begin = [], 0
    for i in range(1, len(path) + 1):
        if i == len(path) or path[i] != path[begin]:
            own = chosen[path[begin]]
            total = dist[begin:i].sum(0)
            sure = (np.delete(total, own).min() - total[own]) / n[begin:i].sum() * 8
            a = lo if begin == 0 else pos[begin]
            z = hi if i == len(path) else pos[i]
            out.append((spans[a][0], spans[z - 1][1], CODES[own], float(np.clip(sure, 0, 1))))
            begin = i
    return out


def _part(edge: np.ndarray, n: np.ndarray, solid: np.ndarray) -> tuple[int, float]:
    """Whether some run of neighbouring stretches speaks clearly for a language: (number of such runs, best mean edge)."""
    good, mean = 0, 0.0
    total = size = 0.0
    strong = False
    for g, m, ok in zip(edge.tolist() + [-1.0], n.tolist() + [1.0], solid.tolist() + [False]):
        if g > 0:
            total, size, strong = total + g, size + m, strong or ok
        else:
            if strong and total >= MIX_GAIN and total / size >= MIX_MEAN:
                good, mean = good + 1, max(mean, total / size * 4)
            total = size = 0.0
            strong = False
    return good, mean


def fit_profiles(texts: DataFrame, train_rows: int = 6_000) -> Profiles:
    """Profiles from at most ``train_rows`` rows of (key, text, label), those of the lowest key hash, where the label names a language.

    Labels are partly false, so profiles are fitted twice, the second time on the texts that the
    first take for one language, that of their label.
    """
    rows = lowest_hash(texts.select("text", "label", "key"), F.col("key"), train_rows).where("text is not null and label is not null").collect()
    pairs = sorted({(r.text, c) for r in rows if (c := label_code(r.label))})

    def fit(part: list[tuple[str, str]]) -> Profiles:
        counts: dict[str, Counter] = {}
        for t, c in part:
            of = counts.setdefault(c, Counter())
            for w in stretches(t)[0]:
                if not is_sound(w):
                    of.update(ngrams(w))
        return Profiles(counts)

    found = languages(first := fit(pairs), [t for t, _ in pairs])
    clean = [p for p, f in zip(pairs, found) if len(f) == 1 and f[0][0] == p[1]]
    return fit(clean) if clean else first


def identified(texts: DataFrame, profiles: Profiles) -> DataFrame:
    """From (tbl, row_key, text, label): tbl, row_key, label_lang, start_char, end_char, lang, confidence, n_langs; a row per part.

    Null, blank and wordless texts give no row; a text in one language is one part, one that mixes
    languages has a part for each run of stretches of one. Offsets are code points, the end exclusive;
    n_langs counts the text's languages. Repeated rows repeat.
    """
    schema = "tbl string, row_key string, label_lang string, start_char int, end_char int, lang string, confidence double, n_langs int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = spoken(profiles, b["text"])
            rows = [(t, k, label_code(g), *part, len(f)) for t, k, g, (f, parts) in zip(b["tbl"], b["row_key"], b["label"], found) for part in parts]
            if rows:
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return texts.where("row_key is not null and text is not null").mapInPandas(run, schema)


def mislabelled(found: DataFrame) -> DataFrame:
    """tbl, row_key, lang: one-language rows whose label does not mean it, and all languages of mixed rows; each once."""
    return found.where("n_langs > 1 or label_lang is null or label_lang <> lang").select("tbl", "row_key", "lang").distinct()
