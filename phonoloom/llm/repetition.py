"""P2: repetition inside a single text.

Every text gets a vector of statistics. Per (language, source) the minimum-covariance-determinant
estimate of location and scatter is found, and vectors beyond its Mahalanobis cutoff on the
repetitive side are rejected; the exact share is then checked among the rejected only. The estimate
works on a sketch of all rows: vectors fall into the cells of a fixed grid, each with its number,
sums and products, so that a group of any size is a table of bounded size with exact moments.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import settle
from .labels import label_code

WORDS, CHARS = 8, 20
CHI2_3 = 9.348  # 0.975 quantile, three dimensions
MIN_GROUP = 50
GRID = 32  # cells per unit of each statistic
RIDGE = 0.03  # added spread of each statistic: half of a clean group is often constant
# what clean text looks like where no group of enough clean texts tells: location, and spread of each statistic
PRIOR, PRIOR_SPREAD = (0.0, 0.1, 0.9), 0.15
_WORD = re.compile(r"[^\W_]+(?:[̀-ͯऀ-ःऺ-ॏ॑-ॗ]+[^\W_]*)*")
_SPACELESS = re.compile("[฀-๿぀-ヿ㐀-䶿一-鿿豈-﫿]")


def units(text: str) -> tuple[list[str], bool]:
    """The units of a text in lower case, and whether they are characters: so where most letters are Chinese, Japanese or Thai."""
    low = text.lower()
    if len(_SPACELESS.findall(low)) * 2 > len(low) - low.count(" "):
        return [c for c in low if c.isalnum()], True
    return _WORD.findall(low), False


def _covered(keys: np.ndarray, doc: np.ndarray, weight: np.ndarray, n: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document the weight of units lying in a run of n units that began before; one run length per document."""
    out = np.zeros(n_docs)
    for size in np.unique(n):
        pick = (n == size)[doc]
        d, k = doc[pick], keys[pick]
        if len(d) <= size:
            continue
        grams = np.zeros(len(k) - size + 1, np.uint64)
        for i in range(size):
            grams = grams * np.uint64(0x100000001B3) + (k[i : len(k) - size + 1 + i] ^ np.uint64(0x9E3779B97F4A7C15))
        whole = np.flatnonzero(d[: len(grams)] == d[size - 1 :])
        mixed = grams[whole] * np.uint64(0xBF58476D1CE4E5B9) + d[whole].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        _, first, inverse = np.unique(mixed, return_index=True, return_inverse=True)
        again = whole[first[inverse] != np.arange(len(whole))]
        if len(again):
            step = np.zeros(len(d) + 1, np.int64)
            np.add.at(step, again, 1)
            np.add.at(step, again + size, -1)
            hit = np.cumsum(step)[:-1] > 0
            out += np.bincount(d[hit], weight[pick][hit], minlength=n_docs)
    return out


def shares(texts: list[str | None], words: int = WORDS, chars: int = CHARS) -> np.ndarray:
    """Rows (share, share at half the run length, distinct ratio) per text; null, blank and wordless texts give (0, 0, 1).

    The first is exact: letters and digits in a run of ``words`` words (``chars`` letters or digits in
    Chinese, Japanese and Thai) that already began earlier in the text, over all letters and digits.
    """
    split = [units(t) if t else ([], False) for t in texts]
    flat = [u for us, _ in split for u in us]
    lens = np.array([len(us) for us, _ in split], np.int64)
    if not flat:
        return np.tile([0.0, 0.0, 1.0], (len(texts), 1))
    keys = np.fromiter((hash(u) & 0xFFFFFFFFFFFFFFFF for u in flat), np.uint64, len(flat))
    weight = np.fromiter(map(len, flat), np.float64, len(flat))
    doc = np.repeat(np.arange(len(texts)), lens)
    total = np.maximum(np.bincount(doc, weight, minlength=len(texts)), 1)
    by_char = np.array([c for _, c in split])
    long = _covered(keys, doc, weight, np.where(by_char, chars, words), len(texts)) / total
    short = _covered(keys, doc, weight, np.where(by_char, chars // 2, words // 2), len(texts)) / total
    pair = np.unique(keys * np.uint64(0x9E3779B97F4A7C15) + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), return_index=True)[1]
    distinct = np.bincount(doc[pair], minlength=len(texts))
    ratio = np.where(lens > 1, np.log1p(distinct) / np.log1p(np.maximum(lens, 1)), 1.0)
    return np.column_stack([long, short, ratio])


def statistics(texts: DataFrame) -> DataFrame:
    """From (tbl, row_key, text, label, source): tbl, row_key, lang, source, share and the transformed vector v1..v3, each key once."""
    schema = "tbl string, row_key string, lang string, source string, share double, v1 double, v2 double, v3 double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            size = whole["text"].str.len().fillna(0).cumsum()
            for _, b in whole.groupby((size // 2_000_000).astype(int), sort=False):  # bounds the arrays, not the texts
                s = shares(b["text"].tolist())
                yield pd.DataFrame({
                    "tbl": b["tbl"], "row_key": b["row_key"], "lang": [label_code(x) or "und" for x in b["label"]], "source": b["source"].fillna("none"),
                    "share": s[:, 0], "v1": np.arcsin(np.sqrt(np.clip(s[:, 0], 0, 1))), "v2": np.arcsin(np.sqrt(np.clip(s[:, 1], 0, 1))), "v3": s[:, 2],
                })

    return texts.where("row_key is not null and text is not null").mapInPandas(run, schema).dropDuplicates(["tbl", "row_key"])


def _chi2_3(x: float) -> float:
    return math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2)


def _chi2_5(x: float) -> float:
    return math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)


def consistency(alpha: float) -> float:
    """Factor that makes the scatter of the ``alpha`` nearest of normal vectors in three dimensions that of all."""
    lo, hi = 0.0, 60.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_3(mid) < alpha else (lo, mid)
    return alpha / _chi2_5(lo) if alpha < 1 else 1.0


def _far(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    d = x - mean
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def mcd(n: np.ndarray, sums: np.ndarray, products: np.ndarray, starts: int = 30, finish: int = 5, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(location, scatter) of the minimum-covariance-determinant estimate of cells with numbers, sums and products of their rows.

    Seeded starts of four drawn cells take two concentration steps each; the best go on until their
    determinant stops falling, and the least determinant is kept. A step takes the half of the rows
    nearest to the estimate, of the cell on its border the part needed. Then comes the reweighting:
    moments of all rows within the cutoff. ``RIDGE`` squared stands on every diagonal.
    """
    total, centre, ridge = n.sum(), sums / n[:, None], np.eye(3) * RIDGE**2
    half = min(total, float((int(total) + 4) // 2))

    def moments(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the given part of each cell."""
        w = part @ n
        m = part @ sums / w
        return m, np.tensordot(part, products, 1) / w - np.outer(m, m)

    def step(m: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(_far(centre, m, cov), kind="stable")
        upto = np.cumsum(n[order])
        part = np.zeros(len(n))
        part[order] = np.clip((half - (upto - n[order])) / n[order], 0, 1)
        m, s = moments(part)
        return m, s + ridge

    rng, tried = np.random.default_rng(seed), []
    for _ in range(starts):
        x = centre[rng.choice(len(n), 4, p=n / total)]
        est = x.mean(0), np.cov(x.T, bias=True) + ridge
        for _ in range(2):
            est = step(*est)
        tried.append((np.linalg.slogdet(est[1])[1], est))
    tried.sort(key=lambda t: t[0])
    best = None
    for det, est in tried[:finish]:
        for _ in range(100):
            new = step(*est)
            now = np.linalg.slogdet(new[1])[1]
            if now >= det - 1e-10:
                break
            det, est = now, new
        if best is None or det < best[0]:
            best = det, est
    m, cov = best[1]
    cov = (cov - ridge) * consistency(half / total) + ridge
    near = (_far(centre, m, cov) <= CHI2_3).astype(float)
    if near @ n >= half:
        m, cov = moments(near)
        cov = cov * consistency(0.975) + ridge
    return m, cov


_PAIRS = [(a, b) for a in range(3) for b in range(a, 3)]
_ESTIMATE = [f"c{i}" for i in range(3)] + [f"i{a}{b}" for a, b in _PAIRS]


def _row(m: np.ndarray, cov: np.ndarray) -> list[float]:
    inv = np.linalg.inv(cov)
    return [*map(float, m), *(float(inv[a, b]) for a, b in _PAIRS)]


def _prior() -> tuple[np.ndarray, np.ndarray]:
    return np.array(PRIOR), np.eye(3) * PRIOR_SPREAD**2


def broken(m: np.ndarray, cov: np.ndarray) -> bool:
    """Whether an estimate is made of repetition: more than half of its group is, so its centre or its spread of shares is none of clean text."""
    p = _prior()
    return bool((_far(m[None], *p)[0] > CHI2_3 and m[0] > p[0][0]) or cov[0, 0] > PRIOR_SPREAD**2 + RIDGE**2)


def estimates(stats: DataFrame) -> DataFrame:
    """lang, source, n, ok and the estimate: for every (language, source), for every source (null lang) and for all rows (both null).

    Not ok are groups of fewer than 50 rows and those whose estimate is made of repetition.
    """
    sums = [F.sum(f"v{i + 1}").alias(f"s{i}") for i in range(3)] + [F.sum(F.col(f"v{a + 1}") * F.col(f"v{b + 1}")).alias(f"p{a}{b}") for a, b in _PAIRS]
    cell = [F.floor(F.col(f"v{i + 1}") * GRID).cast("int").alias(f"q{i}") for i in range(3)]
    cells = stats.groupBy("lang", "source", *cell).agg(F.count(F.lit(1)).alias("n"), *sums)
    up = F.explode(F.array(F.struct("lang", "source"), F.struct(F.lit(None).cast("string").alias("lang"), "source"), F.struct(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"))))
    held = ["n", *(f"s{i}" for i in range(3)), *(f"p{a}{b}" for a, b in _PAIRS)]
    levels = cells.withColumn("g", up).groupBy("g.lang", "g.source", "q0", "q1", "q2").agg(*[F.sum(c).alias(c) for c in held])

    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["q0", "q1", "q2"])
        n = b["n"].to_numpy(float)
        ok, est = bool(n.sum() >= MIN_GROUP), _prior()
        if ok:
            products = np.empty((len(b), 3, 3))
            for a, c in _PAIRS:
                products[:, a, c] = products[:, c, a] = b[f"p{a}{c}"]
            est = mcd(n, b[["s0", "s1", "s2"]].to_numpy(float), products)
            ok = not broken(*est)
        return pd.DataFrame([[b["lang"].iloc[0], b["source"].iloc[0], int(n.sum()), ok, *_row(*est)]], columns=["lang", "source", "n", "ok", *_ESTIMATE])

    schema = "lang string, source string, n long, ok boolean, " + ", ".join(f"{c} double" for c in _ESTIMATE)
    return levels.groupBy("lang", "source").applyInPandas(run, schema)


def resolved(found: DataFrame) -> DataFrame:
    """lang, source, grp and the estimate that holds for them: their own, else the source's, else that of all rows, else ``PRIOR``."""
    top = found.where("lang is null and source is null and ok").first()  # one row
    last = F.struct(F.lit("*" if top else "prior").alias("grp"), *[F.lit(float(v)).alias(c) for c, v in zip(_ESTIMATE, [top[c] for c in _ESTIMATE] if top else _row(*_prior()))])
    own, src = found.where("lang is not null"), found.where("lang is null and source is not null and ok")
    src = src.select("source", F.struct(F.concat(F.lit("*|"), "source").alias("grp"), *_ESTIMATE).alias("up"))
    own = own.select("lang", "source", F.when(F.col("ok"), F.struct(F.concat_ws("|", "lang", "source").alias("grp"), *_ESTIMATE)).alias("own"))
    return own.join(src, "source", "left").select("lang", "source", F.coalesce("own", "up", last).alias("e")).select("lang", "source", "e.*")


def outliers(stats: DataFrame, most: int = 20_000) -> DataFrame:
    """``stats`` with grp and d2, only the rejected rows: beyond the cutoff of the estimate that holds for them, and more repetitive than its location.

    A group in which more than half of the texts repeat has no clean half; it takes the source's
    estimate, that the one of all rows, and only where that is broken too ``PRIOR`` holds. Estimates are a
    row per (language, source); they are counted first and broadcast up to ``most``, above it joined plainly.
    """
    stats = settle(stats)  # the vectors are read twice, the texts once
    found = settle(estimates(stats))
    few = found.count() <= most
    known = resolved(found)
    d = [F.col(f"v{i + 1}") - F.col(f"c{i}") for i in range(3)]
    d2 = sum((d[a] * d[b] * F.col(f"i{a}{b}") * (1 if a == b else 2) for a, b in _PAIRS), F.lit(0.0))
    far = stats.join(F.broadcast(known) if few else known, ["lang", "source"]).withColumn("d2", d2)
    return far.where((F.col("d2") > CHI2_3) & (F.col("v1") > F.col("c0"))).select(*stats.columns, "grp", "d2")


def repetitive(stats: DataFrame, least: float = 1 / 3) -> DataFrame:
    """tbl, row_key, share of the rejected rows whose exact share reaches ``least``."""
    return outliers(stats).where(F.col("share") >= least - 1e-12).select("tbl", "row_key", "share")
