"""Document quality from weak labels: expectation-maximisation over labellers, then a hashed linear scorer.

Ten rough labellers look at one property of a text each and vote good, bad or not at all. How often each pattern of
votes occurs over all documents is all that expectation-maximisation needs to estimate each labeller's accuracy in
both classes; it gives every pattern a posterior. These posteriors are the labels of a logistic scorer over hashed
character triples and hashed value ranges of the measured properties, fitted on a bounded sample of documents.
"""

from __future__ import annotations

import operator
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import add_columns, new_key, once, send, ship, text_blocks

LABELLERS = ("symbols", "shouting", "exclaiming", "bars", "stutter", "variety", "repeated_lines", "sentences", "word_length", "letters")
NONE, GOOD, BAD = 0, 1, 2
DIMENSIONS = 1 << 16
_TRIPLES = 40.0  # weight of the mean over character triples against the properties
_LETTER, _UPPER, _SPACE, _MARK, _OTHER = range(5)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def kinds() -> np.ndarray:
    """The kind of each code point: lower letter, upper letter, white space, usual mark or digit, other sign."""
    out = np.full(0x110000, _OTHER, np.uint8)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            out[c] = _UPPER if s.isupper() else _LETTER
        elif s.isspace():
            out[c] = _SPACE
        elif s.isdigit() or s in ".,;:!?'\"()-" or unicodedata.category(s) in ("Mn", "Mc", "Pd", "Pi", "Pf"):
            out[c] = _MARK
    return out


def properties(texts: list[str], kind: np.ndarray) -> np.ndarray:
    """One row a text: the ten measured values, in the order of LABELLERS, and the number of words."""
    out = np.zeros((len(texts), len(LABELLERS) + 1))
    data = kind[np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)]
    size = np.array([len(t) for t in texts])
    of = np.repeat(np.arange(len(texts)) * 5, size)
    n = np.bincount(of + data, minlength=5 * len(texts)).reshape(-1, 5)
    letters, shown = n[:, _LETTER] + n[:, _UPPER], size - n[:, _SPACE]
    out[:, 0] = n[:, _OTHER] / np.maximum(shown, 1)
    out[:, 1] = n[:, _UPPER] / np.maximum(letters, 1)
    out[:, 9] = letters / np.maximum(shown, 1)
    for i, t in enumerate(texts):
        words = t.split()
        k = len(words)
        if not k:
            continue
        lines = [x for x in t.split("\n") if x]
        ends = t.count(".") + t.count("?") + t.count("!")
        out[i, 2] = t.count("!!") / k
        out[i, 3] = t.count("|") / k
        out[i, 4] = sum(map(operator.eq, words, words[1:])) / k
        out[i, 5] = len(set(words)) / k**0.5
        out[i, 6] = 1 - len(set(lines)) / len(lines)
        out[i, 7] = ends / k
        out[i, 8] = shown[i] / k
        out[i, 10] = k
    return out


def votes(p: np.ndarray) -> np.ndarray:
    """Each labeller's vote on each row of properties; a text without words gets none."""
    n = p[:, 10]

    def vote(i: int, bad: np.ndarray, good: np.ndarray) -> None:
        out[:, i] = np.where(n == 0, NONE, np.where(bad, BAD, np.where(good, GOOD, NONE)))

    out = np.zeros((len(p), len(LABELLERS)), np.int64)
    vote(0, p[:, 0] > 0.03, p[:, 0] < 0.01)
    vote(1, p[:, 1] > 0.4, p[:, 1] < 0.15)
    vote(2, p[:, 2] > 0.1, p[:, 2] < 0.01)
    vote(3, p[:, 3] > 0.1, p[:, 3] < 0.01)
    vote(4, (p[:, 4] > 0.1) & ((n >= 12) | (p[:, 4] > 0.3)) & (n >= 5), (p[:, 4] < 0.03) & (n >= 5))
    vote(5, (p[:, 5] < 2.5) & (n >= 20), (p[:, 5] > 4) & (n >= 20))
    vote(6, p[:, 6] > 0.3, p[:, 6] < 0.1)
    vote(7, ((p[:, 7] > 0.6) & (n >= 8)) | ((p[:, 7] < 0.002) & (n >= 100)), (p[:, 7] > 0.02) & (p[:, 7] < 0.4))
    vote(8, (p[:, 8] > 15) | (p[:, 8] < 2), (p[:, 8] > 3) & (p[:, 8] < 10))
    vote(9, (p[:, 9] < 0.75) & ((n >= 20) | (p[:, 9] < 0.5)), p[:, 9] > 0.9)
    return out


@dataclass
class Weak:
    """What expectation-maximisation has found: the share of good texts, and how each labeller votes in each class."""

    good_share: float
    table: np.ndarray  # class (bad, good), labeller, vote: share of its votes

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good."""
        log = np.log(self.table)
        each = [sum(log[c, i][v[:, i]] for i in range(v.shape[1])) for c in (0, 1)]
        odds = each[0] - each[1] + np.log(1 - self.good_share) - np.log(self.good_share)
        return 1 / (1 + np.exp(np.clip(odds, -500, 500)))


def estimate(patterns: np.ndarray, n: np.ndarray, rounds: int = 100) -> Weak:
    """Expectation-maximisation over vote patterns and how many texts have each."""
    good = np.where((patterns == BAD).any(axis=1), 0.1, 0.9)
    weak = Weak(0.5, np.full((2, len(LABELLERS), 3), 1 / 3))
    for _ in range(rounds):
        table = np.empty((2, len(LABELLERS), 3))
        for c, share in ((0, 1 - good), (1, good)):
            for i in range(len(LABELLERS)):
                seen = np.bincount(patterns[:, i], share * n, minlength=3)[1:]
                table[c, i] = [1, *(seen + 0.5) / (seen.sum() + 1)]  # a labeller that does not vote says nothing
        weak = Weak(float(np.clip((good * n).sum() / max(n.sum(), 1), 0.01, 0.99)), table)
        new = weak.posterior(patterns)
        if np.abs(new - good).max(initial=0) < 1e-6:
            break
        good = new
    return weak


def _triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places of the byte triples of all texts, and where each text's begin."""
    raw = [b" " + t.encode("utf-8", "replace") + b"  " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    h = data[:-2] * _M1 + data[1:-1] * _M2 + data[2:] * _M3
    begin = np.cumsum([0, *map(len, raw)])
    return ((h ^ (h >> np.uint64(31))) * _M1 >> np.uint64(48)).astype(np.int32), begin


def _ranges(p: np.ndarray) -> np.ndarray:
    """Hashed places of each property's value range."""
    edge = np.array([0.0005, 0.002, 0.01, 0.02, 0.03, 0.05, 0.1, 0.15, 0.25, 0.4, 0.6, 0.75, 0.9, 1.5, 2.5, 4, 6, 10, 15, 25, 50, 100])
    place = np.searchsorted(edge, p[:, : len(LABELLERS)])
    return ((np.arange(len(LABELLERS)) * 64 + place).astype(np.uint64) * _M2 >> np.uint64(48)).astype(np.int32)


def linear(texts: list[str], p: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The scorer's probability that each text is good; the last weight is the constant."""
    place, begin = _triples(texts)
    w = weights[place]
    total = np.add.reduceat(np.append(w, [0, 0]), begin[:-1]) if texts else np.zeros(0)
    z = weights[-1] + _TRIPLES * total / np.maximum(np.diff(begin), 1) + weights[_ranges(p)].sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(places: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, rounds: int = 250) -> np.ndarray:
    """Logistic regression on soft labels by full-batch Adam; both classes count alike if one is rare."""
    weights, m, v = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    of = np.repeat(np.arange(len(places)), [len(x) for x in places])
    at, x = np.concatenate(places), np.concatenate(values)
    share = np.clip(target.mean(), 0.02, 0.98)
    each = np.where(target > 0.5, 0.5 / share, 0.5 / (1 - share))
    for k in range(1, rounds + 1):
        z = weights[-1] + np.bincount(of, weights[at] * x, minlength=len(target))
        g = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - target) * each / len(target)
        grad = np.append(np.bincount(at, g[of] * x, minlength=DIMENSIONS), g.sum()) + 1e-6 * weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        weights -= 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return weights


@dataclass
class Model:
    weak: Weak
    weights: np.ndarray


def train(docs: DataFrame, fit_docs: int = 6000) -> Model:
    """Labeller accuracies from the votes on all documents; the scorer from about `fit_docs` of them, taken by hash."""
    ship(__name__)

    def patterns(frames):
        kind, found, total = once("quality.kinds", "kinds", kinds), Counter(), 0
        for frame in frames:
            for block in text_blocks(frame, "text"):
                v = votes(properties([t or "" for t in block["text"]], kind))
                found.update(map(tuple, v[(v != NONE).any(axis=1)].tolist()))
                total += len(v)
        yield pd.DataFrame({"pattern": ["".join(map(str, k)) for k in found] + ["all"], "n": [*found.values(), total]})

    seen = docs.select("text").mapInPandas(patterns, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()  # 3^10 rows at most
    total = int(seen.loc[seen["pattern"] == "all", "n"].sum())
    seen = seen[seen["pattern"] != "all"].sort_values("pattern")
    weak = estimate(np.array([[int(c) for c in p] for p in seen["pattern"]], np.int64).reshape(-1, len(LABELLERS)), seen["n"].to_numpy(np.float64))
    sent, key = send(docs.sparkSession, weak), new_key("weak")

    def features(frames):
        kind, weak = once("quality.kinds", "kinds", kinds), once("quality.weak", key, sent)
        for frame in frames:
            texts = [t for t in frame["text"] if t and t.strip()]
            p = properties(texts, kind)
            good = weak.posterior(votes(p)) if texts else []
            place, begin = _triples(texts) if texts else (None, None)
            rows = []
            for i, own in enumerate(_ranges(p)):
                at, n = np.unique(place[begin[i] : begin[i + 1] - 2], return_counts=True)
                x = np.concatenate([_TRIPLES * n / (begin[i + 1] - begin[i]), np.ones(len(own))])
                rows.append((np.concatenate([at, own]).astype(np.int32).tobytes(), x.astype(np.float32).tobytes(), float(good[i])))
            yield pd.DataFrame(rows, columns=["places", "vals", "good"])

    def learn(frames):
        rows = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=["places", "vals", "good"])])
        if len(rows):
            rows = rows.sort_values(["good", "places"])
            w = fit([np.frombuffer(b, np.int32) for b in rows["places"]], [np.frombuffer(b, np.float32) for b in rows["vals"]], rows["good"].to_numpy(float))
        else:
            w = np.zeros(DIMENSIONS + 1)
        yield pd.DataFrame({"weights": [w.astype(np.float32).tobytes()]})

    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality")), F.lit(1 << 40)) / float(1 << 40)
    sample = docs.where(unit < fit_docs / max(total, 1)).select("text").mapInPandas(features, "places binary, vals binary, good double")
    got = sample.repartition(1).mapInPandas(learn, "weights binary").collect()  # one bounded sample, one row of weights
    return Model(weak, np.frombuffer(got[0]["weights"], np.float32).astype(np.float64) if got else np.zeros(DIMENSIONS + 1))


def grade(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add quality (the scorer's probability that a text is good), weak_quality (the labellers' posterior) and keep.

    A null text, or one without words, has quality 0 and is not kept; others are kept from a half on.
    """
    ship(__name__)
    sent, key = send(docs.sparkSession, model), new_key("quality")

    def run(frames):
        kind, model = once("quality.kinds", "kinds", kinds), once("quality.model", key, sent)
        for frame in frames:
            frame = frame.drop(columns=["quality", "weak_quality", "keep"], errors="ignore")
            for block in text_blocks(frame, text):
                texts = [t or "" for t in block[text]]
                p = properties(texts, kind)
                some = p[:, 10] > 0
                score = np.where(some, linear(texts, p, model.weights), 0.0)
                yield block.assign(quality=score, weak_quality=np.where(some, model.weak.posterior(votes(p)), 0.0), keep=score >= 0.5)

    return docs.mapInPandas(run, add_columns(docs, "quality double, weak_quality double, keep boolean"))
