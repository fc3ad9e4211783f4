"""Language identification by character language models with interpolated Kneser-Ney smoothing, one for each language.

Letters are lower-cased, everything between words is one space. The highest order has plain counts, the lower ones
continuation counts; for every n-gram that any language has seen, the interpolated log-probabilities of all languages
stand side by side, under the n-gram's hash in one sorted array per order. An unseen n-gram takes the back-off weight
of its context and is looked up one order lower.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import add_columns, new_key, once, send, ship, text_blocks

ORDER = 4
_P = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.uint32(32)
NO_LANGUAGE = "und"


class HashArray:
    """Sorted 64-bit hashes with the place where each prefix of bits begins."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = max(4, int(len(hashes)).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(hashes >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is not there."""
        if not len(self.hashes):
            return np.full(len(wanted), -1, np.int32)
        at = np.minimum(self.begin[wanted >> self.shift], len(self.hashes) - 1)
        got = self.hashes[at]
        on = np.flatnonzero(got < wanted)
        while len(on):
            at[on] = np.minimum(at[on] + 1, len(self.hashes) - 1)
            got[on] = self.hashes[at[on]]
            on = on[(got[on] < wanted[on]) & (at[on] < len(self.hashes) - 1)]
        at[got != wanted] = -1
        return at


def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def characters(texts: list[str], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row (each begins with ORDER - 1 spaces) and where each text begins."""
    lead = " " * (ORDER - 1)
    low = [lead + t.lower() for t in texts]
    data = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in low])])
    letter = is_letter[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each word
    for k in range(ORDER - 1):
        keep[begin[:-1] + k] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    return np.where(letter, data, _SPACE)[keep], upto[begin]


def hashes(data: np.ndarray) -> list[np.ndarray]:
    """Hash of the k-gram that ends at each place, for k = 1 to ORDER (the first places of a text hold no whole one)."""
    out = [_spread(data.astype(np.uint64))]
    for _ in range(ORDER - 1):
        h = out[-1]
        out.append(np.concatenate([h[:1], h[:-1] * _P + out[0][1:]]))
    return out


def _spread(c: np.ndarray) -> np.ndarray:
    c = (c + np.uint64(1)) * _P
    return (c ^ (c >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray]  # by order: sorted hashes
    logs: list[np.ndarray]  # by order: log-probabilities, one column a language
    contexts: list[np.ndarray]  # by order (of the n-gram): sorted hashes of contexts
    weights: list[np.ndarray]  # by order: log of the back-off weights
    unseen: float  # log-probability of an unseen character
    sharpness: float = 10.0
    normal: np.ndarray | None = None  # by language: mean cross-entropy, spread between texts, spread per character
    reach: float = 8.0


def build(counts: pd.DataFrame) -> Model:
    """A model from (lang, gram, n), all ORDER-grams of the training texts; its size is bounded by theirs."""
    languages = sorted(counts["lang"].unique())
    column = {x: i for i, x in enumerate(languages)}
    points = np.frombuffer("".join(counts["gram"]).encode("utf-32-le"), np.uint32).reshape(-1, ORDER).astype(np.uint64)
    lang = counts["lang"].map(column).to_numpy()
    n = counts["n"].to_numpy(np.float64)
    model = Model(languages, [], [], [], [], float(-np.log(len(np.unique(points)) + 1)))
    seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # by falling order: code points, language, count
    for _ in range(ORDER):
        seen.append((points, lang, n))
        rows = np.column_stack([points[:, 1:], lang[:, None].astype(np.uint64)])
        rows, n = np.unique(rows, axis=0, return_counts=True)  # continuation counts: in how many longer ones it ends
        points, lang, n = rows[:, :-1], rows[:, -1].astype(np.int64), n.astype(np.float64)
    lower = None
    for points, lang, n in reversed(seen):
        key, head, tail = _hash_rows(points), _hash_rows(points[:, :-1]), _hash_rows(points[:, 1:])
        grams, first, place = np.unique(key, return_index=True, return_inverse=True)
        contexts, of = np.unique(head, return_inverse=True)
        c, total, kinds, discount = np.zeros((len(grams), len(languages))), np.zeros((len(contexts), len(languages))), np.zeros((len(contexts), len(languages))), np.zeros(len(languages))
        np.add.at(c, (place, lang), n)
        np.add.at(total, (of, lang), n)
        np.add.at(kinds, (of, lang), 1)
        for i in range(len(languages)):
            ones, twos = (n[lang == i] == 1).sum(), (n[lang == i] == 2).sum()
            discount[i] = ones / (ones + 2 * twos) if ones and twos else 0.5
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        context = of[first]
        if lower is None:
            below = np.full(c.shape, np.exp(model.unseen))
        else:
            below = lower[1][np.searchsorted(lower[0], tail[first])]
        share = np.where(total[context] > 0, np.maximum(c - discount, 0) / np.maximum(total[context], 1), 0)
        p = share + weight[context] * below
        lower = (grams, p)
        model.grams.append(grams)
        model.logs.append(np.log(p).astype(np.float32))
        model.contexts.append(contexts)
        model.weights.append(np.log(weight).astype(np.float32))
    return model


def _hash_rows(points: np.ndarray) -> np.ndarray:
    h = np.zeros(len(points), np.uint64)
    for k in range(points.shape[1]):
        h = _spread(points[:, k]) if k == 0 else h * _P + _spread(points[:, k])
    return h


class Scorer:
    def __init__(self, model: Model):
        self.model, self.is_letter = model, letters()
        self.grams = [HashArray(g) for g in model.grams]
        self.contexts = [HashArray(c) for c in model.contexts]

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean negative log-probability of a character under each language, and how many characters count."""
        m = self.model
        data, begin = characters(texts, self.is_letter)
        h = hashes(data)
        at = self.grams[-1].find(h[-1])
        logs = np.zeros((len(data) + 1, len(m.languages)), np.float32)
        logs[:-1] = m.logs[-1][at]
        left = np.flatnonzero(at < 0)
        logs[left] = 0
        for k in range(ORDER - 1, -1, -1):  # `left` has not been seen as a (k + 1)-gram
            if not len(left):
                break
            if k:
                context = self.contexts[k].find(h[k - 1][np.maximum(left - 1, 0)])
                some = context >= 0
                logs[left[some]] += m.weights[k][context[some]]
                at = self.grams[k - 1].find(h[k - 1][left])
                hit = at >= 0
                logs[left[hit]] += m.logs[k - 1][at[hit]]
                left = left[~hit]
            else:
                # a character no language knows: what unigrams leave for the unseen
                logs[left] += m.weights[0][0] + m.unseen
        for k in range(ORDER - 1):
            logs[begin[:-1] + k] = 0  # the spaces put before each text
        size = np.diff(begin) - (ORDER - 1)
        total = np.add.reduceat(logs, begin[:-1], axis=0) if len(texts) else np.zeros((0, len(m.languages)))
        known = np.array([bool(s) for s in size])
        return -total / np.maximum(size, 1)[:, None], np.where(known, size, 0)

    def decide(self, entropy: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the best language (-1: none), its calibrated score, and whether the text is rejected."""
        m = self.model
        best = entropy.argmin(axis=1)
        odds = np.exp(-(entropy - entropy.min(axis=1, keepdims=True)) * m.sharpness)
        score = 1 / odds.sum(axis=1)
        mean, between, each = m.normal[:, best]
        odd = (entropy.min(axis=1) - mean) / np.sqrt(between**2 + each**2 / np.maximum(size, 1)) > m.reach
        none = size == 0
        return np.where(none, -1, best), np.where(none, 0.0, score), none | odd | (score < 0.35)


def held_out() -> Column:
    """Documents that are never learned from: crc32 of the doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, docs_per_language: int = 2000) -> Model | None:
    """Learn from about `docs_per_language` documents of each language (all, where there are fewer), taken by a hash of
    their ids; a fifth of them only calibrates. None if no document has both text and lang."""
    ship(__name__)
    able = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    sizes = {r["lang"]: r["n"] for r in able.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not sizes:
        return None
    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, docs_per_language / n))])
    taken = able.withColumn("unit", unit / share[F.col("lang")]).where("unit < 1")

    def count(frames):
        is_letter = once("language.letters", "letters", letters)
        for frame in frames:
            for lang, part in frame.groupby("lang"):
                for block in text_blocks(part, "text", 1_000_000):
                    data, begin = characters(list(block["text"]), is_letter)
                    ends = np.ones(len(data), bool)
                    for k in range(ORDER - 1):
                        ends[begin[:-1] + k] = False
                    end = np.flatnonzero(ends)
                    key = hashes(data)[-1][end]
                    _, first, n = np.unique(key, return_index=True, return_counts=True)
                    grams = np.stack([data[end[first] - (ORDER - 1 - k)] for k in range(ORDER)], axis=1)
                    text = grams.astype("<u4").tobytes().decode("utf-32-le")
                    yield pd.DataFrame({"lang": lang, "gram": [text[i : i + ORDER] for i in range(0, len(text), ORDER)], "n": n})

    fits = taken.where("unit < 0.8").select("lang", "text").mapInPandas(count, "lang string, gram string, n long")
    counts = fits.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # bounded by the sample
    if not len(counts):
        return None
    model = build(counts)
    model.normal = np.tile(np.array([[0.0], [1.0], [1.0]]), (1, len(model.languages)))
    column = {x: i for i, x in enumerate(model.languages)}
    sent, key = send(taken.sparkSession, model), new_key("model")

    def judge(frames):
        scorer = once("language.fit", key, lambda: Scorer(sent()))
        for frame in frames:
            for block in text_blocks(frame, "text", 1_000_000):
                entropy, size = scorer.cross_entropy(list(block["text"]))
                yield pd.DataFrame({"lang": block["lang"].to_numpy(), "size": size, "entropy": entropy.astype(float).tolist()})

    left = taken.where("unit >= 0.8").select("lang", "text").mapInPandas(judge, "lang string, size long, entropy array<double>").toPandas()
    left = left[(left["size"] > 0) & left["lang"].isin(column)]
    if len(left):
        _calibrate(model, np.stack(left["entropy"]), left["size"].to_numpy(), left["lang"].map(column).to_numpy())
    return model


def _calibrate(model: Model, entropy: np.ndarray, size: np.ndarray, truth: np.ndarray) -> None:
    """Fit the sharpness of the score to the held-back texts, and what cross-entropy is usual for a text's length."""

    def loss(s: float) -> float:
        z = -entropy * s
        z -= z.max(axis=1, keepdims=True)
        return float(-(z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(axis=1))).mean())

    model.sharpness = min(np.geomspace(1, 200, 60).tolist(), key=loss)
    own = entropy[np.arange(len(entropy)), truth]
    for i in range(len(model.languages)):
        x, n = own[truth == i], size[truth == i]
        if len(x) < 8:
            x, n = own, size
        gap = (x - np.median(x)) ** 2
        each = float(np.sqrt(np.median(gap * n) / 0.455))  # 0.455: median of a squared standard normal value
        model.normal[:, i] = np.median(x), max(0.15, float(np.sqrt(np.median(gap) / 0.455))), max(each, 1.0)
    mean, between, each = model.normal[:, truth]
    odd = (own - mean) / np.sqrt(between**2 + each**2 / size)
    model.reach = max(8.0, 1.5 * float(np.quantile(odd, 0.999)))


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add lang_pred, score (0 to 1) and rejected to each row, from the whole text alone.

    `und`, score 0 and rejected where a text is null or has no letters, or where nothing could be learned. Rejected as
    well: a text whose cross-entropy is far above what is usual in the best language, or whose score is below 0.35.
    """
    ship(__name__)
    languages = model.languages if model else []
    fields = "lang_pred string, score double, rejected boolean"
    sent, key = send(docs.sparkSession, model), new_key("model")

    def run(frames):
        for frame in frames:
            frame = frame.drop(columns=["lang_pred", "score", "rejected"], errors="ignore")
            if not languages:
                yield frame.assign(lang_pred=NO_LANGUAGE, score=0.0, rejected=True)
                continue
            scorer = once("language.model", key, lambda: Scorer(sent()))
            names = np.array([*languages, NO_LANGUAGE], object)
            for block in text_blocks(frame, text, 1_000_000):
                best, score, rejected = scorer.decide(*scorer.cross_entropy([t or "" for t in block[text]]))
                yield block.assign(lang_pred=names[best], score=score, rejected=rejected)

    return docs.mapInPandas(run, add_columns(docs, fields))
