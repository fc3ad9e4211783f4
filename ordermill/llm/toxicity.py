"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton over folded text, with exception phrases.

Folding undoes disguise: compatibility forms and accents go, letters of other scripts that look like Latin ones become
those, digits and signs used as letters inside a word become letters, runs of three or more equal letters become one, and
`l` and `i` become one. Entries are words and beginnings of words, so that they match inflected forms; an entry matches at the
start of a word only. Where several entries match at one place, the heaviest counts.

The lexicon is learned: an entry's weight is the lower confidence limit of the log ratio of its frequency among toxic and
other documents, both smoothed.
Exception phrases are an entry's word with the word before or after it, where other documents use that pair and toxic ones
hardly do; a match inside such a phrase does not count. What a document's matches weigh, in all, for each word of the text and
at most, is turned into a score by a logistic fit on documents whose labels the lexicon has not seen.

Learning takes a bounded sample of labelled texts (`fit_docs` of each label); scoring reads every whole text.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import add_columns, new_key, once, send, ship, stage, text_blocks

FIT_DOCS, ENTRIES, PHRASES = 6000, 4000, 2000
THRESHOLD = 0.7
_LEAST, _LIGHTEST, _PREFIX, _LONGEST = 4, 0.7, range(3, 9), 24

# Letters of other scripts by the Latin letter they look like, and signs used as letters.
_LOOKALIKES = {
    "a": "аαɑ", "b": "ьвβ", "c": "сϲ", "d": "ԁ", "e": "еєε", "f": "ƒ", "g": "ɡ", "h": "һн", "i": "іιıӏ", "j": "јϳ", "k": "кκ",
    "m": "м", "n": "пη", "o": "оοσ", "p": "рρ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}
_SWAP = {ord(c): to for to, letters in _LOOKALIKES.items() for c in letters}
_SIGN_SWAP = {ord(c): to for c, to in _SIGNS.items()}
# A word, with signs inside it or before it only: those after its last letter or digit are punctuation.
_WORD = re.compile(r"[@$|€]*\w(?:[\w@$!|€]*\w)?")
_RUN = re.compile(r"(.)\1{2,}")


class _Letters(dict):
    """One character's folded form, found once."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKD", chr(code).casefold())
        kept = "".join(_SWAP.get(ord(c), c) for c in plain if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
        self[code] = kept
        return kept


_LETTERS = _Letters()


def _word(w: str) -> str:
    if not w.isalpha() and any(c.isalpha() for c in w):
        w = w.translate(_SIGN_SWAP)
    return _RUN.sub(r"\1", w).replace("l", "i")


def folded(text: str | None) -> list[str]:
    """The folded words of a text."""
    return [_word(w) for w in _WORD.findall((text or "").translate(_LETTERS))]


def entries_of(words: list[str]) -> set[str]:
    """What a text offers to the lexicon: its words (ended by a space) and their beginnings."""
    out = set()
    for w in set(words):
        if len(w) <= _LONGEST:
            out.add(w + " ")
        out.update(w[:k] for k in _PREFIX if k <= len(w))
    return out


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    phrases: list[str] = field(default_factory=list)  # two folded words
    fit: np.ndarray | None = None  # weights of the features, the last one alone
    base: float = 0.0


class Matcher:
    """The automaton over entries and exception phrases."""

    def __init__(self, model: Model):
        self.model, self.machine = model, ahocorasick.Automaton()
        for e, w in model.weights.items():
            self.machine.add_word(" " + e, (w, len(e), e))
        for p in model.phrases:
            self.machine.add_word(f" {p} ", (None, len(p) + 1, p.index(" ") + 1))
        if len(self.machine):
            self.machine.make_automaton()

    def hits(self, words: list[str]) -> list[tuple[int, float, str]]:
        """Place, weight and entry of the heaviest match at each word, those inside exception phrases left out."""
        if not len(self.machine):
            return []
        found: dict[int, tuple[float, str]] = {}
        excused: list[int] = []
        for end, (w, n, e) in self.machine.iter(f" {' '.join(words)} "):
            at = end - n  # where the (first) word begins in the joined words
            if w is None:
                excused += [at, at + e]
            elif (w, e) > found.get(at, (0.0, "")):
                found[at] = w, e
        for at in excused:
            found.pop(at, None)
        return [(at, *found[at]) for at in sorted(found)]

    def features(self, words: list[str]) -> list[float]:
        hits = self.hits(words)
        weights = [w for _, w, _ in hits]
        total, most, n = sum(weights), max(weights, default=0.0), len(words)
        heavy = sum(w for w in weights if w > 2)
        return [most, np.log1p(total), np.log1p(1000 * total / (n + 20)), np.log1p(heavy), np.log1p(1000 * heavy / (n + 20)), np.log1p(len({e for *_, e in hits})), 1.0]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic fit, by Newton steps; the last column (ones) is not held back."""
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(model: Model, features: np.ndarray) -> np.ndarray:
    if model.fit is None:
        return np.full(len(features), model.base)
    return 1 / (1 + np.exp(-np.clip(features @ model.fit, -30, 30)))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _counted(sample: DataFrame, make) -> DataFrame:
    """Documents of each label that hold a thing; `make(words)` gives a text's things."""

    def run(frames):
        counts = {0: Counter(), 1: Counter()}
        for frame in frames:
            for text, label in zip(frame["text"], frame["toxic"], strict=True):
                counts[label].update(make(folded(text)))
            while sum(map(len, counts.values())) > 500_000:  # the sums go on, so that a task's memory is bounded
                yield _flat(counts)
                counts = {0: Counter(), 1: Counter()}
        yield _flat(counts)

    def _flat(counts):
        things = list(counts[0] | counts[1])
        return pd.DataFrame({"thing": things, "bad": [counts[1][t] for t in things], "good": [counts[0][t] for t in things]}).astype({"bad": "int64", "good": "int64"})

    return sample.select("text", "toxic").mapInPandas(run, "thing string, bad long, good long").groupBy("thing").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def sample_of(docs: DataFrame, labels: DataFrame, fit_docs: int) -> DataFrame:
    """toxic, text, h: about `fit_docs` different texts of each label, chosen by their hashes.

    A doc_id with several labels counts as toxic if one of them says so.
    """
    told = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = stage(told.where(~held_out()), "toxic-labels")
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    share = lambda n: F.lit(int(min(1.0, 1.2 * fit_docs / max(n, 1)) * 2**31))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < F.when(F.col("toxic") == 1, share(counts.get(1, 0))).otherwise(share(counts.get(0, 0))))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id").select("toxic", "text", F.xxhash64("text", F.lit("fit")).alias("h"))
    one = stage(texts.groupBy("h", "toxic").agg(F.min("text").alias("text")), "toxic-texts")
    # An id of very many rows may bring more texts than ids were asked for; texts are thinned by their own hash.
    n = {r[0]: r[1] for r in one.groupBy("toxic").count().collect()}
    thin = lambda c: F.lit(int(min(1.0, 1.5 * fit_docs / max(c, 1)) * 2**31))
    return one.where(F.pmod(F.xxhash64("h"), F.lit(2**31)) < F.when(F.col("toxic") == 1, thin(n.get(1, 0))).otherwise(thin(n.get(0, 0))))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, entries: int = ENTRIES, phrases: int = PHRASES) -> Model:
    """The model of documents (doc_id, text) by labels (doc_id, toxic), the held-out doc_ids left out.

    Null labels and labels without doc_id are not used. Without texts of both labels the lexicon is empty and every score is the
    (smoothed) share of toxic texts.
    """
    ship(__name__)
    spark = docs.sparkSession
    sample = sample_of(docs, labels, fit_docs)
    fit = sample.where(F.pmod(F.xxhash64("h", F.lit(7)), F.lit(3)) < 2)  # two thirds for the lexicon, the rest for the fit
    n = {r[0]: r[1] for r in fit.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model(base=(n.get(1, 0) + 0.5) / (sum(n.values()) + 1) * 0.99)
    scale = F.lit(float(n[0]) / n[1])
    ratio = F.log((F.col("bad") + 0.5) * scale / (F.col("good") + 0.5))
    # Entries weigh what their counts are sure of: the lower end of the log ratio, 1.5 standard errors down.
    weight = ratio - 1.5 * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    gain = F.col("bad") * F.col("w")
    heavy = _counted(fit, entries_of).where(F.col("bad") >= _LEAST).withColumn("w", weight).where(F.col("w") >= _LIGHTEST)
    model = Model({r["thing"]: float(r["w"]) for r in heavy.orderBy(gain.desc(), "thing").limit(entries).collect()})
    lexicon, key = send(spark, model), new_key("toxic-lexicon")

    def pairs(words):
        matcher = once("toxicity.lexicon", key, lambda: Matcher(lexicon()))
        places = np.cumsum([0, *(len(w) + 1 for w in words)])
        out = set()
        for at, *_ in matcher.hits(words):
            i = int(np.searchsorted(places, at))
            out.update(" ".join(words[j : j + 2]) for j in (i - 1, i) if 0 <= j < len(words) - 1)
        return out

    excused = _counted(fit, pairs).where((F.col("good") >= _LEAST) & (ratio <= -_LIGHTEST))
    model.phrases = [r["thing"] for r in excused.orderBy(F.desc("good"), "thing").limit(phrases).collect()]
    rest = sample.where(F.pmod(F.xxhash64("h", F.lit(7)), F.lit(3)) == 2)
    rows = featured(rest, model, "toxic").select("toxic", "features").collect()  # one small row for each text of the sample
    if len({r[0] for r in rows}) == 2:
        x, y = np.array([r[1] for r in rows]), np.array([r[0] for r in rows], float)
        model.fit = logistic(x, y)
    else:
        model.base = n[1] / sum(n.values())
    return model


def featured(rows: DataFrame, model: Model, *keep: str) -> DataFrame:
    ship(__name__)
    load, key = send(rows.sparkSession, model), new_key("toxic-model")

    def run(frames):
        matcher = once("toxicity.matcher", key, lambda: Matcher(load()))
        for frame in frames:
            for block in text_blocks(frame, "text"):
                yield block[list(keep)].assign(features=[matcher.features(folded(t)) for t in block["text"]])

    asked = rows.select(*keep, "text")
    return asked.mapInPandas(run, add_columns(rows.select(*keep), "features array<double>"))


def grade(rows: DataFrame, model: Model) -> DataFrame:
    """The rows (doc_id, text and any others) with score (0 to 1) and predicted (1 from 0.7 on).

    Null texts count as empty ones; a text without matches gets the fit's lowest range. Texts of any length are folded and matched
    whole. Repeated rows are scored each; columns named score or predicted are replaced; an empty table gives an empty one.
    """
    ship(__name__)
    load, key = send(rows.sparkSession, model), new_key("toxic-model")
    new = {"score", "predicted"}
    kept = [c for c in rows.columns if c.lower() not in new]

    def run(frames):
        matcher = once("toxicity.matcher", key, lambda: Matcher(load()))
        for frame in frames:
            for block in text_blocks(frame, "text"):
                p = probability(matcher.model, np.array([matcher.features(folded(t)) for t in block["text"]]))
                yield block.assign(score=p, predicted=(p >= THRESHOLD).astype(np.int32))

    asked = rows.select(*kept)
    return asked.mapInPandas(run, add_columns(asked, "score double, predicted int"))
