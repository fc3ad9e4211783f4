import zlib

import numpy as np
import pandas as pd
import pytest

from ordermill.llm import language
from ordermill.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf):
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op4_language"](spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert sum(r["rejected"] for r in got) <= 0.01 * len(got) and all(0 <= r["score"] <= 1 for r in got)


def test_probabilities_sum_to_one():
    grams = [(lang, g, n) for lang, gs in (("x", ["   a", "  ab", " ab ", "  b ", "   b"]), ("y", ["   b", "  ba", " ba "])) for g, n in zip(gs, (3, 2, 2, 1, 1), strict=False)]
    scorer = language.Scorer(language.build(pd.DataFrame(grams, columns=["lang", "gram", "n"])))
    model = scorer.model
    # after any context, all known characters and one unknown one share the whole probability
    letters = [" ", "a", "b", "\0"]
    for context in ("   ", "  a", " ab", "zzz", " zb"):
        total = np.zeros(2)
        for c in letters:
            log, place = np.zeros(2), context + c
            while True:
                key = language._hash_rows(np.array([[ord(x) for x in place]], np.uint64))
                k = len(place) - 1
                at = scorer.grams[k].find(key)[0]
                if at >= 0:
                    log += model.logs[k][at]
                    break
                head = language._hash_rows(np.array([[ord(x) for x in place[:-1]]], np.uint64).reshape(1, -1))
                if k == 0:
                    log += model.weights[0][0] + model.unseen
                    break
                ctx = scorer.contexts[k].find(head)[0]
                if ctx >= 0:
                    log += model.weights[k][ctx]
                place = place[1:]
            total += np.exp(log)
        assert total == pytest.approx([1, 1], abs=1e-4), context


def test_texts_without_letters_and_odd_ones(docs):
    learn = [(i, "the cat sat on the mat and the dog ran to the house " * 4, "en") for i in range(40)] + [(100 + i, "le chat est sur la table et les chiens sont dans la rue " * 4, "fr") for i in range(40)]
    model = language.train(docs(*learn))
    asked = docs((1, None), (2, ""), (3, "123 !!"), (4, "the dog and the cat"), (5, "漢字" * 400), (6, "la rue et la table"), (6, "la rue et la table"), (None, "the mat " * 30_000))
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["rejected"]) for r in language.identify(asked, model).collect()))
    assert got[:4] == [(0, "en", False), (1, "und", True), (2, "und", True), (3, "und", True)]
    assert got[4] == (4, "en", False) and got[5][1] in ("en", "fr") and got[5][2] and got[6] == got[7] == (6, "fr", False)


def test_nothing_to_learn_from(docs):
    model = language.train(docs((1, "text"), (2, None, "en")))
    assert model is None
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in language.identify(docs((1, "text")), model).collect()] == [("und", 0.0, True)]
    assert language.identify(docs((1, "a")).limit(0), model).count() == 0


def test_hash_array_finds_what_is_there():
    rng = np.random.default_rng(0)
    h = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2))
    array = language.HashArray(h)
    assert (array.find(h) == np.arange(len(h))).all() and (array.find(h + np.uint64(1)) == -1).all()
    assert (language.HashArray(h[:0]).find(h[:3]) == -1).all()
