import re
import zlib

import pytest

from ordermill.llm import toxicity
from ordermill.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def test_folding():
    assert toxicity.folded("ІDІ0T, 1d!ot; ﬁne $tupid a$$$! stuuuupid 2024 Wärme i​diot") == ["idiot", "idiot", "fine", "stupid", "a", "stupid", "2024", "warme", "idiot"]
    assert toxicity.folded("l00se Ill | $ \n") == ["ioose", "iii"] and toxicity.folded(None) == toxicity.folded("") == []


def brute_hits(model, words):
    """Every entry tried at every word."""
    out, at, excused = {}, 0, set()
    places = []
    for w in words:
        places.append(at)
        at += len(w) + 1
    for i, w in enumerate(words):
        if i + 1 < len(words) and f"{w} {words[i + 1]}" in model.phrases:
            excused |= {places[i], places[i + 1]}
        fits = [(v, e) for e, v in model.weights.items() if (w + " ").startswith(e)]
        if fits:
            out[places[i]] = max(fits)
    return [(a, *out[a]) for a in sorted(out) if a not in excused]


def test_automaton_equals_trying_every_entry(texts):
    words = [toxicity.folded(t) for t in texts.values()]
    seen = sorted({w for ws in words[:40] for w in ws})
    weights = {**{w[:3]: 1.0 + len(w) / 7 for w in seen[::9] if len(w) > 3}, **{w + " ": 2.0 + len(w) for w in seen[::5]}}
    phrases = [" ".join(ws[i : i + 2]) for ws in words[:60] for i in range(0, len(ws) - 1, 3)]
    model = toxicity.Model(weights, sorted(set(phrases)))
    matcher = toxicity.Matcher(model)
    assert sum(len(matcher.hits(ws)) for ws in words) > 500
    assert all(matcher.hits(ws) == brute_hits(model, ws) for ws in words)


def test_exception_phrases_are_learned(spark, docs):
    rows, labels = [], []
    for i in range(600):  # a word that toxic texts use more often than others do, and those in one phrase only
        kind = 0 if i % 3 == 0 else 1 if i % 12 == 1 else 2
        text = [f"you absolute ninny go away number{i}", f"the ninny goat grazes on hill number{i}", f"a calm walk by the river number{i}"][kind]
        rows.append((i, text))
        labels.append((i, 1, int(i % 3 == 0)))
    model = toxicity.train(docs(*rows), spark.createDataFrame(labels, LABELS))
    assert "ninny goat" in model.phrases and model.weights
    new = docs((1, "what an absolute n1nny he is"), (2, "a ninny goat"), (3, ""), (4, None), (5, "river " * 50_000), (5, "river " * 50_000))
    got = sorted((r["doc_id"], r["predicted"]) for r in toxicity.grade(new, model).collect())
    assert got == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 0), (5, 0)]
    assert toxicity.grade(new, model).schema["score"].dataType.simpleString() == "double"


def test_no_or_odd_labels(spark, docs):
    rows = docs((1, "some words"), (None, "other words"), (2, None))
    for labels in ([], [(1, 1, None), (None, 1, 1)], [(1, 1, 1), (1, 1, 0), (2, 0, 1)]):
        model = toxicity.train(rows, spark.createDataFrame(labels, LABELS))
        got = toxicity.grade(rows, model).collect()
        assert len(got) == 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert toxicity.grade(rows.limit(0), model).count() == 0
    assert toxicity.train(rows.limit(0), spark.createDataFrame([(1, 1, 1)], LABELS)).weights == {}


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.1"])
def test_held_out(spark, sf_dir):
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").collect()}
    got = QUERIES["op11_toxicity"](spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    hit = sum(t for s, t in held if s >= 0.7)
    assert hit >= 0.97 * sum(s >= 0.7 for s, _ in held) and hit >= 0.75 * sum(t for _, t in held)
    assert not re.search("lang|source", " ".join(got[0].asDict()))
