import numpy as np

from ordermill.llm import quality
from ordermill.llm.queries import QUERIES


def test_agrees_with_given_labels(spark, sf):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    good = [got[d]["keep"] for d, q in truth.items() if q == 1 and d in got]
    bad = [got[d]["keep"] for d, q in truth.items() if q == 0 and d in got]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.05


def test_votes():
    kind = quality.kinds()
    fine = "This is a plain sentence with some words. And here is another one, not so long."
    cases = {
        "symbols": "a### b$$$ c%%% d&&&", "shouting": "ALL THESE WORDS ARE LOUD", "exclaiming": "so!! many!! of!! them!!", "bars": "a | b | c | d",
        "stutter": "the the the the the the", "repeated_lines": "x y\nx y\nx y\nx y", "letters": "12 34 56 a 78",
    }
    for name, text in cases.items():
        at = quality.LABELLERS.index(name)
        v = quality.votes(quality.properties([text, fine], kind))
        assert v[0, at] == quality.BAD and v[1, at] != quality.BAD, name
        assert (v[1] != quality.BAD).all()


def test_estimation_recovers_planted_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    k = len(quality.LABELLERS)
    accuracy = np.linspace(0.7, 0.95, k)
    right = rng.random((len(good), k)) < accuracy
    votes = np.where(right == good[:, None], quality.GOOD, quality.BAD)
    votes[rng.random(votes.shape) < 0.2] = quality.NONE
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    weak = quality.estimate(patterns, n)
    assert abs(weak.good_share - 0.8) < 0.03
    assert np.abs(weak.table[1, :, quality.GOOD] - accuracy).max() < 0.05
    assert ((weak.posterior(votes) > 0.5) == good).mean() > 0.97


def test_odd_rows(docs):
    fine = [(i, f"Here is some plain text number {i}. It has two short sentences of words.") for i in range(30)]
    junk = [(100 + i, f"a{i}### b$$$ c%%% d&&& e*** " * 8) for i in range(10)]
    rows = docs(*fine, *junk, (200, None), (201, ""), (202, " \n "), (203, "x" * 200_000), (5, fine[5][1]), (None, fine[6][1]))
    model = quality.train(rows)
    got = quality.grade(rows.withColumnRenamed("n", "keep"), model).collect()
    assert len(got) == 46
    kept = {r["doc_id"]: r["keep"] for r in got}
    assert not any(kept[d] for d in (200, 201, 202)) and all(kept[i] for i in range(30)) and kept[None] and not any(kept[100 + i] for i in range(10))
    empty = docs((1, "a")).limit(0)
    assert quality.grade(empty, quality.train(empty)).count() == 0
