import zlib
from collections import Counter
from math import log10

import pytest

from ordermill.llm import lm


def base_figures(rows):
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    train = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in [*lm.words(t), b""])
    n, v = sum(train.values()), len(train)
    out = []
    for (d, t), h in zip(rows, held, strict=True):
        words = [*lm.words(t), b""]
        out.append((d, h, len(words), sum(train[w] > 0 for w in words), n, sum(log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)))
    return out


def test_counts_and_base_score(docs, texts):
    rows = list(texts.items()) + [(5001, None), (5002, ""), (5003, "Zz zZ"), (5003, "Zz zZ"), (None, "the É é"), (5004, "new" + " word" * 50_000)]
    got = sorted(lm.score(docs(*rows), lm.held_out(), word_share=1e-3).collect(), key=lambda r: (str(r["doc_id"]), r["base_score"]))
    want = sorted(base_figures(rows), key=lambda r: (str(r[0]), r[-1]))
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    assert [r["base_score"] for r in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_word_share_does_not_change_the_base(docs, texts):
    rows = list(texts.items())[:80]
    a, b = (sorted((r["doc_id"], round(r["base_score"], 6), r["n_known"]) for r in lm.score(docs(*rows), lm.held_out(), word_share=s).collect()) for s in (1e-9, 0.02))
    assert a == b


def test_score_beats_base_where_words_depend_on_each_other(docs):
    rows = [(i, "a b c d " * 6 + "x y") for i in range(60)]
    got = lm.score(docs(*rows), lm.held_out()).collect()
    assert all(r["score"] > r["base_score"] / 2 for r in got)


def test_every_state_sums_to_one():
    import random

    rnd = random.Random(4)
    words = rnd.choices(range(6), weights=[9, 5, 3, 2, 1, 1], k=4000)
    counts = Counter(words)
    vocabulary = [f"w{i}" for i in range(6)]
    grams = [{g: c for g, c in Counter(zip(*[words[i:] for i in range(k)])).items() if c >= t} for k, t in ((2, 8), (3, 12))]
    # context counts must cover every follower: the last word of the list has none
    n, v = len(words), len(counts)
    a = lm.assemble(vocabulary, [counts[i] for i in range(6)], n, v, grams)
    unknown = log10(0.5 / (n + 0.5 * (v + 1)))
    assert len(a.fail) > 10
    for s in range(len(a.fail)):
        gone, t = 0.0, s
        while t:
            gone, t = gone + a.weight[t], a.fail[t]
        total = sum(10 ** lm._prob(a, s, w) for w in range(6)) + 10 ** (gone + unknown)
        assert total == pytest.approx(1, abs=1e-9)


def test_walk_is_the_sum_over_longest_contexts():
    grams = [{(0, 1): 5, (1, 2): 4}, {(0, 1, 2): 3}]
    a = lm.assemble(["a", "b", "c"], [10, 8, 6], 24, 3, grams)
    p = lambda *g: lm._prob(a, {(): 0, (0,): 1, (1,): 2, (0, 1): 3}[g[:-1]], g[-1])
    assert a.score([0, 1, 2, 0]) == pytest.approx(p(0) + p(0, 1) + p(0, 1, 2) + p(0))
    assert a.score([0, 1, -1, 1]) == pytest.approx(p(0) + p(0, 1) + a.weight[3] + a.weight[2] + p(1))


def test_candidates_are_counted_exactly(spark, docs, texts):
    rows = list(texts.items())[:60]
    vocabulary = [w.decode() for w, _ in Counter(w for _, t in rows for w in [*lm.words(t), b""]).most_common(50)]
    tokens = lm.tokenise(docs(*rows).selectExpr("doc_id", "false as held_out", "text").repartition(3), vocabulary)
    number = {w.encode(): i for i, w in enumerate(vocabulary)}
    seqs = [[number.get(w, -1) for w in [*lm.words(t), b""]] for _, t in rows]
    n = sum(map(len, seqs))
    got = lm.count_grams(tokens, len(vocabulary), n, 3, 1e-4)
    for k in (2, 3):
        want = Counter(g for s in seqs for g in zip(*[s[i:] for i in range(k)]) if -1 not in g)
        assert got[k - 2] == {g: c for g, c in want.items() if c >= max(2, 1e-4 * n)}


def test_nothing_to_learn_from_and_empty(docs):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    assert [tuple(r) for r in lm.score(docs((held, "a b")), lm.held_out()).collect()] == [(held, True, 3, 0, 0, 0.0, 0.0)]
    assert lm.score(docs((1, "a")).limit(0), lm.held_out()).count() == 0


def test_score_is_that_of_all_repeated_grams(docs, texts):
    """Every pair and triple seen twice counts, rare words and rare n-grams too, as an automaton of all of them scores."""
    rows = list(texts.items())[:80] + [(6001, "rare_one rare_two rare_three"), (6002, "rare_one rare_two rare_four"), (6003, ""), (6004, None)]
    seqs = {d: [*lm.words(t), b""] for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in seqs}
    counts = Counter(w for d, s in seqs.items() if not held[d] for w in s)
    vocabulary = [w.decode() for w in counts]
    number = {w: i for i, w in enumerate(counts)}
    grams = [{g: c for g, c in Counter(g for d, s in seqs.items() if not held[d] for g in zip(*[[number[w] for w in s][i:] for i in range(k)])).items() if c >= 2} for k in (2, 3)]
    n, v = sum(counts.values()), len(counts)
    automaton = lm.assemble(vocabulary, list(counts.values()), n, v, grams)
    unknown = log10(0.5 / (n + 0.5 * (v + 1)))
    for shares in ({}, {"word_share": 1e-3}, {"word_share": 2.0}):
        got = {r["doc_id"]: r["score"] for r in lm.score(docs(*rows), lm.held_out(), **shares).collect()}
        for d, s in seqs.items():
            ids = [number.get(w, -1) for w in s]
            assert got[d] == pytest.approx(automaton.score(ids) + ids.count(-1) * unknown, rel=1e-9)


def test_unlike_grams_are_dealt_in_few_bytes(docs):
    """All n-grams of these texts differ; what is dealt of each is less than its number, and one row for each bucket."""
    import numpy as np

    rows = [(i, " ".join(f"w{i}_{j}" for j in range(500))) for i in range(40)]
    tokens = lm.tokenise(docs(*rows).selectExpr("doc_id", "false as held_out", "text").coalesce(1), []).toPandas().assign(row=range(40))
    asked = lm.Backoff(lm._vocabulary_hashes([]), 3, 2, 20_040, 20_001, 3).asked(tokens)
    codes = [lm._unpack(c) for c in asked["codes"]]
    assert len(asked) == 8 and sum(map(len, codes)) == 20_001 + 20_000 + 40 * 499
    assert len(np.unique(np.concatenate(codes))) == sum(map(len, codes))
    assert sum(map(len, asked["codes"])) + sum(map(len, asked["times"])) < 7.5 * sum(map(len, codes))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_every_order_in_many_blocks_scores_as_its_automaton(docs, texts, monkeypatch, order):
    """Blocks of a few hundred tokens, so that most n-grams are counted, and most sums made, across blocks and rounds."""
    monkeypatch.setattr(lm, "_COUNTED_AT_ONCE", 300)
    rows = [*list(texts.items())[:40], (6001, "rare_one rare_two rare_three rare_four"), (6002, "rare_one rare_two rare_three rare_five"), (6003, ""), (6004, None)]
    seqs = {d: [*lm.words(t), b""] for d, t in rows}
    learned = [s for d, s in seqs.items() if zlib.crc32(str(d).encode()) % 5 != 1]
    counts = Counter(w for s in learned for w in s)
    number = {w: i for i, w in enumerate(counts)}
    grams = [{g: c for g, c in Counter(g for s in learned for g in zip(*[[number[w] for w in s][i:] for i in range(k)])).items() if c >= 2} for k in range(2, order + 1)]
    n, v = sum(counts.values()), len(counts)
    automaton = lm.assemble([w.decode() for w in counts], list(counts.values()), n, v, grams)
    unknown = log10(0.5 / (n + 0.5 * (v + 1)))
    got = {r["doc_id"]: r for r in lm.score(docs(*rows).repartition(3), lm.held_out(), order=order).collect()}
    for d, s in seqs.items():
        ids = [number.get(w, -1) for w in s]
        assert got[d]["score"] == pytest.approx(automaton.score(ids) + ids.count(-1) * unknown, rel=1e-9)
        assert (got[d]["n_known"], got[d]["train_tokens"]) == (len(ids) - ids.count(-1), n)


def test_doc_ids_stay_exact_beside_a_null(docs):
    """One row without an id must not turn the others' ids into floating-point numbers."""
    ids = [2**62 + 1, 2**62 + 3, None]
    got = lm.score(docs(*((d, "a b a b") for d in ids)).coalesce(1), lm.held_out()).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted(ids, key=str)


def test_no_triple_is_dealt_whose_pairs_are_rare():
    """Of texts that repeat one pair and one triple, the second round deals that triple and nothing else."""
    import numpy as np
    import pandas as pd

    texts = ["x y z"] * 2 + [f"a{i} b{i} c{i} d{i}" for i in range(200)]
    number: dict[str, int] = {}
    ids = [[number.setdefault(w, len(number)) for w in t.split()] for t in texts]
    tokens = lm.Tokens(lm._vocabulary_hashes(list(number))[:-1], np.concatenate(ids), np.repeat(np.arange(len(ids)), [len(i) for i in ids]), np.ones(len(ids), bool))
    backoff = lm.Backoff(np.zeros(1, np.uint64), 3, 2, 0, 0, 3)
    first = backoff.first(tokens, 0, 2)
    told = pd.concat([lm._whole_counts(some, 2, True) for _, some in first.groupby("bucket")])
    assert told["v"].sum() == len(number)
    second = backoff.next(tokens, 0, told, 1)
    assert sum(len(lm._unpack(c)) for c in second["codes"]) == 1 and lm._from_planes(second["times"][0], np.int64).tolist() == [2]


def test_shuffles_go_once_a_stage_is_written(spark, docs, monkeypatch):
    """Every stage of the operator is written with the removal of its shuffles, and the session's own setting comes back."""
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(option), []
    plain = lm.stage
    monkeypatch.setattr(lm, "stage", lambda df, name: (seen.append(spark.conf.get(option)), plain(df, name))[1])
    assert lm.score(docs((1, "a b a b"), (2, "a b")), lm.held_out()).count() == 2
    assert seen == ["true"] * 4 and spark.conf.get(option) == before
