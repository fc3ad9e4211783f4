import random

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import negatives
from ordermill.llm.vectors import MOST

ROWS = "vec_id long, embedding array<float>, label int, score string, a int, row string"


def brute(rows, anchor):
    """Each window sorted by itself, from dictionaries."""
    named = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v], label) for i, v, label in rows]
    out = []
    for i, v, label in named:
        if not anchor(i):
            continue
        scored = [(sum(map(int.__mul__, v, w)), j, of) for j, w, of in named if j != i]
        near = sorted((-s, j) for s, j, of in scored if of == label)[: negatives.POSITIVES]
        for s, j in near:
            inside = sorted((-t, k) for t, k, of in scored if of != label and 50 * -s <= 100 * t <= 95 * -s)
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(inside[: negatives.NEGATIVES], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "y") for i, v, label in rows], ROWS)


def test_windows_equal_brute_force_in_several_blocks(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((-0.5, 0.0, 0.25, 0.5, 1.0)) for _ in range(6)], rng.randrange(3)) for i in range(300)]
    rows += [(i, [0.5] * 6, 1) for i in range(300, 420)]  # one very common vector: ties everywhere
    want = brute(rows, lambda i: i % 20 == 0)
    assert len(want) > 60
    for at_once in (8192, 5):
        got = negatives.mine(frame(spark, rows).repartition(7), F.col("vec_id") % 20 == 0, at_once=at_once)
        assert sorted(map(tuple, got.collect())) == want
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_odd_rows(spark):
    nan = float("nan")
    good = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.75, 0.0], 2), (3, [0.6, 0.0], 2), (4, [0.9, 0.0], 2)]
    odd = [(5, None, 1), (6, [1.0, nan], 1), (7, [1.0, None], 2), (8, [float("inf"), 0.0], 2), (9, [0.7, 0.0], None), (None, [0.7, 0.0], 2)]
    got = sorted(map(tuple, negatives.mine(frame(spark, good + odd), F.col("vec_id") == 0).collect()))
    assert got == brute(good, lambda i: i == 0) and {r[3] for r in got} == {2, 3, 4}
    assert negatives.mine(frame(spark, good[:0]), F.col("vec_id") == 0).count() == 0
    assert negatives.mine(frame(spark, good), F.col("vec_id") == 99).count() == 0
    assert negatives.mine(frame(spark, good[:1]), F.col("vec_id") == 0).count() == 0  # no positive
    # a repeated anchor is answered for each of its rows; a repeated negative takes a rank for each
    twice = sorted(map(tuple, negatives.mine(frame(spark, [*good, good[0], good[4]]), F.col("vec_id") == 0).collect()))
    assert sorted(r[3] for r in twice) == [2, 2, 4, 4, 4, 4]


def test_large_components_stay_exact():
    big = np.full((1, 64), MOST, np.int64)
    assert negatives.scores(big, big)[0, 0] == 64 * MOST**2
