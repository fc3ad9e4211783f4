import hashlib
import random

import numpy as np

from ordermill.llm import codes

ROWS = "vec_id long, embedding array<float>, label int, code string, error string, bounds int"


def brute(rows, parts, entries, rounds):
    """Plain rounds over lists: every distance is computed."""
    ints = {i: np.floor(np.float32(v).astype(np.float64) * 256).astype(int).reshape(parts, -1) for i, v, _ in rows}
    books = [[ints[i][p].tolist() for i in sorted(ints)[:entries]] for p in range(parts)]
    square = lambda a, b: sum((int(x) - int(y)) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min((square(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for i in ints:
                held.setdefault(nearest(ints[i][p], books[p])[1], []).append(ints[i][p])
            books[p] = [[int(sum(int(x[k]) for x in held[e])) // len(held[e]) for k in range(len(b))] if e in held else b for e, b in enumerate(books[p])]
    out, label_error = {}, {}
    for i, _, label in rows:
        last = [nearest(ints[i][p], books[p]) for p in range(parts)]
        out[i] = "".join(f"{k:02x}" for _, k in last), sum(d for d, _ in last)
        label_error[label] = label_error.get(label, 0) + out[i][1]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, *out[i], label_error[label], digest) for i, _, label in rows)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", 1) for i, v, label in rows], ROWS)


def test_rounds_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((rng.gauss(0, 0.2), 0.125)) for _ in range(8)], rng.choice((0, 1, None))) for i in range(250)]
    rows += [(i, [0.125] * 8, 2) for i in range(250, 330)]
    for rounds in (0, 2, 4):
        got = codes.compress(frame(spark, rows).repartition(5), parts=4, entries=20, rounds=rounds)
        assert sorted(map(tuple, got.collect())) == brute(rows, 4, 20, rounds)


def test_bounds_spare_measurements_and_hold():
    rng = np.random.default_rng(1)
    centres = rng.integers(-800, 800, (32, 4))
    x = (centres[rng.integers(0, 32, 3000)] + rng.integers(-20, 20, (3000, 4))).astype(np.int64)
    history = [x[:32].copy()]
    own, bounds, _ = codes.first(x, history[0])
    stamps = np.zeros(bounds.shape, np.uint8)
    for now in range(1, 6):
        book = history[-1].copy()
        for e in np.unique(own):
            book[e] = x[own == e].sum(0) // (own == e).sum()
        history.append(book)
        moved = codes.displacement(np.array(history)[:, None], now)[:, 0]
        own, nearest, measured = codes.again(x, own, bounds, stamps, book, moved, now)
        d = ((x[:, None] - book[None]) ** 2).sum(-1)
        assert (own == d.argmin(1)).all() and (nearest == d.min(1)).all()
        d[np.arange(len(x)), own] = np.iinfo(np.int64).max
        others = np.sqrt(np.minimum.reduceat(d, np.arange(0, 32, codes.GROUP), axis=1).astype(np.float64))
        assert (bounds - moved[stamps, np.arange(bounds.shape[1])] <= others).all()
    assert measured < 0.6 * bounds.size


def test_odd_rows(spark):
    nan = float("nan")
    good = [(0, [1.0, 0.0, 0.5, 0.5], 1), (3, [1.0, 0.5, -0.5, 0.5], None), (4, [0.75, 0.0, 0.5, 0.25], None)]
    odd = [(5, None, 1), (6, [1.0, nan, 0.0, 0.0], 1), (7, [1.0, None, 0.0, 0.0], 2), (8, [float("inf")] * 4, 2)]
    got = codes.compress(frame(spark, good + odd), parts=2, entries=64)
    assert sorted(map(tuple, got.collect())) == brute(good, 2, 64, 2)
    assert codes.compress(frame(spark, good[:0])).count() == 0
    twice = codes.compress(frame(spark, [*good, good[0]]), parts=2).collect()
    assert len(twice) == 4 and len({r["code"] for r in twice if r["vec_id"] == 0}) == 1
