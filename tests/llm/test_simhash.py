import numpy as np
import pytest
import xxhash

from ordermill.llm import simhash
from ordermill.llm.components import components


def fingerprint(text, words=4):
    w = (text or "").encode().lower().split()
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + words]), 42) for i in range(max(1, len(w) - words + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def groups(points):
    """Least index reachable over links of at most four bits, by all pairs."""
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if (points[i] ^ points[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def cloud(seed, centers, copies, most):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, centers).astype(np.uint64)
    out = [base]
    for _ in range(copies):
        m = np.zeros(centers, np.uint64)
        for _ in range(int(rng.integers(1, most))):
            m |= np.uint64(1) << rng.integers(0, 64, centers).astype(np.uint64)
        out.append(base ^ m)
    return np.unique(np.concatenate(out))


def test_classes_against_all_pairs(docs, texts):
    rows = list(texts.items()) + [(9001, None), (9002, ""), (9003, " \n"), (9004, "One two"), (9005, "one  TWO"), (3, texts[3]), (None, texts[3]), (9006, "w " * 60_000), (9007, "É é"), (9008, "é É")]
    got = simhash.classes(docs(*rows)).collect()
    prints = {(t or ""): fingerprint(t) for _, t in rows}
    distinct = sorted(set(prints.values()))
    of = dict(zip(distinct, groups(distinct), strict=True))
    least: dict = {}
    for d, t in rows:
        if d is not None:
            c = of[prints[t or ""]]
            least[c] = min(least.get(c, d), d)
    want = sorted(((d, prints[t or ""], least[of[prints[t or ""]]]) for d, t in rows), key=str)
    assert sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got), key=str) == want


@pytest.mark.parametrize("limit", [30, 4096])
def test_links_against_all_pairs_also_where_shards_split(spark, limit):
    points = np.unique(np.concatenate([cloud(1, 40, 8, 7), cloud(2, 1, 300, 5)]))
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    tied = {a: b for a, b in components(simhash.links(df, limit)).collect()}
    got = [tied.get(int(x), int(x)) for x in points.view(np.int64)]
    want = groups([int(x) for x in points])
    assert len(set(zip(got, want, strict=True))) == len(set(want)) == len(set(got))


def test_tree_finds_what_all_pairs_find():
    points = cloud(3, 300, 12, 8)
    tree, plain = simhash.Links(points), simhash.Links(points)
    tree.within(np.arange(len(points)))
    plain.compare(np.arange(len(points)), np.arange(len(points)), True)
    assert (tree.root == plain.root).all()


@pytest.mark.parametrize("n", [10, 10**8, 10**11, 10**13])
def test_masks_meet_every_close_pair(n):
    rng = np.random.default_rng(0)
    choice = simhash.masks(n, 4096)
    for _ in range(300):
        flip = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not flip & m for m in choice)


def test_long_chain_is_one_component(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(1, 300)] + [(500, 500), (601, 600), (600, 601)], "a long, b long")
    assert {(a, b) for a, b in components(df).collect()} == {(i, 1) for i in range(2, 301)} | {(601, 600)}


def test_empty_table(docs):
    assert simhash.classes(docs((1, "a")).limit(0)).count() == 0
