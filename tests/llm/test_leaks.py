import random

from ordermill.llm import leaks


def brute(docs, items):
    out = {}
    for d, t in docs:
        words = b" " + b" ".join(leaks.tokens(t)) + b" "
        out[d] = sorted(i for i, x in items if x and (w := leaks.tokens(x)) and b" " + b" ".join(w) + b" " in words)
    return out


def test_recall_on_the_given_tables(spark, texts, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {r["doc_id"]: r["item_ids"] for r in leaks.find_leaks(spark.read.parquet(f"{sf}/documents.parquet"), bench).collect()}
    want = brute(texts.items(), [(r["item_id"], r["text"]) for r in bench.collect()])
    pairs = [(d, i) for d, items in want.items() for i in items]
    assert pairs and sum(i in got[d] for d, i in pairs) >= 0.9 * len(pairs)
    assert all(want[d] for d, items in got.items() if items)  # clean documents stay clean


def made(seed, n, size=4000):
    rnd = random.Random(seed)
    return [f"w{int(size ** rnd.random())}" for _ in range(n)]


def test_paraphrases_and_clean_texts(spark, docs):
    items = [(i, made(i, 20 + 7 * i)) for i in range(20)]
    rows, want = [], {}
    for i, words in items:
        rnd = random.Random(100 + i)
        soft = [w if rnd.random() > 0.15 else f"other{rnd.random()}" for w in words]
        for k, body in enumerate((words, [w.upper() + "," for w in words], soft)):
            d = i * 10 + k
            rows.append((d, " ".join(made(1000 + d, 150) + body + made(2000 + d, 90 + d))))
            want[d] = [i]
        rows.append((i * 10 + 5, " ".join(made(3000 + i, 400))))
        want[i * 10 + 5] = []
        half = " ".join(made(4000 + i, 100) + words[: len(words) // 3] + made(5000 + i, 100))
        if len(words) <= leaks.SEGMENT:  # a longer item's third may be a whole segment
            rows.append((i * 10 + 6, half))
            want[i * 10 + 6] = []
    rows += [(900, " ".join(made(77_777, 30_000) + items[3][1])), (901, None), (902, ""), (903, " ".join(items[4][1])), (903, " ".join(items[4][1])), (None, "x")]
    want |= {900: [3], 901: [], 902: [], 903: [4], None: []}
    bench = spark.createDataFrame([(i, " ".join(w), "e") for i, w in items] + [(50, None, "e"), (51, "", "e"), (None, "a b", "e")], "item_id long, text string, doc_id string")
    got = leaks.find_leaks(docs(*rows), bench).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: r["item_ids"] for r in got}
    assert all(set(found[d]) <= set(w) for d, w in want.items())
    assert sum(found[d] == w for d, w in want.items() if w) >= 0.95 * sum(map(bool, want.values()))
    kept = [r["doc_id"] for r in leaks.drop_leaks(docs(*rows), bench).collect()]
    assert sorted(map(str, kept)) == sorted(str(r[0]) for r in rows if not found[r[0]])


def test_no_items_or_no_documents(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in leaks.find_leaks(docs((1, "a b c")), none).collect()] == [(1, False, [], None, None)]
    one = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert leaks.find_leaks(docs((1, "a")).limit(0), one).count() == 0


def test_longest_common_subsequence():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
        return row[-1]

    rnd = random.Random(3)
    for _ in range(300):
        a, b = rnd.choices(range(6), k=rnd.randint(1, 20)), rnd.choices(range(7), k=rnd.randint(0, 30))
        masks = {}
        for i, t in enumerate(a):
            masks[t] = masks.get(t, 0) | 1 << i
        assert leaks.common(masks, len(a), b, 0).bit_count() == lcs(a, b)


def test_a_run_across_the_borders_of_a_long_item(spark, docs):
    """Verbatim runs inside an item of 128 words, wherever they begin; its end need not be there."""
    words = made(42, 128)
    runs = [(20, 119), (0, 96), (16, 112), (32, 128)]
    rows = [(i, " ".join(made(500 + i, 120) + words[s:e] + made(600 + i, 130))) for i, (s, e) in enumerate(runs)]
    rows += [(10, " ".join(made(700, 300))), (11, " ".join(made(701, 100) + words[40:70] + made(702, 100)))]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(made(43, 30)))], "item_id long, text string")
    found = {r["doc_id"]: r["item_ids"] for r in leaks.find_leaks(docs(*rows), bench).collect()}
    assert found == {0: [1], 1: [1], 2: [1], 3: [1], 10: [], 11: []}


def test_segments_cover_every_word():
    for n in (1, 64, 65, 96, 97, 128, 400):
        got = leaks.segments_of(list(range(n)))
        starts = [s[0] for s in got]
        assert all(len(s) == min(n, leaks.SEGMENT) for s in got) and got[-1][-1] == n - 1
        assert starts[0] == 0 and all(0 < b - a <= leaks.SEGMENT // 2 for a, b in zip(starts, starts[1:]))


def test_the_basis_is_that_of_all_documents(spark, docs):
    """Half of 2400 documents, those a draw of 1000 by doc_id leaves out, hold three of the four topics."""
    import numpy as np
    from pyspark.sql import functions as F

    unit = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("leaks")), F.lit(1 << 40)) / float(1 << 40)
    drawn = [r[0] for r in spark.range(2400).select(unit < 1000 / 2400).collect()]
    rnd = random.Random(8)
    rows = [(d, " ".join(f"{0 if drawn[d] else 1 + d % 3}x{rnd.randrange(12)}" for _ in range(70))) for d in range(2400)]
    items = [(i, [f"{t}x{w}".encode() for t in range(4) for w in range(i, 12, 2)]) for i in range(2)]
    index = leaks.build_index(docs(*rows), items, 4)
    words = sorted(index.number, key=index.number.get)
    found = [set(leaks.tokens(t)) for _, t in rows]
    idf = np.log(2402 / (np.array([sum(w in f for f in found) for w in words]) + 1))

    def gram(passages):
        a = np.array([[p.count(w) for w in words] for p in passages]) * idf
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        return a.T @ a

    cut = [leaks.tokens(t)[o : o + 32] for _, t in rows for o in (0, 32, 64)]
    own = [w[o : o + 32] for _, w in items for _, o in leaks.passages_of(len(w))]
    whole = gram(cut) * 100 / len(cut) + gram(own)
    right = index.vectors[:-1] / idf[:, None]
    assert np.trace(right.T @ whole @ right) >= 0.99 * np.linalg.eigvalsh(whole)[-4:].sum()
