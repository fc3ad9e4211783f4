import hashlib
import re
import time

from pyspark.sql import functions as F

from ordermill.llm import sketches

PARTS = re.compile(r"[^\n]{150,}?[.!?](?=\s)|[^\n]+")


def parts(text):
    return {p.strip(" ") for p in PARTS.findall(text)} - {""}


def like(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(like(parts(text), parts(edited)), 9), round(like(parts(text), parts(after)), 9)))
    return sorted(out, key=str)


def found(df, width=512):
    rows = df.select(
        "doc_id", "n_chars", "edited_sha256",
        F.round(sketches.likeness(F.col("keys"), F.col("edited_keys"), F.col("from_edited")), 9),
        F.round(sketches.likeness(F.col("keys"), F.col("next_keys"), F.col("from_next")), 9),
    )
    return sorted([tuple(r) for r in rows.collect()], key=str)


def test_against_sets_of_paragraphs(docs, texts):
    rows = list(texts.items())[:60] + [(10**12, "far\naway"), (-5, "é\n" * 3 + "b"), (7000, None), (7001, ""), (7002, "\n".join(f"line {i}" for i in range(700))), (5, texts[5]), (5, "other"), (None, "no id")]
    assert found(sketches.fingerprints(docs(*rows))) == expected(rows)


def test_one_document_follows_itself(docs):
    assert found(sketches.fingerprints(docs((3, "a\nb\nc\nd")))) == expected([(3, "a\nb\nc\nd")])


def test_ranges_link_up(docs):
    rows = [(i * 37 % 4001, f"text {i}\n{i % 7}") for i in range(200)]
    got = {r["doc_id"]: r["next_text"] for r in sketches.with_next(docs(*rows), width=16).collect()}
    order = sorted(rows, reverse=True)
    assert got == {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}


def test_peeling_names_the_digests(spark):
    a, b = list(range(100, 150)), list(range(120, 160))
    df = spark.createDataFrame([(a, b), ([], []), (a, []), (a, a)], "a array<long>, b array<long>")
    got = [{(x["k"], x["n"]) for x in r["d"]} for r in sketches.with_difference(df, "a", "b", "d").collect()]
    assert got == [{(x, 1) for x in range(100, 120)} | {(x, -1) for x in range(150, 160)}, set(), {(x, 1) for x in a}, set()]


def test_equal_texts_equal_fingerprints(docs):
    rows = sketches.fingerprints(docs((1, "a\nb"), (2, "a\nb"), (3, "a\nc"))).select("doc_id", sketches.as_text(F.col("cells")).alias("f")).collect()
    f = {r["doc_id"]: r["f"] for r in rows}
    assert f[1] == f[2] != f[3]


def test_empty_table(docs):
    assert sketches.fingerprints(docs((1, "a")).limit(0)).count() == 0


def test_digests_no_table_separates_are_compared_as_they_are(spark):
    close = [(1 << 60) + (i << 14) for i in range(9)]  # they differ in bits that no cell goes by
    df = spark.createDataFrame([(close[:6], close[3:])], "a array<long>, b array<long>")
    got = {(x["k"], x["n"]) for x in sketches.with_difference(df, "a", "b", "d").first()["d"]}
    assert got == {(k, 1) for k in close[:3]} | {(k, -1) for k in close[6:]}


def test_dealing_keeps_every_digest_in_small_blocks(spark):
    rows = spark.range(40_000).select(F.xxhash64("id").alias("k")).agg(F.collect_list("k").alias("a")).withColumn("b", F.slice("a", 20_001, 20_000))
    groups = rows.select(F.explode(sketches.dealt(F.col("a"), F.col("b"))).alias("g")).select("g.*").collect()
    first = rows.first()
    assert sorted(k for g in groups for k in g["a"]) == sorted(first["a"]) and sorted(k for g in groups for k in g["b"]) == sorted(first["b"])
    assert max(len(g["a"]) + len(g["b"]) for g in groups) < 600
    assert all({k for k in g["b"]} <= set(g["a"]) for g in groups)


def test_sparse_ids_link_up(docs):
    rows = [(i * 10**9 + i * i, f"text {i}") for i in range(60)] + [(None, "no id")]
    got = {r["doc_id"]: r["next_text"] for r in sketches.with_next(docs(*rows), width=1).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    assert got == {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}


def test_cost_grows_with_the_paragraphs(docs):
    def seconds(lines):
        two = [(d, "\n".join(f"{d} {i}" for i in range(lines))) for d in (1, 2)]
        begin = time.perf_counter()
        assert sketches.fingerprints(docs(*two)).select(F.max(F.size("from_next"))).first()[0] == 2 * lines
        return time.perf_counter() - begin

    seconds(100)
    assert seconds(16_000) <= 2.2 * seconds(8_000) + 2
