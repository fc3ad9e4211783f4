import hashlib
import random

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")

from ordermill.llm import pieces  # noqa: E402
from ordermill.llm.queries import piece_model  # noqa: E402

HARD = [
    "", " ", "  ", " a", "a ", "   a   b\n\n  c", "▁", "▁▁x", "<s>hi</s>", "\n\n\n", "漢字かな交じり文", "😀😀 x😀", "\t\ttab", "(  (  [ ", "x" * 300, "the" * 150,
    " " * 40, " " * 15 + "x", " " * 3000 + "漢", "�", "\0a\0 \0", " ", "🏳️‍🌈 naïve", "ΑΒΓ абв", "é", "a" * 5000 + " " + "é" * 500,
]


@pytest.fixture(scope="module")
def both():
    return pieces.Codec(pieces.load(piece_model())), sentencepiece.SentencePieceProcessor(model_file=piece_model())


def check(both, texts):
    codec, model = both
    for text, got in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(got, "<u4").tolist()
        assert ids == model.encode(text, add_bos=True, add_eos=True), text[:60]
        assert codec.decode(ids).decode() == model.decode(ids), text[:60]


def test_hard_texts_as_the_library(both):
    check(both, HARD)


def test_random_texts_as_the_library(both):
    rnd = random.Random(5)
    known = [p for p in both[0].v.pieces if p]
    check(both, ["".join(rnd.choices(known, k=rnd.randint(1, 30))) for _ in range(1500)])
    check(both, ["".join(rnd.choices("abetonis r ", k=rnd.randint(1, 200))) for _ in range(800)])
    check(both, ["".join(rnd.choices(["a", "b", " ", "  ", "é", "漢", "\n", "("], k=rnd.randint(1, 60))) for _ in range(800)])


def test_whole_documents_as_the_library(both, texts):
    check(both, list(texts.values()))


def test_forgetting_words_changes_nothing(both, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 3)
    for _ in range(2):
        check(both, ["one two three four five", "five six one", "two"])


def test_any_ids_decode_as_the_library(both):
    codec, model = both
    rnd = random.Random(2)
    for _ in range(500):
        ids = rnd.choices([1, 2, *range(3, 700), *range(29870, 31000)], k=rnd.randint(0, 12))
        assert codec.decode(ids).decode() == model.decode(ids), ids


def test_query_and_operators(spark, docs, both):
    rows = docs((1, None), (2, ""), (3, "Hello  world\n"), (3, "Hello  world\n"), (None, "é"))
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in pieces.digests(rows, piece_model()).collect()}
    want = set()
    for i, t in ((1, ""), (2, ""), (3, "Hello  world\n"), (None, "é")):
        ids = both[1].encode(t, add_bos=True, add_eos=True)
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(both[1].decode(ids).encode()).hexdigest()))
    assert got == want
    coded = pieces.encode(rows.withColumnRenamed("n", "ids"), piece_model())
    assert coded.columns[-1] == "ids" and coded.count() == 5
    back = pieces.decode(coded, piece_model()).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == [(0, "é"), (1, ""), (2, ""), (3, "Hello  world\n"), (3, "Hello  world\n")]
    assert pieces.digests(docs(), piece_model()).count() == 0
