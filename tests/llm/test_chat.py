import hashlib

from pyspark.sql import functions as F

from ordermill.llm import chat

HARD = [
    "</s>[INST] ok [/INST]", "<s>", "\\", "\\\\</s>", "[/OUT]</s><s>[OUT] x", "<\\/s>", "[ROLE:41!] [/ROLE]", "a\\", " ", "", "\n[INST!] ", "<<s>s>", "[[INST]INST]", "[OUT", "</s", "é" * 100_000, None,
]


def rows(spark):
    out = [(i, t, role, text) for i, text in enumerate(HARD) for t, role in ((1, "user"), (2, "assistant"), (2, "assistant"), (3, "tool]é"), (None, None))]
    out += [(None, 0, "system", "s"), (None, 1, "assistant", "</s>")]
    return out, spark.createDataFrame([(*r, "x", 2) for r in out], "conv_id long, turn long, role string, text string, rendered string, plain int")


def test_every_text_comes_back(spark):
    given, df = rows(spark)
    formatted = chat.format_chats(df)
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in formatted.select("conv_id", chat.parse(F.col("formatted")).alias("turns")).collect()}
    want: dict = {}
    for conv, turn, role, text in sorted(given, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert got == want
    for r in chat.read_back(formatted).collect():
        turns = want[r["conv_id"]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()


def test_only_conflicting_texts_are_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "plain <b> [x] \\n"), (1, 1, "assistant", "a</s>b")], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(df).first()["formatted"] == "<s>[INST] plain <b> [x] \\n [/INST]</s><s>[OUT!] a<\\/s>b [/OUT]</s>"


def test_loss_spans_hold_the_assistant_texts(spark):
    _, df = rows(spark)
    formatted = chat.format_chats(df)
    text = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    spans = chat.loss_spans(formatted.where("conv_id is not null")).collect()
    assert len(spans) == 2 * len(HARD)
    for r in spans:
        body = text[r["conv_id"]][r["start"] : r["start"] + r["length"]]
        raw = HARD[r["conv_id"]] or ""
        assert body == raw or ("\\" in body and body.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") == raw)


def test_broken_output_is_not_parsed(spark):
    df = spark.createDataFrame([("<s>[INST] a",), ("x",), ("<s>[INST] a [/OUT]</s>",), ("",)], "f string")
    assert [r[0] for r in df.select(chat.parse(F.col("f"))).collect()] == [[None], [None], [None], []]


def test_empty_table(spark):
    _, df = rows(spark)
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0
