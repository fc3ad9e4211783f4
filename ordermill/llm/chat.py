"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is rendered as `<s>[TAG] text [/TAG]</s>` for each turn. The deterministic parser below reads that back:
a turn ends at `</s>`, and holds no control string but its own three. A turn is first rendered as it is and parsed; if
the parser does not give back exactly that role and text, the turn is rendered escaped (its tag then ends in `!`) and
must parse to the source. So most texts stay as they are, and conflicting ones are escaped reversibly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = {"user": "INST", "assistant": "OUT", "system": "SYS"}  # any other role: ROLE:<its UTF-8 bytes in hex>
_TAG = r"(?:INST|OUT|SYS|ROLE:[0-9A-F]*)"
_AFTER = rf"(?:/?s>|{_TAG}!?\]|/(?:INST|OUT|SYS|ROLE)\])"  # what follows the first sign of a control string
CONTROL = rf"[<\[]{_AFTER}"
END = "</s>"


def escape(text: Column) -> Column:
    """Double each backslash, then put one after the first sign of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])(?={_AFTER})", r"$1\\")


def unescape(text: Column) -> Column:
    """Take one backslash away wherever `escape` has added one."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _tag(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in TAGS.items() for x in pair])
    return F.coalesce(known[role], F.concat(F.lit("ROLE:"), F.hex(F.encode(role, "UTF-8"))))


def render_turn(role: Column, text: Column, escaped: bool) -> Column:
    tag = _tag(role)
    body = escape(text) if escaped else text
    mark = F.lit("!" if escaped else "")
    return F.concat(F.lit("<s>["), tag, mark, F.lit("] "), body, F.lit(" [/"), F.substring_index(tag, ":", 1), F.lit("]"), F.lit(END))


def parse(formatted: Column) -> Column:
    """Turns as `array<struct<role, text>>`; a turn that breaks the grammar is a null in the array."""
    known = F.create_map(*[F.lit(x) for role, tag in TAGS.items() for x in (tag, role)])

    def turn(part: Column) -> Column:
        head = F.regexp_extract(part, rf"^<s>\[{_TAG}!?\] ", 0)
        tag = F.regexp_extract(head, _TAG, 0)
        tail = F.concat(F.lit(" [/"), F.substring_index(tag, ":", 1), F.lit("]"))
        body = F.substr(part, F.length(head) + 1, F.length(part) - F.length(head) - F.length(tail))
        role = F.coalesce(known[tag], F.decode(F.unhex(F.substr(tag, F.lit(6))), "UTF-8"))
        sound = (F.length(head) > 0) & F.endswith(part, tail) & (F.length(part) >= F.length(head) + F.length(tail)) & (F.regexp_count(part, F.lit(CONTROL)) == 3)
        text = F.when(F.endswith(head, F.lit("!] ")), unescape(body)).otherwise(body)
        return F.when(sound, F.struct(role.alias("role"), text.alias("text")))

    parts = F.split(formatted, END)
    whole = F.when(F.endswith(formatted, F.lit(END)), F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.transform(F.when(formatted == "", F.array().cast("array<string>")).otherwise(whole), turn)


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, formatted: one text for each conversation, from rows (conv_id, turn, role, text).

    Rows go by turn; equal turns by role and text, null turns first, repeated rows are kept as turns. A null text or
    role counts as empty, rows with a null conv_id form one conversation. Columns besides these four are not used. An
    empty table gives an empty one. All work on texts is done turn by turn, before the shuffle; the one value per
    conversation that the result asks for is put together from the rendered turns alone.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    plain = rows.select("conv_id", F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).withColumn("plain", render_turn(F.col("role"), F.col("text"), False))
    back = lambda c: F.coalesce(parse(c) == F.array(F.struct("role", "text")), F.lit(False))
    sure = plain.withColumn("rendered", F.when(back(F.col("plain")), F.col("plain")).otherwise(render_turn(F.col("role"), F.col("text"), True)))
    sure = sure.withColumn("rendered", F.when(back(F.col("rendered")), F.col("rendered")).otherwise(F.raise_error(F.concat(F.lit("no round trip: "), "rendered"))))
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered")))
    return sure.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t["rendered"]), "").alias("formatted"))


def loss_spans(formatted: DataFrame) -> DataFrame:
    """conv_id, start, length (code points of `formatted`, as rendered): where each assistant text stands, in order."""
    from pyspark.sql import Window

    parts = formatted.select("conv_id", F.posexplode(F.split("formatted", END)).alias("n", "part")).where(F.col("part") != "")
    before = F.sum(F.length("part") + len(END)).over(Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    head = F.regexp_extract("part", r"^<s>\[OUT!?\] ", 0)
    placed = parts.withColumn("start", F.coalesce(before, F.lit(0)) + F.length(head)).where(F.length(head) > 0)
    return placed.select("conv_id", "start", (F.length("part") - F.length(head) - len(" [/OUT]")).alias("length"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the parser recovers from formatted conversations."""
    turns = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"))
    turns = turns.select("conv_id", "formatted", F.transform("turns", lambda t: F.when(t.isNotNull(), t).otherwise(F.raise_error(F.lit("broken turn")).cast("struct<role:string,text:string>"))).alias("turns"))
    all_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(all_text, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
