"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions only.

A text is a set of paragraph digests. Three hash functions put each digest into one cell of each third of a small
table; a cell keeps how many came, the xor of the digests and the xor of their checks. Two tables subtract cell by
cell, which leaves the digests only one text has. A cell that holds a single one (count 1 or -1, check right) gives it
away; taking it out of its other cells frees more of them. If that stops early, both tables are made larger.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import sorted_runs
from .base import stage

# A paragraph is a line; a longer one is cut at the first sentence end after so many characters.
LONG_LINE = 150
SIDE = 8  # cells in each third of the fingerprint that is kept
_ROUNDS = 12
_BLOCK = 512  # digests
_FREE_BITS = (14, 17, 35, 38, 56, 59)  # three each; cells go by the bits from 0, 21 and 42 on, fourteen at most
_FOUND = "array<struct<n:int,k:long>>"
_CELLS = "array<struct<n:int,k:long,h:long>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text; blank paragraphs do not count, a paragraph's repeats count once."""
    parts = F.regexp_extract_all(text, F.lit(rf"[^\n]{{{LONG_LINE},}}?[.!?](?=\s)|[^\n]+"), F.lit(0))
    return F.array_distinct(F.transform(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""), lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(1))


def _cell(key: Column, third: int, side: Column) -> Column:
    """Where a digest goes in one third of the table: other bits of it for each third."""
    return F.pmod(F.shiftrightunsigned(key, 21 * third), side)


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(v))


def sketch(keys: Column, side: Column) -> Column:
    """The table of a set of digests: 3 * side cells of (count, xor of digests, xor of checks)."""

    def third(j: int) -> Column:
        members = F.transform(F.sequence(F.lit(0).cast("long"), side - 1), lambda c: F.filter(keys, lambda k: _cell(k, j, side) == c))
        return F.transform(members, lambda m: F.struct(F.size(m).alias("n"), _xor(m).alias("k"), _xor(F.transform(m, lambda k: _check(k))).alias("h")))

    return F.concat(third(0), third(1), third(2))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["h"].bitwiseXOR(y["h"]).alias("h")))


def peel(cells: Column, side: Column) -> Column:
    """struct<cells, found>: the digests recovered from a difference (n: 1 only in the first, -1 only in the second)."""

    def pure(cells: Column) -> Column:
        alone = F.filter(cells, lambda c: ((c["n"] == 1) | (c["n"] == -1)) & (_check(c["k"]) == c["h"]))
        where = lambda k: [(_cell(k, j, side) + j * side).alias(f"p{j}") for j in range(3)]
        return F.array_distinct(F.transform(alone, lambda c: F.struct(c["n"].alias("n"), c["k"].alias("k"), *where(c["k"]))))

    def without(cells: Column, found: Column) -> Column:
        def cleared(c: Column, i: Column) -> Column:
            here = F.filter(found, lambda f: (f["p0"] == i) | (f["p1"] == i) | (f["p2"] == i))
            return F.aggregate(here, c, lambda a, f: F.struct((a["n"] - f["n"]).alias("n"), a["k"].bitwiseXOR(f["k"]).alias("k"), a["h"].bitwiseXOR(_check(f["k"])).alias("h")))

        return F.transform(cells, cleared)

    def step(state: Column, _: Column) -> Column:
        def on(found: Column) -> Column:
            names = F.transform(found, lambda f: F.struct(f["n"].alias("n"), f["k"].alias("k")))
            return F.when(F.size(found) == 0, state).otherwise(F.struct(without(state["cells"], found).alias("cells"), F.concat(state["found"], names).alias("found")))

        return let(pure(state["cells"]), on)

    start = F.struct(cells.cast(_CELLS).alias("cells"), F.array().cast(_FOUND).alias("found"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), start, step)


def _complete(tried: Column) -> Column:
    return ~F.exists(tried["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0))


def _group(a: Column, b: Column) -> Column:
    """The difference of two small sets, from tables that grow until peeling is complete.

    Digests that no table separates (they share all the bits it goes by) are compared as they are.
    """

    def attempt(side: int) -> Column:
        if side > 1 << 14:
            only = lambda x, y, n: F.transform(F.array_except(x, y), lambda k: F.struct(F.lit(n).alias("n"), k.alias("k")))
            return F.concat(only(a, b, 1), only(b, a, -1)).cast(_FOUND)
        s = F.lit(side).cast("long")
        return let(peel(subtract(sketch(a, s), sketch(b, s)), s), lambda t: F.when(_complete(t), t["found"]).otherwise(attempt(8 * side)))

    return attempt(2 * SIDE)


def dealt(a: Column, b: Column) -> Column:
    """Both sets in blocks of at most about 512 digests together: an array of struct<a, b>.

    Each level deals every block into eight by three more bits of the digest, none of which a table's cells go by. So a
    digest is looked at eight times a level, and there are as many levels as the logarithm of the digests; most texts
    need none.
    """
    levels = F.ceil(F.log(8.0, F.greatest(F.lit(1.0), (F.size(a) + F.size(b)) / float(_BLOCK))))
    groups = F.array(F.struct(a.alias("a"), b.alias("b")))

    def split(groups: Column, shift: int) -> Column:
        def part(keys: Column, i: Column) -> Column:
            return F.filter(keys, lambda k: F.shiftrightunsigned(k, shift).bitwiseAND(F.lit(7).cast("long")) == i)

        digits = F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))
        return F.flatten(F.transform(groups, lambda g: F.transform(digits, lambda i: F.struct(part(g["a"], i).alias("a"), part(g["b"], i).alias("b")))))

    def down(groups: Column, level: int) -> Column:
        return let(groups, lambda g: F.when(levels > level, split(g, _FREE_BITS[level])).otherwise(g))

    return reduce(down, range(len(_FREE_BITS)), groups)


def with_difference(df: DataFrame, a: str, b: str, name: str, a_cells: str | None = None, b_cells: str | None = None) -> DataFrame:
    """Add the digests in which the sets a and b differ, by subtracting and peeling their tables.

    The first try uses the kept fingerprints (`a_cells`, `b_cells`). Where they are too small, larger tables follow: the
    digests are dealt into blocks, and a block into so many groups that each has a few, with a table of its own that is
    enlarged until it can be peeled. So the work grows with the number of digests, not with its square.
    """
    fixed = F.lit(SIDE).cast("long")
    first = subtract(F.col(a_cells) if a_cells else sketch(F.col(a), fixed), F.col(b_cells) if b_cells else sketch(F.col(b), fixed))
    df = df.withColumn(name, let(peel(first, fixed), lambda t: F.when(_complete(t), t["found"])))

    def block(g: Column) -> Column:
        groups = F.greatest(F.lit(1), F.ceil((F.size(g["a"]) + F.size(g["b"])) / (2 * SIDE))).cast("long")
        of = lambda keys, i: F.filter(keys, lambda k: F.pmod(F.shiftrightunsigned(k, 11), groups) == i)
        each = F.sequence(F.lit(0).cast("long"), groups - 1)
        return F.flatten(F.transform(each, lambda i: let(of(g["a"], i), lambda x: let(of(g["b"], i), lambda y: _group(x, y)))))

    each = F.transform(dealt(F.col(a), F.col(b)), block)
    return df.withColumn(name, F.when(F.col(name).isNotNull(), F.col(name)).otherwise(F.flatten(each)))


def likeness(a: Column, b: Column, difference: Column) -> Column:
    """Shared digests over all digests of two sets, from their sizes and their difference; 1 for two empty sets."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - F.size(difference)) / (both + F.size(difference)))


def as_text(cells: Column) -> Column:
    """A table as a string: count, digests and checks of each cell in hexadecimal digits."""
    return F.lower(F.array_join(F.transform(cells, lambda c: F.concat_ws(".", F.hex(c["n"]), F.hex(c["k"]), F.hex(c["h"]))), "-"))


def with_next(docs: DataFrame, width: int = 512) -> DataFrame:
    """doc_id, text, keys, next_text, next_keys: each document with the one after it by descending doc_id.

    The last is followed by the first; equal doc_ids go by descending text, rows without a doc_id come last. Documents
    are dealt out by ranges of `width` ids, and the first of each range is sent to the range before as a guest. The
    ranges are linked through sorted runs of their numbers, so ids may be as sparse as they like. Rows of one repeated
    doc_id, and those without any, share a range.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("bucket", F.coalesce(F.floor(F.col("doc_id") / width), F.lit(-(1 << 62))).cast("long"))
    heads = sorted_runs(rows.groupBy("bucket").agg(F.max("doc_id").alias("head")), [], ["bucket"])  # one row a range
    runs = heads.groupBy("_run").agg(F.min("bucket").alias("least"))  # MAX_RUNS rows at most
    # The next range up holds the host; past a run's end it is the first one of the next run, and past the very last
    # range the very first one.
    above = runs.select("_run", F.lead("least").over(Window.orderBy("_run")).alias("above"))
    lowest = runs.agg(F.min("least")).first()[0]
    up = F.lead("bucket").over(Window.partitionBy("_run").orderBy("bucket"))
    linked = heads.join(F.broadcast(above), "_run").select("bucket", "head", F.coalesce(up, "above", F.lit(lowest)).alias("host"))
    linked = stage(linked, "range-links")
    # the first document of a range: of rows with its largest id, the one with the greatest text
    first = rows.join(linked, (rows["bucket"] == linked["bucket"]) & rows["doc_id"].eqNullSafe(linked["head"])).groupBy("host").agg(F.max("text").alias("text"))
    guests = first.select(F.col("host").alias("bucket"), F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("guest"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    placed = rows.withColumn("guest", F.lit(False)).unionByName(guests).withColumn("keys", digests(F.col("text")))
    placed = placed.withColumns({"next_text": F.lead("text").over(order), "next_keys": F.lead("keys").over(order)})
    return placed.where(~F.col("guest")).select("doc_id", "text", "keys", "next_text", "next_keys")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document, its edited text (the last third replaced by the beginning of the next document) and both
    fingerprints, with the digests in which it differs from its edited text and from the next document.

    A null text counts as empty; texts without paragraphs have an empty table and are alike to each other. Other
    columns are not used; an empty table gives an empty one.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text")).withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
    rows = rows.withColumn("edited", F.concat(F.left("text", F.col("n_chars") - F.col("cut")), F.left("next_text", F.col("cut"))))
    rows = rows.withColumns({"edited_keys": digests(F.col("edited")), "edited_sha256": F.sha2("edited", 256)}).drop("text", "next_text", "edited", "cut")
    side = F.lit(SIDE).cast("long")
    rows = rows.withColumns({"cells": sketch(F.col("keys"), side), "edited_cells": sketch(F.col("edited_keys"), side), "next_cells": sketch(F.col("next_keys"), side)})
    rows = with_difference(rows, "keys", "edited_keys", "from_edited", "cells", "edited_cells")
    return with_difference(rows, "keys", "next_keys", "from_next", "cells", "next_cells")
