"""SimHash near-duplicates: exact search of fingerprints within a few bits by vantage-point trees.

A vantage-point tree splits points by their distance from a chosen point; by the triangle inequality a pair within
`bits` of each other can only lie on both sides of a split at distance m if both are within `bits` of it. Over whole
64-bit fingerprints of unlike texts that prunes next to nothing, since all distances are near 32 and most points are
near every split. So the first level works in subspaces: of 4 + k blocks of bits, two fingerprints that differ in at
most 4 bits agree on at least k; restricted to such a choice of blocks they are at distance 0 from the same vantage
value, and no overlap is needed. Each choice and value is a shard. A shard of more than `limit` fingerprints (copies
with many small changes) is split by whole distance from a vantage point into rings; a fingerprint near the upper
border of its ring also visits the rings within reach. Inside a shard, a tree with the same bounds finds every pair.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import add_columns, ship, stage
from .components import components

BITS = 4
_LEAF = 96  # points of a tree's leaf, compared with each other directly
_DOCS_AT_ONCE = 256


def fingerprints_of(texts: list[str], words: int) -> np.ndarray:
    """SimHash of each text as an unsigned 64-bit number, over `words`-word shingles with repeats."""
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), np.uint64)
    for a in range(0, len(texts), _DOCS_AT_ONCE):
        hashes, sizes = [], []
        for t in texts[a : a + _DOCS_AT_ONCE]:
            parts = t.encode().lower().split()
            n = max(1, len(parts) - words + 1) if parts else 0
            if n > 1:
                joined = b" ".join(parts)
                ends = list(accumulate(map(len, parts), lambda x, y: x + y + 1))
                starts = [0, *[e + 1 for e in ends]]
                hashes += [xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, ends[words - 1 :])]
            elif n:
                hashes.append(xxh64_intdigest(b" ".join(parts), 42))
            sizes.append(n)
        size = np.array(sizes)
        some = np.flatnonzero(size)
        if len(some):
            h = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
            first = np.concatenate([[0], np.cumsum(size[some])])
            votes = np.empty((len(some), 64), np.int64)
            step = 1 << 17  # shingles unpacked at once
            for k, (s, e) in enumerate(zip(first[:-1], first[1:], strict=True)):
                votes[k] = sum(np.unpackbits(h[x : min(e, x + step)], axis=1).sum(axis=0, dtype=np.int64) for x in range(s, e, step))
            out[a + some] = np.packbits(2 * votes > size[some, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, words: int = 4, text: str = "text", fingerprint: str = "fp") -> DataFrame:
    """Add the SimHash of each text as a signed long. A-Z count as lower case; fewer words than a shingle: the whole
    sequence; no words, or a null text: 0. Other columns pass through; no shuffle."""
    ship(__name__)

    def run(frames):
        for frame in frames:
            got = fingerprints_of([t or "" for t in frame[text]], words)
            yield frame.drop(columns=[fingerprint], errors="ignore").assign(**{fingerprint: got.view(np.int64)})

    return docs.mapInPandas(run, add_columns(docs, f"`{fingerprint}` long"))


def masks(n: int, limit: int, bits: int = BITS) -> list[int]:
    """The bit masks of the first level for n fingerprints: each pair within `bits` agrees on at least one of them.

    One agreeing block (of bits + 1) while random fingerprints fill a shard to an eighth of the limit at most, then two
    (of bits + 2), and so on: more bits to a shard, more shards for each fingerprint.
    """
    agree = 1
    while n >> (64 * agree // (bits + agree)) > limit // 8 and agree < 5:
        agree += 1
    blocks = bits + agree
    edge = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]
    return [sum(c) for c in combinations(block, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shards(points: DataFrame, limit: int) -> DataFrame:
    """key, fp, home: every fingerprint in each of its shards; pairs within reach meet where at least one is at home."""
    choice = masks(points.count(), limit)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(choice)])
    out = points.select(F.explode(keys).alias("key"), "fp", F.lit(True).alias("home"))
    for level in range(6):
        seen = F.col("fp") if level == 0 else F.xxhash64(F.lit(level), "fp")
        big = out.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by("fp", seen).alias("vantage")).where(F.col("n") > limit)
        big = stage(big, "big-shards")
        if big.isEmpty():
            break
        out = stage(_rings(out, big, limit), "shards")
    return out


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _rings(rows: DataFrame, big: DataFrame, limit: int) -> DataFrame:
    """Split the big shards into rings of distance from their vantage point, with visitors from below the border."""
    from pyspark.sql import Window

    inside = rows.join(big, "key").withColumn("d", _distance(F.col("fp"), F.col("vantage")))
    upto = Window.partitionBy("key").orderBy("d")  # at most 65 rows a key
    ring = inside.groupBy("key", "d").agg(F.count(F.lit(1)).alias("n")).select("key", "d", F.floor((F.sum("n").over(upto) - 1) / limit).alias("ring"))
    ring = stage(ring, "rings")
    near = inside.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(BITS)))).select("key", "fp", "home", (F.col("d") + F.col("step")).alias("d"), "step")
    placed = near.join(ring, ["key", "d"]).groupBy("key", "ring", "fp").agg(F.min("step").alias("step"), F.max("home").alias("home"))
    own = placed.groupBy("key", "fp").agg(F.min("ring").alias("own"))
    placed = placed.join(own, ["key", "fp"]).select(F.xxhash64("key", "ring").alias("key"), "fp", (F.col("home") & (F.col("ring") == F.col("own"))).alias("home"))
    return rows.join(big.select("key"), "key", "left_anti").unionByName(placed)


class Links:
    """Groups of linked points of one shard; only a tree of links is kept."""

    def __init__(self, points: np.ndarray):
        self.points, self.root = points, np.arange(len(points))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            on = a != b
            if not on.any():
                return
            i, j, a, b = i[on], j[on], a[on], b[on]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def compare(self, i: np.ndarray, j: np.ndarray, same: bool) -> None:
        """Every pair of the two lists, some thousand rows of the comparison at a time."""
        step = max(1, 2_000_000 // max(1, len(j)))
        for s in range(0, len(i), step):
            x, y = np.nonzero(np.bitwise_count(self.points[i[s : s + step], None] ^ self.points[None, j]) <= BITS)
            if same:
                x, y = x[y > x + s], y[y > x + s]
            self.add(i[s : s + step][x], j[y])

    def within(self, i: np.ndarray) -> None:
        """All pairs of one list: a vantage point, its median distance, both sides, and what lies near the border."""
        if len(i) <= _LEAF:
            return self.compare(i, i, True)
        d = np.bitwise_count(self.points[i] ^ self.points[i[0]])
        m = int(np.sort(d)[len(d) // 2])
        if m == int(d.max()):
            m -= 1
        near, far = d <= m, d > m
        if not near.any() or not far.any():
            return self.compare(i, i, True)
        self.within(i[near])
        self.within(i[far])
        self.between(i[near & (d > m - BITS)], i[far & (d <= m + BITS)])

    def between(self, i: np.ndarray, j: np.ndarray) -> None:
        """All pairs across two lists, pruned by their distances from a vantage point of the first."""
        if not len(i) or not len(j):
            return
        if len(i) * len(j) <= _LEAF * _LEAF * 16:
            return self.compare(i, j, False)
        v = self.points[i[0]]
        di, dj = np.bitwise_count(self.points[i] ^ v).astype(np.int16), np.bitwise_count(self.points[j] ^ v).astype(np.int16)
        for d in np.unique(di).tolist():
            self.compare(i[di == d], j[np.abs(dj - d) <= BITS], False)


def links(points: DataFrame, limit: int = 4096) -> DataFrame:
    """a, b: links between different fingerprints (column fp) such that any two within BITS are connected by them."""
    ship(__name__)
    rows = shards(points, limit).repartition("key").sortWithinPartitions("key")

    def search(fp: np.ndarray, key: np.ndarray, home: np.ndarray) -> pd.DataFrame:
        found = []
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if e - s > 1:
                group, here = Links(fp[s:e]), home[s:e]
                group.within(np.flatnonzero(here))
                group.between(np.flatnonzero(here), np.flatnonzero(~here))
                tied = np.flatnonzero(group.root != np.arange(e - s))
                if len(tied):
                    found.append((fp[s:e][tied], fp[s:e][group.root[tied]]))
        a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    def run(frames):
        kept = None  # the shard that the next frame may go on with
        for frame in frames:
            if kept is not None:
                frame = pd.concat([kept, frame], ignore_index=True)
            key = frame["key"].to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if len(key) and key[0] != key[-1] else 0
            kept = frame.iloc[cut:]
            if cut:
                yield search(frame["fp"].to_numpy()[:cut].view(np.uint64), key[:cut], frame["home"].to_numpy()[:cut])
        if kept is not None and len(kept):
            yield search(kept["fp"].to_numpy().view(np.uint64), kept["key"].to_numpy(), kept["home"].to_numpy())

    return rows.mapInPandas(run, "a long, b long")


def rooted_rows(docs: DataFrame, words: int = 4, limit: int = 4096) -> tuple[DataFrame, DataFrame]:
    """All columns of docs but the text, with fp; and fp, root, component_id of every fingerprint.

    The root names a class, also one without any doc_id.
    """
    marked = stage(fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("long")), words).drop("text"), "fingerprints")
    points = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    tied = components(links(points.select("fp"), limit)).withColumnRenamed("a", "fp")
    rooted = stage(points.join(tied, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Written before the join with all documents: two plain inputs, so that Spark can split a fingerprint that many share.
    return marked, stage(rooted.join(least, "root").select("fp", "root", "component_id"), "owners")


def classes(docs: DataFrame, words: int = 4, limit: int = 4096) -> DataFrame:
    """doc_id, fp, component_id: each document's fingerprint and the least doc_id that links of at most 4 bits reach.

    Rows with equal doc_id each count; a class without any doc_id has a null component. Texts that are null or have no
    words share fingerprint 0 and link like others. Other columns are not used; an empty table gives an empty one.
    """
    marked, owner = rooted_rows(docs.select("doc_id", "text"), words, limit)
    return marked.join(owner, "fp").select("doc_id", "fp", "component_id")
