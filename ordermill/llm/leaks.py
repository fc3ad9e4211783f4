"""Benchmark decontamination by latent semantic retrieval and alignment.

Benchmark items are cut into segments that overlap by half, these into passages of 16 or 32 words. A randomised singular value
decomposition of the TF-IDF vectors of these passages and of the passages of all documents gives every benchmark word a
short latent vector; document frequencies are counted over all documents too. Each document is then read
once more: windows of 16 and 32 words, half of that apart, get the sum of their words' vectors, and those whose cosine
with a passage reaches `least_cosine` are aligned: the longest common subsequence of segment and region must hold most
of the segment's words and half of their weight; of an item's last segment also half of its end, where the answer stands.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import new_key, once, send, ship, text_blocks

SEGMENT = 64
SIZES = (16, 32)
_STEP = 8  # words summed first; windows are 2 or 4 of these sums
_WORDS_AT_ONCE = 30_000
_ITEMS_AT_ONCE = 2000
_PASSAGES_AT_ONCE = 1024
_WORDS_A_SUM = 4_000_000  # of a task that sums; what it passes on has the size of the vocabulary by the rank
_SLOT = 256  # words that are summed together over all tasks
_FIXED = float(1 << 24)  # sums are of whole numbers, so their order does not matter
_PUNCTUATION = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "replace").translate(_PUNCTUATION).split()


@dataclass
class Index:
    """A block of the benchmark: its words, their latent vectors, its passages."""

    number: dict[bytes, int]
    vectors: np.ndarray  # words + 1 (unknown) by rank; idf times right singular vectors
    weight: np.ndarray  # squared idf by word, the last for unknown words
    segments: list[tuple[int, np.ndarray]]  # item, word numbers
    last: list[bool]  # whether the segment is the end of its item
    passages: dict[int, tuple[np.ndarray, np.ndarray]]  # size: latent unit vectors, (segment, offset)
    fill: float  # share of a window's norm that its latent norm has at least in the cosine


def segments_of(words: list[bytes]) -> list[list[bytes]]:
    """A text's words in parts of SEGMENT words, at most half of that apart; any run of 1.5 SEGMENT words holds a whole one."""
    more = -(-max(0, len(words) - SEGMENT) // (SEGMENT // 2))
    starts = [(len(words) - SEGMENT) * i // more for i in range(more + 1)] if more else [0]
    return [words[s : s + SEGMENT] for s in starts] if words else []


def passages_of(n: int) -> list[tuple[int, int]]:
    """(size, offset) of the passages that cover a segment of n words; a shorter one is a passage itself."""
    size = SIZES[1] if n >= SIZES[1] else SIZES[0]
    return [(size, o) for o in sorted({*range(0, max(1, n - size + 1), size), max(0, n - size)})]


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at `first`: one addition for the j-th rows of all runs that have one."""
    size = np.diff(np.append(first, len(rows)))
    order = np.argsort(-size, kind="stable")
    begin, size = first[order], size[order]
    out, j, many = np.zeros((len(first), rows.shape[1]), rows.dtype), 0, len(first)
    while many >= 32:
        out[:many] += rows.take(begin[:many] + j, axis=0)
        j += 1
        many = int(np.searchsorted(-size, -j))
    for i in range(many):
        out[i] += rows[begin[i] + j : begin[i] + size[i]].sum(axis=0)
    back = np.empty_like(out)
    back[order] = out
    return back


def _image(ids: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) of the TF-IDF rows A, each of length one, of some passages: rows of word numbers, -1 for none."""
    total = np.zeros(basis.shape)
    weight = np.append(idf, 0.0).astype(np.float32)
    worth = (idf[:, None] * basis).astype(np.float32)
    for a in range(0, len(ids), _PASSAGES_AT_ONCE):
        x = ids[a : a + _PASSAGES_AT_ONCE]
        x = x[(x >= 0).any(axis=1)].astype(np.int32)
        if not len(x):
            continue
        times = (x[:, :, None] == x[:, None, :]).sum(axis=2, dtype=np.int8)
        square = (times * weight[x] ** 2).sum(axis=1)
        known = x >= 0
        word, size = x[known], known.sum(axis=1)
        some = _sums(worth.take(word, axis=0), np.cumsum(size) - size) / np.maximum(square, 1e-9)[:, None]
        at = np.argsort(word, kind="stable")
        word = word[at]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        total[word[first]] += _sums(some.take(np.repeat(np.arange(len(x)), size)[at], axis=0), first)
    return total * idf[:, None]


def _padded(passages: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(passages), SIZES[1]), -1)
    for i, x in enumerate(passages):
        out[i, : len(x)] = x
    return out


def build_index(docs: DataFrame, items: list[tuple[int, list[bytes]]], rank: int) -> Index:
    """The index of one block of items; what comes to the driver has the size of the block's vocabulary."""
    ship(__name__)
    spark = docs.sparkSession
    vocabulary = sorted({w for _, words in items for w in words})
    sent, key = send(spark, vocabulary), new_key("leak-words")

    def frequencies(frames):
        known, found, n, length = once("leaks.words", key, lambda: frozenset(sent())), Counter(), 0, 0
        for frame in frames:
            for text in frame["text"]:
                words = tokens(text)
                found.update(known.intersection(words))
                n, length = n + 1, length + len(words)
        yield pd.DataFrame({"word": pd.Series([*found, b"", b" "], dtype=object), "n": pd.Series([*found.values(), n, length], dtype="int64")})

    df = {bytes(r["word"]): r["n"] for r in docs.select("text").mapInPandas(frequencies, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    n_docs, n_words = df.get(b"", 0), df.get(b" ", 0)
    idf = np.log((n_docs + 2) / (np.array([df.get(w, 0) for w in vocabulary]) + 1))
    number = {w: i for i, w in enumerate(vocabulary)}
    parts = [(item, segments_of(words)) for item, words in items]
    segments = [(item, np.array([number[w] for w in s], np.int64)) for item, some in parts for s in some]
    last = [i == len(some) - 1 for _, some in parts for i in range(len(some))]
    places = [(size, k, o) for k, (_, s) in enumerate(segments) for size, o in passages_of(len(s))]
    own = [segments[k][1][o : o + size] for size, k, o in places]

    rank = min(rank, len(vocabulary))
    right = _leading(docs, number, idf, _padded(own), min(rank + 16, len(vocabulary)), n_words)[:, :rank]

    vectors = np.concatenate([idf[:, None] * right, np.zeros((1, rank))]).astype(np.float32)
    weight = np.concatenate([idf**2, [np.log(n_docs + 2) ** 2]]).astype(np.float32)
    latent = np.array([vectors[x].sum(axis=0) for x in own]).reshape(len(own), rank)
    size = np.linalg.norm(latent, axis=1)
    share = size / np.sqrt([max(weight[x].sum(), 1e-9) for x in own])
    unit = (latent / np.maximum(size, 1e-9)[:, None]).astype(np.float32)
    passages = {}
    for s in SIZES:
        at = [i for i, p in enumerate(places) if p[0] == s]
        passages[s] = (np.ascontiguousarray(unit[at].T), np.array([places[i][1:] for i in at], np.int64).reshape(-1, 2))
    return Index(number, vectors, weight, segments, last, passages, 0.6 * float(np.median(share)) if len(share) else 0.5)


def _leading(docs: DataFrame, number: dict[bytes, int], idf: np.ndarray, own: np.ndarray, width: int, n_words: int) -> np.ndarray:
    """Leading right singular vectors of the passages of the benchmark and of all documents, which weigh as 100 passages.

    One pass over the documents multiplies a random start by A'A; from that image comes the approximation of A'A with the
    start's width (Nystrom's). A start drawn towards the benchmark, or a second pass, finds fewer leaks: vectors that fit the
    benchmark's passages closely fit windows that begin elsewhere less.
    """
    start, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((len(number), width)))
    image = _gram(docs, number, idf, start, n_words) + _image(own, idf, start)
    shift = 1e-7 * np.linalg.norm(image)
    image = image + shift * start
    core = start.T @ image
    value, turn = np.linalg.eigh((core + core.T) / 2)
    return np.linalg.svd(image @ (turn / np.sqrt(np.maximum(value, max(shift, 1e-12)))), full_matrices=False)[0]


def _gram(docs: DataFrame, number: dict[bytes, int], idf: np.ndarray, basis: np.ndarray, n_words: int) -> np.ndarray:
    """A'(A basis) over the passages of all documents, weighted as 100 passages: tasks sum parts, then slots of words are summed."""
    sent, key = send(docs.sparkSession, (number, idf, basis)), new_key("leak-gram")
    width = basis.shape[1]

    def part(frames):
        number, idf, basis = once("leaks.gram", key, sent)
        total, n = np.zeros_like(basis), 0
        for frame in frames:
            for block in text_blocks(frame, "text"):
                held = []
                for text in block["text"]:
                    ids = [number.get(w, -1) for w in tokens(text)]
                    held.append(np.array(ids + [-1] * (-len(ids) % SIZES[1]), np.int64))
                x = np.concatenate(held).reshape(-1, SIZES[1])
                total, n = total + _image(x, idf, basis), n + len(x)
        if n:
            whole = np.rint(total * _FIXED).astype(np.int64)
            slots = range(0, len(whole), _SLOT)
            yield pd.DataFrame({"slot": [s // _SLOT for s in slots], "n": n, "total": [whole[s : s + _SLOT].tobytes() for s in slots]})

    def summed(frames):
        held: dict[int, list] = {}
        for frame in frames:
            for slot, n, total in zip(frame["slot"], frame["n"], frame["total"], strict=True):
                before = held.get(slot, (0, 0))
                held[slot] = (before[0] + n, before[1] + np.frombuffer(total, np.int64))
        if held:
            yield pd.DataFrame({"slot": list(held), "n": [n for n, _ in held.values()], "total": [t.tobytes() for _, t in held.values()]})

    schema = "slot long, n long, total binary"
    parts = docs.select("text").coalesce(1 + n_words // _WORDS_A_SUM).mapInPandas(part, schema)
    sums = parts.repartition(1 + len(number) // _SLOT, "slot").mapInPandas(summed, schema).collect()  # the vocabulary by the width
    if not sums:
        return np.zeros_like(basis)
    total = np.concatenate([np.frombuffer(r["total"], np.int64) for r in sorted(sums, key=lambda r: r["slot"])])
    return total.reshape(-1, width) * (100 / _FIXED / sums[0]["n"])


def common(masks: dict[int, int], n: int, region: list[int], least: float) -> int:
    """Positions of a segment (as bits) that are in a longest common subsequence with the region; set bits mark them.

    Nothing, if the region has fewer than `least` of the segment's words in any order.
    """
    held = [m for m in map(masks.get, region) if m]
    if len(held) < least:
        return 0
    full = (1 << n) - 1
    v = full
    for m in held:
        u = v & m
        v = ((v + u) | (v - u)) & full
    return full & ~v


class Finder:
    def __init__(self, index: Index, least_cosine: float, least_common: float):
        self.index, self.least_cosine, self.least_common = index, least_cosine, least_common
        self.sizes = np.array([len(ids) for _, ids in index.segments])
        worth = [np.sqrt(index.weight[ids]) for _, ids in index.segments]
        self.worth = [w / max(w.sum(), 1e-9) for w in worth]  # frequent words alone must not make a match
        self.masks: list[dict[int, int]] = []
        for _, ids in index.segments:
            m: dict[int, int] = {}
            for i, t in enumerate(ids.tolist()):
                m[t] = m.get(t, 0) | 1 << i
            self.masks.append(m)

    def find(self, texts: list[str]) -> list[dict[int, tuple[float, float, int]]]:
        """For each text: item -> (share of the segment in common, cosine, first word of the region)."""
        out: list[dict[int, tuple[float, float, int]]] = [{} for _ in texts]
        unknown = len(self.index.number)
        get = self.index.number.get
        begin, ids, held, total = [], [], [], 0
        for i, text in enumerate(texts):
            x = [get(w, unknown) for w in tokens(text)]
            pad = SIZES[-1] + -len(x) % _STEP
            begin.append((i, total, len(x)))
            ids.append(x)
            held.append(np.array(x + [unknown + 1] * pad, np.int64))
            total += len(x) + pad
            if total >= _WORDS_AT_ONCE or i == len(texts) - 1:
                self._search(np.concatenate(held), begin, ids, out)
                begin, ids, held, total = [], [], [], 0
        return out

    def _search(self, ids: np.ndarray, begin: list[tuple[int, int, int]], words: list[list[int]], out: list) -> None:
        index = self.index
        starts = np.array([b for _, b, _ in begin])
        vectors = np.concatenate([index.vectors, np.zeros((1, index.vectors.shape[1]), np.float32)])
        weight = np.append(index.weight, np.float32(0))
        for a in range(0, len(ids), 4 * _WORDS_AT_ONCE):  # one long text is read in overlapping parts
            part = ids[a : a + 4 * _WORDS_AT_ONCE + SIZES[-1]]
            sums = vectors[part].reshape(-1, _STEP, vectors.shape[1]).sum(axis=1)
            norms = weight[part].reshape(-1, _STEP).sum(axis=1)
            for size, (unit, place) in index.passages.items():
                k, every = size // _STEP, size // (2 * _STEP)
                n = len(sums) - k + 1
                if not len(place) or n <= 0:
                    continue
                window = sum(sums[j : n + j : every] for j in range(k))
                norm = np.sqrt(sum(norms[j : n + j : every] for j in range(k)))
                own = np.maximum(np.linalg.norm(window, axis=1), index.fill * norm) + np.float32(1e-9)
                cosine = (window / own[:, None]) @ unit
                w, p = np.divmod(np.flatnonzero(cosine >= self.least_cosine), len(place))
                if not len(w):
                    continue
                at = a + w * (every * _STEP)
                d = np.searchsorted(starts, at, side="right") - 1
                segment, offset = place[p].T
                shift = at - starts[d] - offset  # where the segment would begin in its document
                near = cosine[w, p]
                # of candidates that would align the same segment with the same region, the nearest one
                key = np.stack([d, segment, shift // self.sizes[segment]])
                order = np.lexsort([-near, *key])
                first = np.ones(len(order), bool)
                first[1:] = (key[:, order][:, 1:] != key[:, order][:, :-1]).any(axis=0)
                for i in order[first].tolist():
                    self._align(out[begin[d[i]][0]], words[d[i]], int(shift[i]), int(segment[i]), float(near[i]))

    def _align(self, found: dict, words: list[int], shift: int, segment: int, cosine: float) -> None:
        item, ids = self.index.segments[segment]
        n = len(ids)
        slack = n // 4 + _STEP
        begin = max(0, shift - slack)
        held = common(self.masks[segment], n, words[begin : max(0, shift) + n + slack], self.least_common * n)
        share = held.bit_count() / n
        rare = float(self.worth[segment] @ [held >> i & 1 for i in range(n)]) if held else 0.0
        tail = max(1, n // 4)
        answer = (held >> (n - tail)).bit_count() / tail if self.index.last[segment] else 1.0
        enough = share >= self.least_common and answer >= 0.5 and rare >= 0.5 if n >= 8 else held.bit_count() == n
        if enough and share > found.get(item, (0.0,))[0]:
            found[item] = (share, min(1.0, cosine), begin)


def find_leaks(docs: DataFrame, benchmark: DataFrame, least_cosine: float = 0.45, least_common: float = 0.7, rank: int = 96) -> DataFrame:
    """doc_id, contaminated, item_ids, common, cosine: one row per document (doc_id, text).

    item_ids are the items (item_id, text) found in it, in order; common and cosine belong to the item it holds most of
    (null without any). Null or empty texts and items hold nothing. The benchmark is taken in blocks of a bounded number
    of items, each a pass over the documents; its size is counted first. Other columns are not used.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    search = _search(docs, benchmark, least_cosine, least_common, rank)

    def run(frames):
        for frame in frames:
            for block in text_blocks(frame, "text"):
                found = search(block["text"])
                best = [max(f.values(), default=(None, None)) for f in found]
                yield pd.DataFrame({
                    "doc_id": block["doc_id"],
                    "contaminated": [bool(f) for f in found],
                    "item_ids": [sorted(f) for f in found],
                    "common": [b[0] for b in best],
                    "cosine": [b[1] for b in best],
                })

    return docs.mapInPandas(run, "doc_id long, contaminated boolean, item_ids array<long>, common double, cosine double")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least_cosine: float = 0.45, least_common: float = 0.7, rank: int = 96) -> DataFrame:
    """The rows of docs, all columns, without those in which `find_leaks` finds an item."""
    search = _search(docs, benchmark, least_cosine, least_common, rank)

    def run(frames):
        for frame in frames:
            for block in text_blocks(frame, "text"):
                yield block[[not f for f in search(block["text"])]]

    return docs.mapInPandas(run, docs.schema)


def _search(docs: DataFrame, benchmark: DataFrame, least_cosine: float, least_common: float, rank: int):
    """A function for tasks: the items found in each of some texts."""
    ship(__name__)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    blocks = 1 + items.count() // _ITEMS_AT_ONCE
    finders = []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()  # bounded by the block
        some = [(r["item_id"], words) for r in block if (words := tokens(r["text"]))]
        if some:
            finders.append((send(docs.sparkSession, build_index(docs, some, rank)), new_key("leaks")))

    def search(texts) -> list[dict]:
        texts = [t or "" for t in texts]
        found: list[dict] = [{} for _ in texts]
        for i, (sent, key) in enumerate(finders):
            finder = once(f"leaks.finder-{i}", key, lambda sent=sent: Finder(sent(), least_cosine, least_common))
            for into, got in zip(found, finder.find(texts), strict=True):
                into.update(got)
        return found

    return search
