"""Language-model scoring with back-off over words.

Every word, pair and triple of the training documents is counted; those seen `least` times (words: once) stay, at any
size of the input. An n-gram is named by a 64-bit number made from the hashes of its words, so rare words are in pairs
and triples like all others. A context is a state of a back-off automaton: an n-gram is an arc with its discounted
probability, and the failure arc leads to the shorter context with the weight that makes the probabilities of a state
sum to one. At the root, a word's probability is the add-half share over all words and one unknown word.

Texts go in blocks of some million tokens, with words numbered in each block. The different n-grams of a block are dealt to
buckets by their numbers, sorted and packed; each bucket adds up the counts of all blocks and tells each block the whole ones.
Words and pairs go in a first round, triples in a second: only those whose two pairs were seen `least` times, as no other
triple can have been. As an n-gram's parts are in its own block, a block then knows the probabilities of all its arcs. Of each
n-gram one block is named that adds its count to its context's sums; those of all blocks, again by buckets, give the context's
weight. With both, a block follows the states of its texts, all tokens at once: where a state has no arc for the next word, it
takes the weight and the failure arc.
`Automaton`, `assemble` and `count_grams` are the same model in memory, for a bounded number of n-grams.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from itertools import count
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import new_key, once, send, ship, stage, text_blocks

END = ""  # the token after the last word; words are never empty
DISCOUNT = 0.6
_BLOCK_TOKENS = 4_000_000
_CANDIDATES_AT_ONCE = 1_000_000
_LOCAL = 0.5  # of the share: what a block names
_COUNTED_AT_ONCE = 1_500_000  # tokens of a block
_TOKENS_A_BUCKET = 1_000_000
_SEED = 42  # Spark's own for xxhash64


def held_out() -> Column:
    """Documents that are not learned from: crc32 of the doc_id as text leaves 1 when divided by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1, F.lit(False))


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


@dataclass
class Automaton:
    """States 0 (root), 1, 2, ...; `arcs[state * size + word]` is (log10 probability, next state)."""

    vocabulary: list[str]  # frequent words by id, the end token among them
    root: list[float]  # log10 probability of each at the root
    after: list[int]  # the state each leads to from the root
    arcs: dict[int, tuple[float, int]] = field(default_factory=dict)
    fail: list[int] = field(default_factory=lambda: [0])
    weight: list[float] = field(default_factory=lambda: [0.0])

    def score(self, ids: list[int]) -> float:
        """log10 probability of a token sequence, but for words without an id (-1), which leave the state at the root."""
        size, arcs, fail, weight, root, after = len(self.vocabulary), self.arcs, self.fail, self.weight, self.root, self.after
        total, s = 0.0, 0
        for w in ids:
            if w < 0:
                while s:
                    total += weight[s]
                    s = fail[s]
                continue
            while s:
                hit = arcs.get(s * size + w)
                if hit is not None:
                    total += hit[0]
                    s = hit[1]
                    break
                total += weight[s]
                s = fail[s]
            else:
                total += root[w]
                s = after[w]
        return total


def _prob(a: Automaton, s: int, w: int) -> float:
    """log10 probability of a word in a state whose shorter states are complete."""
    total = 0.0
    while s:
        hit = a.arcs.get(s * len(a.vocabulary) + w)
        if hit is not None:
            return total + hit[0]
        total += a.weight[s]
        s = a.fail[s]
    return total + a.root[w]


def assemble(vocabulary: list[str], counts: list[int], n: int, v: int, grams: list[dict[tuple[int, ...], int]]) -> Automaton:
    """The automaton of kept n-grams: `grams[0]` pairs, `grams[1]` triples, ..., all by word ids with exact counts."""
    size = len(vocabulary)
    out = Automaton(vocabulary, [log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in counts], [0] * size)
    whole: dict[tuple[int, ...], int] = {(w,): c for w, c in enumerate(counts)}
    states: dict[tuple[int, ...], int] = {(): 0}

    def longest(gram: tuple[int, ...]) -> int:
        while gram not in states:
            gram = gram[1:]
        return states[gram]

    for kept in grams:
        by_context: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for gram, c in kept.items():
            by_context.setdefault(gram[:-1], []).append((gram[-1], c))
        for context, follow in by_context.items():
            s, f = len(out.fail), longest(context[1:])
            states[context] = s
            out.fail.append(f)
            taken = sum((c - DISCOUNT) / whole[context] for _, c in follow)
            other = sum(10 ** _prob(out, f, w) for w, _ in follow)
            out.weight.append(log10(max(1e-12, 1 - taken) / max(1e-12, 1 - other)))
            for w, c in follow:
                out.arcs[s * size + w] = (log10((c - DISCOUNT) / whole[context]), 0)
        whole = kept
    for kept in grams:
        for gram in kept:
            key = states[gram[:-1]] * size + gram[-1]
            out.arcs[key] = (out.arcs[key][0], longest(gram))
    out.after = [longest((w,)) for w in range(size)]
    return out


def _by_place(ids: np.ndarray) -> bytes:
    return ids.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_places(data) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def _packed_ids(ids: np.ndarray) -> bytes:
    return zlib.compress(_by_place(ids), 1)


def _ids(packed: bytes) -> np.ndarray:
    return _from_places(zlib.decompress(packed))


def tokenise(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, held_out, n_tokens, ids (packed, -1 for a word without id), rare words and how often each, and the
    hashes (packed 64-bit) of the words without id in the order of the text, and the block of texts it belongs to."""
    sent, key = send(docs.sparkSession, vocabulary), new_key("vocabulary")

    def run(frames):
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        number = once("lm.vocabulary", key, lambda: {w.encode(): i for i, w in enumerate(sent())})
        end = END.encode()
        begin, total = TaskContext.get().partitionId() << 33, 0
        for frame in frames:
            for block in text_blocks(frame, "text"):
                ids, rare, times, sizes, hashes, part = [], [], [], [], [], []
                for text in block["text"]:
                    tokens = [*words(text), end]
                    got = [number.get(w, -1) for w in tokens]
                    lost = Counter([w for w, i in zip(tokens, got, strict=True) if i < 0]) if -1 in got else {}
                    ids.append(_packed_ids(np.array(got, np.int32)))
                    rare.append([w.decode() for w in lost])
                    times.append(list(lost.values()))
                    sizes.append(len(got))
                    part.append(begin + total // _COUNTED_AT_ONCE)
                    total += len(got)
                    named = {w: xxh64_intdigest(w, _SEED) for w in lost}
                    hashes.append(np.array([named[w] for w, i in zip(tokens, got, strict=True) if i < 0] if lost else [], np.uint64).tobytes())
                yield pd.DataFrame({"doc_id": block["doc_id"], "held_out": block["held_out"], "n_tokens": sizes, "ids": ids, "rare": rare, "times": times, "hashes": hashes, "block": part})

    return docs.mapInPandas(run, "doc_id long, held_out boolean, n_tokens long, ids binary, rare array<string>, times array<int>, hashes binary, block long")


def _codes(ids: np.ndarray, k: int, size: int) -> np.ndarray:
    """The k-grams without unknown words, each as one number in base `size`."""
    code, sound = np.zeros(max(0, len(ids) - k + 1), np.int64), np.ones(max(0, len(ids) - k + 1), bool)
    for j in range(k):
        part = ids[j : len(ids) - k + 1 + j]
        sound &= part >= 0
        code = code * size + part
    return code[sound]


def _blocks_of_ids(frames):
    """Ids of many documents in a row, with a gap after each, twice _BLOCK_TOKENS at a time at most."""
    held, n = [], 0
    for frame in frames:
        for packed in frame["ids"]:
            held += [_ids(packed).astype(np.int64), np.array([-1])]
            n += len(held[-2])
            if n >= 2 * _BLOCK_TOKENS:
                yield n, np.concatenate(held)
                held, n = [], 0
    if held:
        yield n, np.concatenate(held)


def count_grams(tokens: DataFrame, size: int, n: int, order: int, share: float) -> list[dict[tuple[int, ...], int]]:
    """Pairs, triples, ... up to `order` with at least `share` of the n training tokens (and two), counted exactly.

    First every block names what holds half of that share of its own tokens, which bounds each n-gram's whole count
    from above; a second pass counts those whose bound reaches the share.
    """
    spark = tokens.sparkSession

    def name(frames):
        for total, ids in _blocks_of_ids(frames):
            for k in range(2, order + 1):
                code, count = np.unique(_codes(ids, k, size), return_counts=True)
                some = count >= _LOCAL * share * total
                yield pd.DataFrame({"k": k, "code": code[some], "n": count[some], "total": total})

    # A block that does not name an n-gram holds less than _LOCAL * share of its tokens of it, so this bounds its count.
    # Blocks of like size, however the table is cut: a small one would name all that it holds.
    blocks = tokens.select("ids").coalesce(max(1, n // _BLOCK_TOKENS))
    named = blocks.mapInPandas(name, "k int, code long, n long, total long").groupBy("k", "code").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    most = F.col("n") + _LOCAL * share * (n - F.col("total"))
    named = stage(named.where(most >= share * n * (1 - 1e-9)).select("k", "code"), "candidates")
    slices = 1 + named.count() // _CANDIDATES_AT_ONCE
    kept: list[dict[tuple[int, ...], int]] = [{} for _ in range(2, order + 1)]
    for i in range(slices):
        some = named.where(F.pmod(F.xxhash64("k", "code"), F.lit(slices)) == i).toPandas()  # bounded by the slice
        wanted = {k: np.sort(some.loc[some["k"] == k, "code"].to_numpy()) for k in range(2, order + 1)}
        sent, key = send(spark, wanted), new_key("wanted")

        def count(frames, sent=sent, key=key):
            wanted = once("lm.wanted", key, sent)
            sums = {k: np.zeros(len(c) + 1, np.int64) for k, c in wanted.items()}
            for _, ids in _blocks_of_ids(frames):
                for k, codes in wanted.items():
                    if len(codes):
                        got = _codes(ids, k, size)
                        at = np.minimum(np.searchsorted(codes, got), len(codes) - 1)
                        sums[k] += np.bincount(np.where(codes[at] == got, at, len(codes)), minlength=len(codes) + 1)
            for k, codes in wanted.items():
                some = np.flatnonzero(sums[k][:-1])
                yield pd.DataFrame({"k": k, "code": codes[some], "n": sums[k][some]})

        exact = tokens.select("ids").mapInPandas(count, "k int, code long, n long").groupBy("k", "code").agg(F.sum("n").alias("n"))
        for k, code, c in exact.where(F.col("n") >= max(2.0, share * n)).toPandas().itertuples(index=False):  # at most 1 / share for each k
            gram = []
            for _ in range(k):
                code, w = divmod(code, size)
                gram.append(int(w))
            kept[k - 2][tuple(reversed(gram))] = int(c)
    return kept


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(frame: pd.DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the tokens of some rows, and the place of each token's row."""
    held = []
    for ids, hashes in zip(frame["ids"], frame["hashes"], strict=True):
        ids = _ids(ids)
        held.append(vocabulary[ids])
        held[-1][ids < 0] = np.frombuffer(hashes, np.uint64)
    return np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in held])


def _vocabulary_hashes(words: list[str]) -> np.ndarray:
    """By id, and one more that -1 finds."""
    from xxhash import xxh64_intdigest

    return np.array([*[xxh64_intdigest(w.encode(), _SEED) for w in words], 0], np.uint64)


@dataclass
class Tokens:
    """The tokens of some texts in a row."""

    hashes: np.ndarray  # of their words
    ids: np.ndarray  # which of the hashes each has
    text: np.ndarray  # the text each stands in
    learned: np.ndarray  # by text: whether it is learned from
    word: np.ndarray = field(init=False)  # the hash of each

    def __post_init__(self):
        self.word = self.hashes[self.ids]


@dataclass
class Level:
    """The n-grams of one length in some texts: the different ones, and where each stands."""

    code: np.ndarray  # sorted numbers
    first: np.ndarray  # the token at which each begins somewhere
    where: np.ndarray  # by token, and one more: which of the different ones begins there, -1 for none


def _level(tokens: Tokens, code: np.ndarray, begins: np.ndarray) -> Level:
    sort = np.argsort(code)
    code = code[sort]
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    at = np.flatnonzero(new)
    place = np.empty(len(code), np.int32)
    place[sort] = np.cumsum(new, dtype=np.int32) - 1
    where = np.full(len(tokens.word) + 1, -1, np.int32)
    where[begins] = place
    return Level(code[at], begins[sort[at]], where)


def times_of(tokens: Tokens, level: Level) -> np.ndarray:
    """How often each of the different n-grams stands in texts to learn from."""
    begins = np.flatnonzero(level.where[:-1] >= 0)
    return np.bincount(level.where[begins], tokens.learned[tokens.text[begins]], len(level.code)).astype(np.int64)


def words_of(tokens: Tokens) -> Level:
    """The words; a word's number is its hash."""
    code, place = np.unique(tokens.hashes, return_inverse=True)
    where = np.append(place.astype(np.int32)[tokens.ids], np.int32(-1))
    first = np.zeros(len(code), np.int32)
    first[where[-2::-1]] = np.arange(len(tokens.ids) - 1, -1, -1, dtype=np.int32)
    return Level(code, first, where)


def longer(tokens: Tokens, shorter: Level, k: int, good: np.ndarray | None = None) -> Level:
    """The n-grams of k words from those of k - 1, within one text; of `good` ones, if given: where one of the two that an
    n-gram begins and ends with was seen too seldom, so was the n-gram."""
    there = shorter.where >= 0 if good is None else np.append(good, False)[shorter.where]
    begins = np.flatnonzero(there[:-1] & there[1:]).astype(np.int32)
    begins = begins[tokens.text[begins] == tokens.text[begins + k - 1]]
    code = shorter.code[shorter.where[begins]]
    return _level(tokens, _mixed(code * np.uint64(0x9E3779B97F4A7C15) + tokens.word[begins + k - 1] + np.uint64(k)), begins)


def _pack(codes: np.ndarray) -> bytes:
    """Numbers in a few sorted runs as steps (modulo 2 ** 64), their bytes by place, so that the leading zeros stand together."""
    return _planes(np.diff(codes, prepend=np.uint64(0)))


def _unpack(packed: bytes) -> np.ndarray:
    return _from_planes(packed, np.uint64).cumsum(dtype=np.uint64)


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers, compressed, their bytes by place."""
    squeeze = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return squeeze.compress(x.view(np.uint8).reshape(-1, 8).T.tobytes()) + squeeze.flush()


def _from_planes(packed: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T).view(kind).ravel()


def _spans(codes: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The buckets of numbers that stand by bucket, and the begin and end of each bucket's."""
    bucket = (codes >> np.uint64(64 - bits)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(codes) else np.zeros(1, np.int64)
    return bucket[edge[:-1]], list(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))


def _told_numbers(told: pd.DataFrame, name: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(_from_planes(t, np.int64) for t in told[name])])


@dataclass
class Known:
    """What is known of the n-grams of some texts: by length, and by round of counting in the order of the buckets."""

    levels: list[Level]
    counts: list[np.ndarray]  # whole ones
    adds: list[np.ndarray]  # whether this block adds the n-gram to its context's sums
    sorts: list[np.ndarray]  # by round: which of its levels' one after the other each is
    codes: list[np.ndarray]  # by round, as sorted
    ranks: list[np.ndarray]  # by round, as sorted: the rank in its bucket, -1 of those that are no contexts


@dataclass
class Backoff:
    """What tasks need to count the n-grams of blocks and to follow the states of their texts.

    Words and pairs are counted in the first round, triples in the second, and so on. A bucket's name holds its round.
    """

    hashes: np.ndarray  # for rows of `tokenise`: of the words with ids, and one more that -1 finds
    order: int
    least: int
    n: int  # training tokens
    v: int  # different ones
    bits: int  # of a number that name its bucket

    def rounds(self) -> list[range]:
        """The levels (length less one) each round counts."""
        return [range(min(2, self.order)), *(range(k, k + 1) for k in range(2, self.order))]

    def _dealt(self, levels: list[Level]) -> tuple[np.ndarray, np.ndarray]:
        """All different numbers by bucket, in it by length and number, and which of the levels' one after the other each is."""
        codes = np.concatenate([x.code for x in levels])
        sort = np.argsort((codes >> np.uint64(64 - self.bits)).astype(np.uint16 if self.bits <= 16 else np.int64), kind="stable")
        return codes[sort], sort

    def _asked(self, tokens: Tokens, levels: list[Level], number: int, block: int, words: int) -> pd.DataFrame:
        codes, sort = self._dealt(levels)
        times = np.concatenate([times_of(tokens, x) for x in levels])[sort]
        buckets, spans = _spans(codes, self.bits)
        return pd.DataFrame({
            "bucket": buckets + (number << self.bits),
            "block": block,
            "words": [int((sort[s:e] < words).sum()) for s, e in spans],
            "codes": [_pack(codes[s:e]) for s, e in spans],
            "times": [_planes(times[s:e]) for s, e in spans],
        })

    def asked(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The different n-grams up to the whole order of some rows of `tokenise` by bucket, and how often each stands in
        texts to learn from; `words` of a bucket's are words, and stand first."""
        word, text = _hashed(rows, self.hashes)
        return self.first(Tokens(word, np.arange(len(word)), text, ~rows["held_out"].to_numpy(bool)), rows["block"].iloc[0], self.order)

    def first(self, tokens: Tokens, block: int, order: int) -> pd.DataFrame:
        """All n-grams up to an order, of a block."""
        levels = [words_of(tokens)]
        for k in range(2, order + 1):
            levels.append(longer(tokens, levels[-1], k))
        return self._asked(tokens, levels, 0, block, len(levels[0].code))

    def next(self, tokens: Tokens, block: int, told: pd.DataFrame, number: int) -> pd.DataFrame:
        """Those of a later round, which hold only shorter ones seen `least` times."""
        known = self.known(tokens, told, number)
        levels = [longer(tokens, known.levels[-1], k + 1, known.counts[-1] >= self.least) for k in self.rounds()[number]]
        return self._asked(tokens, levels, number, block, 0)

    def known(self, tokens: Tokens, told: pd.DataFrame, rounds: int) -> Known:
        """What the first rounds told a block."""
        out = Known([], [], [], [], [], [])
        told = told[told["told"].notna()].sort_values("bucket")
        for number, some in enumerate(self.rounds()[:rounds]):
            for k in some:
                good = out.counts[k - 1] >= self.least if k >= 2 else None
                out.levels.append(longer(tokens, out.levels[-1], k + 1, good) if k else words_of(tokens))
            levels = out.levels[some[0] :]
            codes, sort = self._dealt(levels)
            part = told[told["bucket"].to_numpy() >> self.bits == number]
            both = _told_numbers(part, "told")
            rank = np.full(len(both), -1)
            if some[0] < self.order - 1:  # else none of them is a context
                rank[both >> 1 >= self.least] = np.concatenate([np.zeros(0, np.int64), *(_unpack(r).view(np.int64) for r in part["ranks"])])
                rank[sort >= sum(len(out.levels[k].code) for k in some if k < self.order - 1)] = -1
            back = np.empty_like(both)
            back[sort] = both
            for x in np.split(back, np.cumsum([len(x.code) for x in levels])[:-1]):
                out.counts.append(x >> 1)
                out.adds.append((x & 1).astype(bool))
            out.sorts.append(sort)
            out.codes.append(codes)
            out.ranks.append(rank)
        return out

    def sums(self, tokens: Tokens, block: int, told: pd.DataFrame) -> pd.DataFrame:
        """By bucket, the contexts in a block by rank with what it adds to the sums of each: its arcs, their counts,
        and the counts of the same words after the shorter context."""
        known = self.known(tokens, told, len(self.rounds()))
        counts, added = known.counts, [np.zeros((3, len(c)), np.int64) for c in known.counts]
        for k in range(1, self.order):
            some = np.flatnonzero(known.adds[k] & (counts[k] >= self.least))
            at, where = known.levels[k].first[some], known.levels[k - 1].where
            context, suffix = where[at], where[at + 1]
            for to, x in zip(added[k - 1], (None, counts[k][some], counts[k - 1][suffix]), strict=True):
                to[:] = np.bincount(context, x, len(to))
        out = []
        for number, some in enumerate(self.rounds()):
            ask = known.ranks[number] >= 0
            rank = known.ranks[number][ask].view(np.uint64)
            sums = np.concatenate([added[k] for k in some], axis=1)[:, known.sorts[number][ask]]
            buckets, spans = _spans(known.codes[number][ask], self.bits)
            out.append(pd.DataFrame({
                "bucket": buckets + (number << self.bits),
                "block": block,
                "ranks": [_pack(rank[s:e]) for s, e in spans],
                "sums": [_planes(np.ascontiguousarray(sums[:, s:e])) for s, e in spans],
            }))
        return pd.concat(out)

    def scores(self, tokens: Tokens, told: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: how many of its tokens are known, the sum of their probabilities at the root, and what following
        the states adds to it."""
        known = self.known(tokens, told, len(self.rounds()))
        levels, counts = known.levels, known.counts
        summed, sums = told[told["told"].isna()].sort_values("bucket"), []
        for number, some in enumerate(self.rounds()):
            part = summed[summed["bucket"].to_numpy() >> self.bits == number]
            got = [_from_planes(x, np.int64).reshape(3, -1) for x in part["sums"]]
            back = np.zeros((3, len(known.sorts[number])))
            if got:
                back[:, known.sorts[number][known.ranks[number] >= 0]] = np.concatenate(got, axis=1)
            sums += np.split(back, np.cumsum([len(counts[k]) for k in some])[:-1], axis=1)
        whole = self.n + 0.5 * (self.v + 1)
        left = lambda x: np.log10(np.maximum(1e-12, 1 - x))
        logs, weights = [np.log10((counts[0] + 0.5) / whole)], []
        for k in range(1, self.order):
            some = np.flatnonzero(counts[k] >= self.least)
            log = np.full(len(counts[k]) + 1, np.nan)  # the last for n-grams that are no arcs for sure
            log[some] = np.log10((counts[k][some] - DISCOUNT) / counts[k - 1][levels[k - 1].where[levels[k].first[some]]])
            logs.append(log)
            arcs, own, shorter = sums[k - 1]
            has = np.flatnonzero(arcs)
            if k == 1:
                other = (shorter[has] + 0.5 * arcs[has]) / whole
            else:
                other = (shorter[has] - DISCOUNT * arcs[has]) / counts[k - 2][levels[k - 2].where[levels[k - 1].first[has] + 1]]
            weight = np.zeros(len(arcs) + 1)  # the last for contexts without arcs
            weight[has] = left((own[has] - DISCOUNT * arcs[has]) / counts[k - 1][has]) - left(other)
            weights.append(weight)
        text, texts = tokens.text, len(tokens.learned)
        place = levels[0].where[:-1]
        root = logs[0][place]
        added, open_ = np.zeros(len(text)), np.ones(len(text), bool)  # by a token; still without an arc
        for k in range(self.order - 1, 0, -1):
            last = np.flatnonzero(open_[k:] & (text[k:] == text[: len(text) - k])) + k
            log = logs[k][levels[k].where[last - k]]
            arc = ~np.isnan(log)
            added[last[arc]] += log[arc] - root[last[arc]]
            open_[last[arc]] = False
            last = last[~arc]
            added[last] += weights[k - 1][levels[k - 1].where[last - k]]
        return np.bincount(text, counts[0][place] > 0, texts).astype(np.int64), np.bincount(text, root, texts), np.bincount(text, added, texts)


def _whole_counts(asked: pd.DataFrame, least: int, ranked: bool) -> pd.DataFrame:
    """Of one bucket: twice the sum of all blocks' counts, plus one for the first block that has the n-gram; if `ranked`, the
    ranks of each block's n-grams among those seen `least` times; in one row how many different words are learned."""
    asked = asked.sort_values("block", ignore_index=True)
    codes = [_unpack(c) for c in asked["codes"]]
    _, first, place = np.unique(np.concatenate(codes), return_index=True, return_inverse=True)
    times = np.bincount(place, np.concatenate([_from_planes(t, np.int64) for t in asked["times"]])).astype(np.int64)
    both = times[place] * 2
    both[first] += 1
    places = np.split(place, np.cumsum([len(c) for c in codes])[:-1])
    told = [_planes(t) for t in np.split(both, np.cumsum([len(c) for c in codes])[:-1])]
    rank = np.cumsum(times >= least) - 1
    ranks = [_pack(rank[p[times[p] >= least]].view(np.uint64)) if ranked else b"" for p in places]
    word = np.zeros(len(times), bool)
    for p, n in zip(places, asked["words"], strict=True):
        word[p[:n]] = True
    v = [int((word & (times > 0)).sum()), *[0] * (len(asked) - 1)]
    return asked[["block", "bucket"]].assign(told=told, ranks=ranks, v=v)


def _whole_sums(sums: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the sums of each context over all blocks, for each block that asks."""
    ranks = [_unpack(r).view(np.int64) for r in sums["ranks"]]
    place = np.concatenate(ranks)
    added = np.concatenate([_from_planes(x, np.int64).reshape(3, -1) for x in sums["sums"]], axis=1)
    whole = np.stack([np.bincount(place, x).astype(np.int64) for x in added])
    return sums[["block", "bucket"]].assign(sums=[_planes(np.ascontiguousarray(whole[:, r])) for r in ranks])


def in_blocks(docs: DataFrame) -> DataFrame:
    """One row for a block of texts: their ids, which are held out, their numbers of tokens, and the tokens as ids of the
    block's own words, whose hashes go with it. `learned` counts the tokens to learn from."""

    def run(frames):
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        name = TaskContext.get().partitionId() << 33
        number, rows, ids, total = defaultdict(count().__next__), [], [], 0

        def made() -> pd.DataFrame:
            doc, null, held = (np.array(x) for x in zip(*rows, strict=True))
            sizes = np.array([len(i) for i in ids], np.int32)
            return pd.DataFrame({
                "block": [name],
                "learned": [int(sizes[~held.astype(bool)].sum())],
                "docs": [doc.astype(np.int64).tobytes()],
                "nulls": [null.astype(bool).tobytes()],
                "held": [held.astype(bool).tobytes()],
                "sizes": [sizes.tobytes()],
                "ids": [pa.compress(_by_place(np.concatenate(ids)), "zstd", asbytes=True)],
                "hashes": [np.fromiter((xxh64_intdigest(w, _SEED) for w in number), np.uint64, len(number)).tobytes()],
            })

        for frame in frames:
            for row in zip(frame["doc_id"], frame["without"], frame["held_out"], frame["text"], strict=True):
                tokens = words(row[3])
                tokens.append(END.encode())
                rows.append(row[:3])
                ids.append(np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens)))
                total += len(tokens)
                if total >= _COUNTED_AT_ONCE:
                    yield made()
                    name, number, rows, ids, total = name + 1, defaultdict(count().__next__), [], [], 0
        if rows:
            yield made()

    rows = docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.isnull("doc_id").alias("without"), "held_out", "text")
    return rows.mapInPandas(run, "block long, learned long, docs binary, nulls binary, held binary, sizes binary, ids binary, hashes binary")


def _opened(block) -> Tokens:
    sizes, held = np.frombuffer(block.sizes, np.int32), np.frombuffer(block.held, bool)
    ids = _from_places(pa.decompress(block.ids, 4 * int(sizes.sum()), "zstd"))
    return Tokens(np.frombuffer(block.hashes, np.uint64), ids, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), ~held)


def _counted(asked: DataFrame, least: int, ranked: bool, number: int) -> DataFrame:
    told = asked.groupBy("bucket").applyInPandas(lambda some: _whole_counts(some, least, ranked), "block long, bucket long, told binary, ranks binary, v long")
    return _written(told, f"counts-{number}")


def _written(df: DataFrame, name: str) -> DataFrame:
    """A stage whose shuffles are removed once it is written; nothing else reads them."""
    conf, option = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(option, "false")
    conf.set(option, "true")
    try:
        return stage(df, name)
    finally:
        conf.set(option, before)


def score(docs: DataFrame, held_out: Column, order: int = 3, word_share: float = 1e-6, least: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document (doc_id, text).

    N-grams up to `order` with `least` occurrences count, whatever their words. All words go by blocks, however rare, so
    `word_share` (once the least share of a word with an id) changes nothing. A null text is empty: its one token is the
    end. Without training documents every probability at the root is that of an unknown word. Repeated rows are scored
    each; other columns are not used; an empty table gives an empty one.
    """
    ship(__name__)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")  # rows are texts, or blocks of them
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    blocks = _written(in_blocks(docs), "tokens")
    n = blocks.agg(F.coalesce(F.sum("learned"), F.lit(0))).first()[0]
    bits = max(3, (n // _TOKENS_A_BUCKET).bit_length())
    backoff = Backoff(np.zeros(1, np.uint64), order, least, n, 0, bits)
    rounds = len(backoff.rounds())
    asked = "bucket long, block long, words long, codes binary, times binary"

    def ask(frames):
        for frame in frames:
            for block in frame.itertuples():
                yield backoff.first(_opened(block), block.block, min(2, order))

    tokens = blocks.select("block", "sizes", "held", "ids", "hashes")
    told = _counted(tokens.mapInPandas(ask, asked), least, order > 1, 0)
    v = told.agg(F.coalesce(F.sum("v"), F.lit(0))).first()[0]
    told = told.drop("v")

    def ask_next(number: int):
        return lambda rows, told: pd.concat([backoff.next(_opened(block), block.block, told, number) for block in rows.itertuples()])

    for number in range(1, rounds):
        more = tokens.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(ask_next(number), asked)
        told = told.unionByName(_counted(more, least, number + 1 < order - 1, number).drop("v"))

    def sums(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([backoff.sums(_opened(block), block.block, told) for block in rows.itertuples()])

    parts = tokens.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(sums, "bucket long, block long, ranks binary, sums binary")
    summed = _written(parts.groupBy("bucket").applyInPandas(_whole_sums, "block long, bucket long, sums binary"), "sums")
    whole = Backoff(backoff.hashes, order, least, n, v, bits)

    def add(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block in rows.itertuples():
            known, base, gain = whole.scores(_opened(block), told)
            out.append(pd.DataFrame({
                "doc_id": np.frombuffer(block.docs, np.int64),
                "without": np.frombuffer(block.nulls, bool),
                "held_out": np.frombuffer(block.held, bool),
                "n_tokens": np.frombuffer(block.sizes, np.int32).astype(np.int64),
                "n_known": known,
                "base_score": base,
                "gain": gain,
            }))
        return pd.concat(out)

    scored = blocks.groupBy("block").cogroup(told.unionByName(summed, allowMissingColumns=True).groupBy("block"))
    scored = scored.applyInPandas(add, "doc_id long, without boolean, held_out boolean, n_tokens long, n_known long, base_score double, gain double")
    return scored.select(
        F.when(~F.col("without"), F.col("doc_id")).alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("base_score") + F.col("gain")).alias("score"),
    )
