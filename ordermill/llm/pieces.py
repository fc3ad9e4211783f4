"""Byte-pair pieces by prefix table: exact SentencePiece BPE ids in one pass over the text, and back.

Every prefix of a word has exactly one last token in its encoding. An automaton over the vocabulary lists the pieces
that end at a position; the one whose pair with the last token of the prefix before it is *compatible* (encoding the
two side by side would leave both as they are) is that prefix's last token. The ids follow by walking the table
backwards. The table is filled for all unknown words of a batch at once, position by position, with numpy.

Words are cut before each space mark, and long ones also between characters that no piece holds side by side: no
merge crosses such a place, so the ids of the parts are the ids of the whole.
"""

from __future__ import annotations

import codecs
import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import add_columns, once, send, ship, text_blocks

SPACE = "▁"
START, UNKNOWN = -1, -2  # in the table: nothing yet, a character without a piece
LONG_WORD = 48  # words of more characters are cut where no piece reaches across
_CHARS = 1_000_000  # characters encoded at once
_SEEN_BITS, _MIX = 20, np.uint64(0x9E3779B97F4A7C15)
KNOWN_WORDS = 150_000  # words a worker remembers; the memory forgets all at once when full


@dataclass
class Vocabulary:
    """What the encoder needs of a model: pieces, merge ranks, the last merge of each piece, all pairs that merge."""

    pieces: list[str]  # text of each id; "" for control ids
    byte_base: int  # id of byte 0
    controls: set[int]
    bos: int
    eos: int
    rank: np.ndarray  # by id: order of the merge that makes it, -1 for single characters, -2 for pieces never made
    left: np.ndarray  # by id: the two parts of the last merge
    right: np.ndarray
    pair_keys: np.ndarray  # left id * size + right id, sorted
    pair_ranks: np.ndarray
    runs: set[int]  # lengths of pieces made of space marks alone


def merge_parts(chars: list[str], score: dict[str, float]) -> list[tuple[str, tuple[str, str] | None]]:
    """Plain merging, best score first and then leftmost; each part with the two it was last made from."""
    text, made = list(chars), [None] * len(chars)
    nxt, prv = list(range(1, len(chars) + 1)), list(range(-1, len(chars) - 1))
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and nxt[i] < len(text) and (whole := text[i] + text[nxt[i]]) in score:
            heapq.heappush(heap, (-score[whole], i, nxt[i], whole))

    for i in range(len(chars) - 1):
        offer(i)
    while heap:
        _, i, j, whole = heapq.heappop(heap)
        if not text[i] or not text[j] or nxt[i] != j or text[i] + text[j] != whole:
            continue
        made[i], text[i], text[j] = (text[i], text[j]), whole, ""
        nxt[i] = nxt[j]
        if nxt[i] < len(text):
            prv[nxt[i]] = i
        offer(prv[i])
        offer(i)
    return [(t, m) for t, m in zip(text, made, strict=True) if t]


def load(model_path: str) -> Vocabulary:
    """Read a BPE model's vocabulary (driver side; its size is that of the vocabulary)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = model.get_piece_size()
    plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
    pieces = [model.id_to_piece(i) for i in range(size)]
    ids = {p: i for i, p in enumerate(pieces) if plain[i]}
    score = {p: model.get_score(i) for p, i in ids.items()}
    rank, left, right = np.full(size, -2, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)
    # pieces of space marks alone share one score, so position decides among them: `space_run` makes them
    many = sorted((p for p in ids if len(p) > 1 and p.strip(SPACE)), key=lambda p: (-score[p], ids[p]))
    for p in (p for p in ids if len(p) == 1):
        rank[ids[p]] = -1
    for order, p in enumerate(many):
        parts = merge_parts(list(p), score)
        if len(parts) == 1:
            rank[ids[p]] = order
            left[ids[p]], right[ids[p]] = (ids[x] for x in parts[0][1])
    pairs = {
        ids[p[:k]] * size + ids[p[k:]]: int(rank[ids[p]])
        for p in many
        if rank[ids[p]] >= 0
        for k in range(1, len(p))
        if p[:k] in ids and p[k:] in ids
    }
    keys = np.array(sorted(pairs), np.int64)
    return Vocabulary(
        pieces=[p if plain[i] else "" for i, p in enumerate(pieces)],
        byte_base=model.piece_to_id("<0x00>"),
        controls={i for i in range(size) if model.is_control(i)},
        bos=model.bos_id(),
        eos=model.eos_id(),
        rank=rank,
        left=left,
        right=right,
        pair_keys=keys,
        pair_ranks=np.array([pairs[k] for k in keys.tolist()], np.int64),
        runs={len(p) for p in ids if not p.strip(SPACE)},
    )


class Codec:
    """Encoder and decoder over one vocabulary; a Python worker builds it once."""

    def __init__(self, v: Vocabulary):
        self.v, self.size = v, len(v.pieces)
        self.ids = {p: i for i, p in enumerate(v.pieces) if p}
        self.known: dict[str, bytes] = {}
        self.run_ids: dict[int, bytes] = {}
        used = [i for i in range(self.size) if v.rank[i] >= -1]
        self.joined = {p[k : k + 2] for p in (v.pieces[i] for i in used) for k in range(len(p) - 1)}
        self.n_bytes = np.array([len(p.encode()) for p in v.pieces], np.int32)
        self._automaton(used)
        self.seen, self.seen_ok = np.full(1 << _SEEN_BITS, -1), np.zeros(1 << _SEEN_BITS, bool)  # pairs tested lately
        self.as_bytes = [p.encode() for p in v.pieces]
        if v.byte_base >= 0:
            for b in range(256):
                self.as_bytes[v.byte_base + b] = bytes([b])
        self.unknown_text = " ⁇ ".encode()  # fixed value: how the library shows an unknown id

    def _automaton(self, used: list[int]) -> None:
        """Bytes to states; `ends[s]` is the piece that state s spells, `shorter[s]` the next suffix that is a piece."""
        goto: list[dict[int, int]] = [{}]
        ends = [-1]
        for i in used:
            s = 0
            for b in self.v.pieces[i].encode():
                if b not in goto[s]:
                    goto[s][b] = len(goto)
                    goto.append({})
                    ends.append(-1)
                s = goto[s][b]
            ends[s] = i
        step = np.zeros((len(goto), 256), np.uint16 if len(goto) < 1 << 16 else np.int32)
        fail, shorter, layer = np.zeros(len(goto), np.int32), np.zeros(len(goto), np.int32), [0]
        while layer:
            deeper = []
            for s in layer:
                if s:
                    step[s] = step[fail[s]]
                for b, t in goto[s].items():
                    fail[t] = step[fail[s], b] if s else 0
                    shorter[t] = fail[t] if ends[fail[t]] >= 0 else shorter[fail[t]]
                    deeper.append(t)
                for b, t in goto[s].items():
                    step[s, b] = t
            layer = deeper
        self.step, self.ends, self.shorter = step, np.array(ends, np.int32), shorter

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of tokens side by side: would encoding their joined text give just these two?

        Undo the later of the two last merges again and again; if at any time the parts that then touch could have
        merged earlier than what was undone, the pair cannot stand.
        """
        key = a.astype(np.int64) * self.size + b
        slot = (key.view(np.uint64) * _MIX) >> np.uint64(64 - _SEEN_BITS)
        ok = self.seen_ok[slot] | (a < 0)
        new = np.flatnonzero((self.seen[slot] != key) & (a >= 0))
        if len(new):
            ok[new] = self._compatible(a[new], b[new])
            self.seen[slot[new]], self.seen_ok[slot[new]] = key[new], ok[new]
        return ok

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        v = self.v
        ok, at = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(at), np.iinfo(np.int64).max)
        while len(at):
            key = a * self.size + b
            k = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
            merges = (v.pair_keys[k] == key) & (v.pair_ranks[k] < limit)
            ok[at[merges]] = False
            ra, rb = v.rank[a], v.rank[b]
            on = ~merges & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[on], a[on], b[on], ra[on], rb[on]
            first = ra > rb  # on a tie the right one came later
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, v.right[a], a), np.where(first, b, v.left[b])
        return ok

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32 bit) of each part, by the prefix table of all parts at once."""
        if not parts:
            return []
        raw = [p.encode() for p in parts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(-size, kind="stable").tolist()
        size = size[order]
        base = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
        data = np.frombuffer(b"\0" + b"\0".join([raw[i] for i in order]) + b"\0", np.uint8)
        inner = (data & 0xC0) == 0x80  # bytes that go on with a character
        last = np.full(len(data), START, np.int32)
        state = np.zeros(len(raw), np.int32)
        live = len(raw)
        for p in range(1, int(size[0]) + 1):
            while size[live - 1] < p:
                live -= 1
            slot = base[:live] + p
            state = self.step[state[:live], data[slot]]
            done = ~inner[slot + 1] | (size[:live] == p)
            at = np.flatnonzero(done)
            s = state[at]
            s = np.where(self.ends[s] >= 0, s, self.shorter[s])
            last[slot[at]] = UNKNOWN
            while True:
                some = s > 0
                at, s = at[some], s[some]
                if not len(at):
                    break
                piece = self.ends[s]
                before = last[slot[at] - self.n_bytes[piece]]
                ok = self.compatible(before, piece)
                last[slot[at[ok]]] = piece[ok]
                at, s = at[~ok], self.shorter[s[~ok]]
        ids = np.full(len(data), -1, np.int64)
        at = base + size
        left = np.flatnonzero(size > 0)
        while len(left):
            token, end = last[at[left]], at[left]
            known = token >= 0
            ids[end[known]] = token[known]
            at[left[known]] -= self.n_bytes[token[known]]
            lost, e = left[~known], end[~known]
            while len(lost):  # a character without a piece: its bytes, one id each
                ids[e] = self.v.byte_base + data[e].astype(np.int64) if self.v.byte_base >= 0 else 0
                at[lost] -= 1
                more = inner[e]
                lost, e = lost[more], e[more] - 1
            left = left[at[left] > base[left]]
        packed = ids[ids >= 0].astype("<u4").tobytes()
        upto = np.concatenate([[0], np.cumsum(ids >= 0)])
        out: list[bytes] = [b""] * len(raw)
        for i, a, b in zip(order, (upto[base] * 4).tolist(), (upto[base + size + 1] * 4).tolist(), strict=True):
            out[i] = packed[a:b]
        return out

    def cut(self, word: str) -> list[str]:
        """Parts of a long word, cut between characters that no piece holds side by side."""
        places = [k for k in range(1, len(word)) if word[k - 1 : k + 1] not in self.joined]
        return [word[a:b] for a, b in zip([0, *places], [*places, len(word)], strict=True)]

    def learn(self, words: set[str]) -> None:
        """Encode these words (each follows a space mark) and remember them."""
        short = [w for w in words if len(w) < LONG_WORD]
        self.known.update(zip(short, self.encode_parts([SPACE + w for w in short]), strict=True))
        cuts = {w: self.cut(SPACE + w) for w in words if len(w) >= LONG_WORD}
        parts = list({p for ps in cuts.values() for p in ps})
        ids = dict(zip(parts, self.encode_parts(parts), strict=True))
        for w, ps in cuts.items():
            self.known[w] = b"".join([ids[p] for p in ps])

    def space_run(self, n: int) -> bytes:
        """Ids of n space marks that merge with nothing else."""
        if n not in self.run_ids:
            parts = merge_parts([SPACE] * n, {SPACE * k: 0.0 for k in self.v.runs if k > 1})
            self.run_ids[n] = np.array([self.ids[p] for p, _ in parts], "<u4").tobytes()
        return self.run_ids[n]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, begin and end ids included, packed as little-endian unsigned 32-bit integers."""
        split = [t.replace(" ", SPACE).split(SPACE) if t else [] for t in texts]
        known, new = self.known, set()
        for words in split:
            new.update(words)
        new.discard("")
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
        new.difference_update(known)
        if new:
            self.learn(new)
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.v.bos, self.v.eos))
        out = []
        for words in split:
            if "" in words:
                out.append(begin + self._with_runs(words) + end)
            else:
                out.append(begin + b"".join([known[w] for w in words]) + end)
        return out

    def _with_runs(self, words: list[str]) -> bytes:
        """Join words where some space marks stand alone; the mark before a word counts to the run if it stays alone."""
        lone = np.array([self.ids[SPACE]], "<u4").tobytes() if SPACE in self.ids else None
        out, marks = [], 0
        for w in words:
            if not w:
                marks += 1
                continue
            ids = self.known[w]
            if lone is not None and ids[:4] == lone:
                marks, ids = marks + 1, ids[4:]
            if marks:
                out.append(self.space_run(marks))
            out.append(ids)
            marks = 0
        if marks:
            out.append(self.space_run(marks))
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        """The text of a list of ids in UTF-8, as the library's decode gives it."""
        controls, as_bytes = self.v.controls, self.as_bytes
        ids = [i for i in ids if i not in controls] if controls.intersection(ids) else ids
        data = b"".join([as_bytes[i] for i in ids])
        if ids and self.v.pieces[ids[0]][:1] == SPACE:
            data = data[len(SPACE.encode()) :]
        data = data.replace(SPACE.encode(), b" ")
        try:
            data.decode()
        except UnicodeDecodeError:
            codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))
            data = data.decode("utf-8", "each_byte").encode()
        return data


def _sender(df: DataFrame, model_path: str):
    """What gives each Python worker its codec: the tables go out as a broadcast, of the vocabulary's size."""
    ship(__name__)
    vocabulary = load(model_path)
    key = str(hash((tuple(vocabulary.pieces), vocabulary.rank.tobytes())))
    shared = send(df.sparkSession, vocabulary)
    return lambda: once("pieces.codec", key, lambda: Codec(shared()))


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", round_trip: str | None = None) -> DataFrame:
    """Add the ids of whole texts as `ids array<int>`, begin and end ids included. A null text counts as empty.

    With `round_trip`, a column of that name says whether the ids decode to the text again (a space mark in it counts
    as a space). An input column named as a new one is replaced; other columns pass through. No shuffle: each row by
    itself.
    """
    sent = _sender(docs, model_path)

    def run(frames):
        codec = sent()
        for frame in frames:
            for part in text_blocks(frame.drop(columns=[ids, round_trip], errors="ignore"), text, _CHARS):
                texts = [t or "" for t in part[text]]
                coded = codec.encode(texts)
                part = part.assign(**{ids: [np.frombuffer(c, "<u4").astype(np.int32) for c in coded]})
                if round_trip:
                    same = [codec.decode(np.frombuffer(c, "<u4").tolist()) == t.replace(SPACE, " ").encode() for c, t in zip(coded, texts, strict=True)]
                    part = part.assign(**{round_trip: same})
                yield part

    return docs.mapInPandas(run, add_columns(docs, f"`{ids}` array<int>" + (f", `{round_trip}` boolean" if round_trip else "")))


def decode(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text of each list of ids. A null list gives the empty text."""
    sent = _sender(rows, model_path)

    def run(frames):
        codec = sent()
        for frame in frames:
            got = [codec.decode([] if x is None else list(x)).decode() for x in frame[ids]]
            yield frame.drop(columns=[text], errors="ignore").assign(**{text: got})

    return rows.mapInPandas(run, add_columns(rows, f"`{text}` string"))


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, its ids decoded again, both as digests."""
    import hashlib

    sent = _sender(docs, model_path)

    def run(frames):
        codec = sent()
        for frame in frames:
            for part in text_blocks(frame, "text", _CHARS):
                coded = codec.encode([t or "" for t in part["text"]])
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(),
                    "n_tokens": [len(c) // 4 for c in coded],
                    "ids_sha256": [hashlib.sha256(c).hexdigest() for c in coded],
                    "decoded_sha256": [hashlib.sha256(codec.decode(np.frombuffer(c, "<u4").tolist())).hexdigest() for c in coded],
                })

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
