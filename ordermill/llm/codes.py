"""Vector code compression: product codes whose codebooks come from exact rounds of k-means with norm-of-sum bounds.

Every vector is cut into equal parts; each part position has a codebook. A round assigns every part to its nearest entry
(squared Euclidean distance of integers, ties to the lower index) and then moves each entry to the componentwise
floor(sum / count) of its parts.

What a row keeps between rounds, for each part: its entry, and for each group of entries a lower bound of the distance to
all other entries of that group, with the round it was measured in. The codebooks of all rounds are kept. In a later
round a bound is reduced by the largest net displacement of its group since its own round, that is by the norm of the
sum of the steps, which is at most the sum of their norms. Only where the exact distance to the own entry is not below the
bound are the entries of that group measured again, exactly; a bound that holds keeps its old round.

A pass is one read of the written rows; the codebook history travels to the tasks (parts x entries x rounds vectors of
a part), sums come back as one row per task, part, entry and component, summed by Spark.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import new_key, once, send, ship, stage
from .vectors import matrix, sound_rows

PARTS, ENTRIES, ROUNDS, GROUP = 16, 64, 2, 8
_RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
_BLOCK = 4096


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of x to every entry."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        step = x[:, k, None] - entries[None, :, k]
        out += step * step
    return out


def _below(distance: np.ndarray) -> np.ndarray:
    """The root of squared distances as 32-bit floats that are not above it."""
    return np.nextafter(np.sqrt(distance.astype(np.float64)).astype(np.float32), np.float32(-1))


def displacement(history: np.ndarray, now: int, size: int = GROUP) -> np.ndarray:
    """[round, part, group]: the largest net displacement of a group's entries from that round until `now`, not below it."""
    moved = np.sqrt(((history[now] - history[: now + 1]) ** 2).sum(-1).astype(np.float64)) * (1 + 1e-12)
    return np.maximum.reduceat(moved, np.arange(0, moved.shape[2], size), axis=2)


def first(x: np.ndarray, entries: np.ndarray, size: int = GROUP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the parts x (rows, part components): nearest entry, bound for each group, own squared distance."""
    d = _squares(x, entries)
    own = d.argmin(1)
    at = np.arange(len(x))
    nearest = d[at, own]
    d[at, own] = np.iinfo(np.int64).max
    bounds = np.minimum.reduceat(d, np.arange(0, len(entries), size), axis=1)
    return own.astype(np.uint8), _below(bounds), nearest


def again(x: np.ndarray, own: np.ndarray, bounds: np.ndarray, stamps: np.ndarray, entries: np.ndarray, moved: np.ndarray, now: int, size: int = GROUP):
    """The same in a later round: `bounds` and `stamps` (rows, groups) are brought up to date in place.

    `moved[round, group]` is the net displacement since a round. Gives the nearest entries, their squared distances and
    how many groups were measured.
    """
    at = np.arange(len(x))
    old = own.astype(np.int64)
    to_old = _squares_to_own(x, entries[old])
    best, nearest = old.copy(), to_old.copy()
    reduced = bounds - moved[stamps, np.arange(bounds.shape[1])]
    doubtful = np.sqrt(to_old.astype(np.float64))[:, None] * (1 + 1e-12) >= reduced
    measured = {}
    for g in range(bounds.shape[1]):
        some = np.flatnonzero(doubtful[:, g])
        if not len(some):
            continue
        d = _squares(x[some], entries[g * size : (g + 1) * size])
        measured[g] = some, d
        place = d.argmin(1)
        least = d[np.arange(len(some)), place]
        place = place + g * size
        better = (least < nearest[some]) | ((least == nearest[some]) & (place < best[some]))
        best[some[better]], nearest[some[better]] = place[better], least[better]
    # A row that has changed leaves its old entry as another one of that entry's group.
    changed = np.flatnonzero(best != old)
    group = old[changed] // size
    bounds[changed, group] = np.minimum(reduced[changed, group].astype(np.float32), _below(to_old[changed]))
    bounds[changed, group] = np.nextafter(bounds[changed, group], np.float32(-np.inf))
    stamps[changed, group] = now
    for g, (some, d) in measured.items():
        inside = best[some] // size == g
        d[np.flatnonzero(inside), best[some[inside]] - g * size] = np.iinfo(np.int64).max
        bounds[some, g], stamps[some, g] = _below(d.min(1)), now
    own[at] = best.astype(np.uint8)
    return own, nearest, sum(len(some) for some, _ in measured.values())


def _squares_to_own(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    step = x - entry
    return (step * step).sum(1)


def _assign(rows: DataFrame, history: np.ndarray, width: int) -> DataFrame:
    """One round's assignment of every row under the last codebooks; `code`, `bounds` and `stamps` are the state."""
    now, (_, parts, entries, step) = len(history) - 1, history.shape
    groups = -(-entries // GROUP)
    sent, key = send(rows.sparkSession, history), new_key("history")

    def run(frames):
        books, moved = once("codes.history", key, lambda: (h := sent(), displacement(h, now)))
        for frame in frames:
            for begin in range(0, len(frame), _BLOCK):
                block = frame.iloc[begin : begin + _BLOCK]
                n = len(block)
                x = matrix(block["v"], width).astype(np.int64).reshape(n, parts, step)
                error = np.zeros(n, np.int64)
                if now:
                    own = np.frombuffer(bytearray(b"".join(block["code"])), np.uint8).reshape(n, parts)
                    bounds = np.frombuffer(bytearray(b"".join(block["bounds"])), np.float32).reshape(n, parts, groups)
                    stamps = np.frombuffer(bytearray(b"".join(block["stamps"])), np.uint8).reshape(n, parts, groups)
                else:
                    own, bounds, stamps = np.zeros((n, parts), np.uint8), np.zeros((n, parts, groups), np.float32), np.zeros((n, parts, groups), np.uint8)
                for p in range(parts):
                    if now:
                        _, nearest, _ = again(x[:, p], own[:, p], bounds[:, p], stamps[:, p], books[now, p], moved[:, p], now)
                    else:
                        own[:, p], bounds[:, p], nearest = first(x[:, p], books[now, p])
                    error += nearest
                yield block.assign(code=[r.tobytes() for r in own], bounds=[r.tobytes() for r in bounds], stamps=[r.tobytes() for r in stamps], error=error)

    return rows.mapInPandas(run, "vec_id long, label long, v binary, code binary, bounds binary, stamps binary, error long")


def _moved(rows: DataFrame, book: np.ndarray, width: int) -> np.ndarray:
    """The codebooks with each used entry at the floor of the mean of its parts."""
    parts, entries, step = book.shape

    def run(frames):
        sums, counts = np.zeros((parts, entries, step), np.int64), np.zeros((parts, entries), np.int64)
        for frame in frames:
            n = len(frame)
            x = matrix(frame["v"], width).astype(np.int64).reshape(n, parts, step)
            code = np.frombuffer(b"".join(frame["code"]), np.uint8).reshape(n, parts)
            for p in range(parts):
                np.add.at(sums[p], code[:, p], x[:, p])
                counts[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        for k in range(step):
            yield pd.DataFrame({"part": p, "entry": e, "k": k, "total": sums[p, e, k], "n": counts[p, e]})

    summed = rows.select("v", "code").mapInPandas(run, "part int, entry int, k int, total long, n long").groupBy("part", "entry", "k")
    book = book.copy()
    for p, e, k, total, n in summed.agg(F.sum("total"), F.sum("n")).collect():  # one row for each component of the codebooks
        book[p, e, k] = total // n
    return book


def compress(rows: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row (vec_id, `vector`, label) with a sound vector.

    `code` has two hex digits for each part, so there are 256 entries at most. The codebooks begin with the rows of the
    smallest vec_ids (equal ones by their integers; rows without a vec_id come last). With fewer rows than entries
    there are as many entries as rows. Vectors shorter than the longest, or than a multiple of `parts`, count as filled up with zeros.
    Rows whose vector is null or holds a null or non-finite component are left out; integers are held within 2^24 either
    way. Repeated rows are coded each; null labels form one class; other columns are not used; an empty table gives an
    empty one.
    """
    ship(__name__)
    if entries > 256:
        raise ValueError("a code has one byte for each part")
    spark = rows.sparkSession
    state = stage(sound_rows(rows, vector, vec_id=F.col("vec_id").cast("long"), label=F.col("label").cast("long")), "vectors")
    width = state.agg(F.max(F.length("v"))).first()[0]
    if width is None:
        return spark.createDataFrame([], _RESULT)
    step = max(1, -(-(width // 4) // parts))
    width = step * parts
    seeds = state.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()  # at most `entries` rows
    history = matrix([r[0] for r in seeds], width).astype(np.int64).reshape(1, len(seeds), parts, step).swapaxes(1, 2)
    for _ in range(rounds):
        state = stage(_assign(state, history, width), "coded")
        history = np.concatenate([history, _moved(state, history[-1], width)[None]])
    coded = stage(_assign(state, history, width).select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error"), "codes")
    digest = hashlib.sha256(",".join(map(str, history[-1].ravel().tolist())).encode()).hexdigest()
    totals = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def decompress(codes: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, v: the integers a code stands for, from `fitted`'s codebooks (parts, entries, part components)."""
    ship(__name__)
    sent, key = send(codes.sparkSession, codebooks), new_key("codebooks")

    def run(frames):
        books = once("codes.books", key, sent)
        for frame in frames:
            code = np.array([list(bytes.fromhex(c)) for c in frame["code"]], np.int64).reshape(len(frame), len(books))
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": list(books[np.arange(len(books)), code].reshape(len(frame), -1))})

    return codes.select("vec_id", "code").mapInPandas(run, "vec_id long, v array<long>")
