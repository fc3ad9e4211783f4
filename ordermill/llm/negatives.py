"""Hard-negative mining by slots: overlapping score windows of an anchor are answered from disjoint slots of scores.

Every positive p of an anchor asks for the best negatives with a score between 50 % and 95 % of its own. The upper limits
of an anchor's positives cut the scores into disjoint slots: slot j holds the scores above the next lower limit and not
above limit j. A task keeps the best k negatives of each slot (its combiner), Spark keeps the best k of all tasks, and one
walk over an anchor's slots from the lowest limit up merges them: the running best k at limit j are the best k of all
scores not above it, and those of them that reach the window's lower end are the answer. A candidate is looked at once,
however many windows it lies in, and no window sorts its own candidates.

Anchors go in blocks of `at_once`: one block's vectors are sent to the tasks (a bounded broadcast), and two passes read the
written rows, one for the positives and one for the slots. So the work is anchors times rows, as an exact search has to be,
while memory and the shuffle are bounded by block, task and k.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import new_key, once, send, ship, stage
from .vectors import matrix, sound_rows

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
AT_ONCE, _ROWS, _ANCHORS = 8192, 2048, 1024
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FLOOR = np.iinfo(np.int64).min


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: by floating point where no sum can leave its 53 bits."""
    most = max(int(np.abs(anchors).max(initial=0)), 1) * max(int(np.abs(rows).max(initial=0)), 1) * max(anchors.shape[1], 1)
    if most < 1 << 53:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


def best(group: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group: higher scores first, then smaller ids; sorted by group."""
    order = np.lexsort((ident, -score, group))
    g = group[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    place = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
    return order[place < k]


class Combiner:
    """The best k (score, id) of each group so far, and the score a group's next candidate has to reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor.copy(), k
        self.group, self.score, self.ident = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ident = np.r_[self.group, group], np.r_[self.score, score], np.r_[self.ident, ident]
        kept = best(group, score, ident, self.k)
        self.group, self.score, self.ident = group[kept], score[kept], ident[kept]
        found, n = np.unique(self.group, return_counts=True)
        last = np.cumsum(n) - 1
        full = n == self.k  # of these the worst kept score is the one to reach; equal scores may win by their ids
        self.floor[found[full]] = np.maximum(self.floor[found[full]], self.score[last[full]])


def limits(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest whole score of the window of each positive score."""
    return -((-LOW * positive) // 100), (HIGH * positive) // 100


def slots_of(positives: pd.DataFrame, count: int, width: int = POSITIVES) -> tuple[np.ndarray, np.ndarray]:
    """[anchor, slot]: the highest and the least score of each slot, by descending limits; unused slots are empty.

    The last slot ends at the lowest window's lower end, for no window asks for less. Windows of negative positives are empty.
    """
    upper, least = np.full((count, width), _FLOOR), np.zeros((count, width), np.int64)
    for a, part in positives.groupby("a", sort=False):
        low, high = limits(part["score"].to_numpy(np.int64))
        some = low <= high
        if some.any():
            cuts = np.unique(high[some])[::-1]
            upper[a, : len(cuts)] = cuts
            least[a, : len(cuts)] = np.r_[cuts[1:] + 1, low[some].min()]
    return upper, least


def windows(scores_of: list[int], slots: dict[int, list[tuple[int, int]]], k: int = NEGATIVES) -> list[list[tuple[int, int]]]:
    """For each positive score its window's best k (score, id), from the best k of each slot (keyed by upper limit)."""
    running, at = [], {}
    for cut in sorted({HIGH * p // 100 for p in scores_of}):
        running = sorted(running + slots.get(cut, []), key=lambda c: (-c[0], c[1]))[:k]
        at[cut] = running
    return [[c for c in at[HIGH * p // 100] if 100 * c[0] >= LOW * p and 100 * c[0] <= HIGH * p] for p in scores_of]


def _blocks(frames, width: int):
    """Ids, labels and integer vectors of up to `_ROWS` rows."""
    for frame in frames:
        for begin in range(0, len(frame), _ROWS):
            block = frame.iloc[begin : begin + _ROWS]
            yield block["vec_id"].to_numpy(np.int64), block["label"].to_numpy(np.int64), matrix(block["v"], width)


def _positives(rows: DataFrame, load, key: str, width: int, k: int) -> DataFrame:
    """a, vec_id, score: the best k other rows of an anchor's label, for each task."""

    def run(frames):
        ids, labels, vectors = once("negatives.anchors", key, load)
        kept = Combiner(np.full(len(ids), _FLOOR), k)
        places = {label: np.flatnonzero(labels == label) for label in np.unique(labels)}
        for row_ids, row_labels, x in _blocks(frames, width):
            for label in np.unique(row_labels):
                some, here = places.get(label, ()), np.flatnonzero(row_labels == label)
                for begin in range(0, len(some), _ANCHORS):
                    a = some[begin : begin + _ANCHORS]
                    s = scores(vectors[a], x[here])
                    i, j = np.nonzero((s >= kept.floor[a][:, None]) & (row_ids[here][None] != ids[a][:, None]))
                    kept.add(a[i], s[i, j], row_ids[here][j])
        yield pd.DataFrame({"a": kept.group, "vec_id": kept.ident, "score": kept.score})

    return rows.mapInPandas(run, "a long, vec_id long, score long")


def _slots(rows: DataFrame, load, key: str, width: int, k: int) -> DataFrame:
    """a, cut, vec_id, score: the best k rows of another label in each slot, for each task."""

    def run(frames):
        ids, labels, vectors, upper, least = once("negatives.slots", key, load)
        used = upper.shape[1]
        kept = Combiner(least.ravel(), k)
        for row_ids, row_labels, x in _blocks(frames, width):
            for begin in range(0, len(ids), _ANCHORS):
                a = np.arange(begin, min(begin + _ANCHORS, len(ids)))
                s = scores(vectors[a], x)
                other = labels[a][:, None] != row_labels[None]
                for slot in range(used):
                    floor = kept.floor[a * used + slot]
                    i, j = np.nonzero((s <= upper[a, slot][:, None]) & (s >= floor[:, None]) & other)
                    kept.add(a[i] * used + slot, s[i, j], row_ids[j])
        yield pd.DataFrame({"a": kept.group // used, "cut": upper.ravel()[kept.group], "vec_id": kept.ident, "score": kept.score})

    return rows.mapInPandas(run, "a long, cut long, vec_id long, score long")


def _best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    """The best k of each group; a group has at most k rows from a task, and Spark drops the rest before its shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def mine(rows: DataFrame, anchor, vector: str = "embedding", label: str | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, at_once: int = AT_ONCE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (vec_id, `vector`, label).

    `anchor` is a condition on rows, `label` an SQL expression for the label (the column of that name, if none is given).
    Rows without vec_id or label, or whose vector is null or holds a null or non-finite component, take no part; integers are
    held within 2^24 either way. An anchor's "other" rows are those of another vec_id. Rows that share a vec_id take part each: a
    repeated anchor is answered for each of its rows. Equal scores go by the smaller vec_id. A window that no
    negative lies in, and an anchor without positives, give no rows; an empty table gives an empty one. Shorter vectors are
    filled up with zeros; other columns are not used.
    """
    ship(__name__)
    spark = rows.sparkSession
    of = (F.expr(label) if label else F.col("label")).cast("long")
    asked = rows.where(F.col("vec_id").isNotNull() & of.isNotNull())
    sound = sound_rows(asked, vector, vec_id=F.col("vec_id").cast("long"), label=of, anchor=F.coalesce(anchor, F.lit(False)))
    written = stage(sound.withColumn("row", F.when(F.col("anchor"), F.monotonically_increasing_id())), "vectors")
    width, count = written.agg(F.max(F.length("v")), F.count("row")).first()
    if not count:
        return spark.createDataFrame([], _RESULT)
    width //= 4
    blocks = -(-count // at_once)
    found, candidates = None, written.select("vec_id", "label", "v")
    for b in range(blocks):
        inside = written.where("anchor").where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b)
        chosen = inside.select("vec_id", "label", "v").orderBy("vec_id", "label", "v").collect()  # about `at_once` rows
        if not chosen:
            continue
        ids, labels = (np.array([r[i] for r in chosen], np.int64) for i in (0, 1))
        vectors = matrix([bytes(r[2]) for r in chosen], width)
        near = _best(_positives(candidates, send(spark, (ids, labels, vectors)), new_key("anchors"), width, positives), positives, "a").toPandas()
        upper, least = slots_of(near, len(ids), positives)
        tops = _best(_slots(candidates, send(spark, (ids, labels, vectors, upper, least)), new_key("slots"), width, negatives), negatives, "a", "cut")
        told = stage(tops.groupBy("a").agg(F.collect_list(F.struct("cut", "score", "vec_id")).alias("tops")), "slots")
        answers = _answer(told, send(spark, (ids, near)), new_key("positives"), negatives)
        found = answers if found is None else found.unionByName(answers)
    return found if found is not None else spark.createDataFrame([], _RESULT)


def _answer(told: DataFrame, load, key: str, k: int) -> DataFrame:
    """All windows of each anchor, from the best of its slots."""

    def prepare():
        ids, near = load()
        near = near.sort_values(["a", "score", "vec_id"], ascending=[True, False, True])
        return ids, {a: list(zip(g["vec_id"], g["score"], strict=True)) for a, g in near.groupby("a")}

    def run(frames):
        ids, positives = once("negatives.positives", key, prepare)
        for frame in frames:
            out = []
            for a, tops in zip(frame["a"], frame["tops"], strict=True):
                slots: dict[int, list] = {}
                for t in tops:
                    slots.setdefault(t["cut"], []).append((t["score"], t["vec_id"]))
                mine_of = positives.get(a, [])
                for (ident, score), window in zip(mine_of, windows([s for _, s in mine_of], slots, k), strict=True):
                    out += [(ids[a], ident, rank, c[1], score, c[0]) for rank, c in enumerate(window, 1)]
            yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return told.mapInPandas(run, _RESULT)
