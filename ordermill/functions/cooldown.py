"""Per-range steps of the cooldown fold (see `operators.alerting`), on sorted integer ticks."""

from __future__ import annotations

import numpy as np
import pandas as pd

from ..session import ship

ship(__name__)


def _last_emitted(ticks: np.ndarray, gap: int) -> np.ndarray:
    """For each candidate, the last emission of the chain that starts with it."""
    n = len(ticks)
    target = np.searchsorted(ticks, ticks + gap)
    nxt = np.where(target < n, target, np.arange(n))
    while True:
        jumped = nxt[nxt]
        if np.array_equal(jumped, nxt):
            return nxt
        nxt = jumped


def summarise(keys: list[str]):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        ticks = np.sort(pdf["tick"].to_numpy())
        gap = int(pdf["gap"].iloc[0])
        entries = min(int(np.searchsorted(ticks, ticks[0] + gap)) + 1, len(ticks))
        leave = ticks[_last_emitted(ticks, gap)[:entries]]
        keep = np.append(leave[1:] != leave[:-1], True)
        row = {k: pdf[k].iloc[0] for k in keys}
        row.update(chunk=int(pdf["chunk"].iloc[0]), enter=ticks[:entries][keep].tolist(), leave=leave[keep].tolist())
        return pd.DataFrame([row])

    return fn


def chain(keys: list[str]):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        ready = np.iinfo(np.int64).min
        out = []
        gap = int(pdf["gap"].iloc[0])
        for r in pdf.sort_values("chunk").itertuples(index=False):
            out.append({**{k: getattr(r, k) for k in keys}, "chunk": r.chunk, "ready": ready})
            at = int(np.searchsorted(r.enter, ready))
            if at < len(r.enter):
                ready = int(r.leave[at]) + gap
        return pd.DataFrame(out)

    return fn


def emit(keys: list[str]):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        ticks = np.sort(pdf["tick"].to_numpy())
        gap, ready = int(pdf["gap"].iloc[0]), int(pdf["ready"].iloc[0])
        kept, i = [], int(np.searchsorted(ticks, ready))
        while i < len(ticks):
            kept.append(ticks[i])
            i = int(np.searchsorted(ticks, ticks[i] + gap))
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in keys}, "tick": np.array(kept, dtype="int64")})

    return fn
