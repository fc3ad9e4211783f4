"""Keyed cooldown state for streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor

from ..session import ship

ship(__name__)


class Cooldown(StatefulProcessor):
    """Emit an alert only if its key has been silent for the cooldown; the state is one timestamp per key."""

    def __init__(self, keys: list[str]) -> None:
        self.keys = keys

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "tick bigint")

    def handleInputRows(self, key, rows, timerValues):
        # Alerts of a key arrive in batches in any order. Those too early for the state go at once; of the others only
        # numbers are held until the trigger's last batch, and put in order then.
        last = self.last.get()[0] if self.last.exists() else None
        held = []
        for pdf in rows:
            part = pdf[["tick", "id", "gap"]].to_numpy()
            held.append(part if last is None else part[part[:, 0] - last >= part[:, 2]])
        alerts = np.concatenate(held)
        alerts = alerts[np.lexsort((alerts[:, 1], alerts[:, 0]))]
        kept = []
        for tick, row, gap in alerts.tolist():
            if last is None or tick - last >= gap:
                kept.append((*key, row, tick))
                last = tick
        if kept:
            self.last.update((int(last),))
        yield pd.DataFrame(kept, columns=[*self.keys, "id", "tick"])

    def close(self) -> None:
        pass
