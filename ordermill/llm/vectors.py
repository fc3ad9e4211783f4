"""Integer vectors that the operators on embeddings share.

A component x becomes floor(256 * x), x as double. A row whose vector is null, or holds a null or non-finite component,
takes no part. Integers beyond 2^24 either way are held at that bound, so that sums of squares stay within 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import ship

MOST = 1 << 24
SCALE = 256


def integers(vectors) -> tuple[np.ndarray, list[bytes]]:
    """Which vectors are sound, and the packed 32-bit integers of those."""
    sound, packed = np.zeros(len(vectors), bool), []
    for i, v in enumerate(vectors):
        if v is None:
            continue
        x = np.asarray(v, np.float64)
        if not np.isfinite(x).all():  # a null component is not a number here
            continue
        sound[i] = True
        with np.errstate(over="ignore"):
            packed.append(np.clip(np.floor(x * SCALE), -MOST, MOST).astype(np.int32).tobytes())
    return sound, packed


def sound_rows(rows: DataFrame, vector: str = "embedding", **columns: Column) -> DataFrame:
    """The given columns and `v`, the packed integers, of every row with a sound vector."""
    ship(__name__)
    asked = rows.select(F.col(vector).alias("v"), *[c.alias(name) for name, c in columns.items()])

    def run(frames):
        for frame in frames:
            sound, packed = integers(frame["v"])
            frame = frame[sound]
            yield frame.assign(v=pd.Series(packed, index=frame.index, dtype=object))

    schema = ", ".join(f"`{f.name}` {'binary' if f.name == 'v' else f.dataType.simpleString()}" for f in asked.schema)
    return asked.mapInPandas(run, schema)


def matrix(packed, width: int) -> np.ndarray:
    """Rows of `width` integers; a shorter vector is filled up with zeros."""
    flat = b"".join(p if len(p) == 4 * width else p.ljust(4 * width, b"\0") for p in packed)
    return np.frombuffer(flat, np.int32).reshape(-1, width)
