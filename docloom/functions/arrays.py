"""Array helpers that need a running state: one linear Arrow pass each (a fold that appends is quadratic)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.text import col, let


def starts_of(lengths) -> Column:
    """array<int>: where each piece begins if pieces of these lengths follow one another."""

    @F.pandas_udf("array<int>")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else (np.cumsum(v) - v).astype(np.int32))

    return run(col(lengths))


def packed(lengths, max_items: int, max_total: int) -> Column:
    """array<int>: number of the batch of each piece, packed greedily in order; 0 means no limit on the total."""

    def one(values):
        if values is None:
            return None
        out, number, items, total = np.empty(len(values), np.int32), 0, 0, 0
        for i, size in enumerate(values.tolist()):
            if items and (items >= max_items or (max_total > 0 and total + size > max_total)):
                number, items, total = number + 1, 0, 0
            items, total = items + 1, total + size
            out[i] = number
        return out

    @F.pandas_udf("array<int>")
    def run(values: pd.Series) -> pd.Series:
        return values.map(one)

    return run(col(lengths))


def first_places(keys: Column) -> Column:
    """array<int>: places (from 0) where a key occurs for the first time, in order; by sorting."""
    places = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    return let(places, lambda ps: F.array_sort(F.transform(
        F.filter(ps, lambda p, n: (n == 0) | ~F.get(ps, n - 1)["k"].eqNullSafe(p["k"])), lambda p: p["i"])))


def last_before(offsets, limits, inclusive: bool = True) -> Column:
    """array<int>: for each limit the place (from 0) of the last offset up to it (below it if not ``inclusive``), -1 if none.

    Offsets ascend; both arrays are merged once, so a row costs what it holds.
    """
    side = "right" if inclusive else "left"

    @F.pandas_udf("array<int>")
    def run(found: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([
            None if o is None or w is None else (np.searchsorted(o, w, side=side) - 1).astype(np.int32)
            for o, w in zip(found, wanted)
        ])

    return run(col(offsets), col(limits))


def last_set(marks) -> Column:
    """array<int>: for each place the last place up to it that is marked, -1 if none."""

    @F.pandas_udf("array<int>")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else np.maximum.accumulate(np.where(v, np.arange(len(v)), -1)).astype(np.int32))

    return run(col(marks))
