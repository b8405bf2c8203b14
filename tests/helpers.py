"""Small frames and plain-Python twins of the operators."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

DAY0 = dt.date(2024, 1, 1)


def day(n: int) -> dt.date:
    return DAY0 + dt.timedelta(days=n)


def series(spark, data: dict[tuple[int, str], list], start: int = 0):
    """{(store, family): [values]} as a daily frame starting at day `start`."""
    rows = [
        (day(start + i), store, family, None if v is None else float(v))
        for (store, family), values in data.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double")


def random_series(seed: int, pairs: int, longest: int) -> dict[tuple[int, str], list]:
    rng = np.random.default_rng(seed)
    out = {}
    for p in range(pairs):
        n = int(rng.integers(1, longest))
        values = [None if rng.random() < 0.1 else float(v) for v in rng.integers(0, 50, n)]
        out[(p % 3 + 1, f"f{p // 3}")] = values
    return out


def rolling_twin(data: dict[tuple[int, str], list], window: int, carry: bool) -> dict:
    """{(pair, index): (mean, std)}; `carry` lets frames run across pairs."""
    shifted, owners = [], []
    for pair in sorted(data):
        values = [np.nan if v is None else v for v in data[pair]]
        shifted += [np.nan, *values[:-1]]
        owners += [(pair, i) for i in range(len(values))]
    out = {}
    for pos, (pair, i) in enumerate(owners):
        first = pos - window + 1 if carry else max(pos - window + 1, pos - i)
        frame = pd.Series(shifted[max(first, 0) : pos + 1]).dropna()
        mean = frame.mean() if len(frame) else None
        std = frame.std(ddof=1) if len(frame) > 1 else None
        out[(pair, i)] = (mean, std)
    return out
