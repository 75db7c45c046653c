"""Logistic regression by Newton's method, on rows that stay where they are: each round sums the gradient and the curvature over tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(rows: np.ndarray) -> pd.DataFrame:
    """Rows of numbers as one row of a table of blocks (block binary), which `fit` reads many times."""
    return pd.DataFrame({"block": [np.ascontiguousarray(rows, dtype=np.float64).tobytes()]})


def fit(blocks: DataFrame, width: int, *, ridge: float, bias: bool = True, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias of the ridge-penalised logistic loss on all rows of blocks (see `packed`): `width` features and a 0 or 1.

    What a round sends to the driver is a sum for each pair of features, however many rows and tasks there are.
    """
    size = width + bias
    w = np.zeros(size)
    for _ in range(rounds):

        def sums(frames: Iterator[pd.DataFrame], w: np.ndarray = w) -> Iterator[pd.DataFrame]:
            total = np.zeros((size + 1, size))
            for f in frames:
                for block in f["block"]:
                    own = np.frombuffer(block, np.float64).reshape(-1, width + 1)
                    a, y = np.c_[own[:, :width], np.ones(len(own))][:, :size], own[:, width]
                    p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
                    total[0] += a.T @ (p - y)
                    total[1:] += (a * (p * (1 - p))[:, None]).T @ a
            yield pd.DataFrame({"i": np.arange(total.size), "v": total.ravel()})

        found = np.zeros(size * (size + 1))
        for r in blocks.select("block").mapInPandas(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            found[r["i"]] = r["v"]
        total = found.reshape(size + 1, size)
        step = np.linalg.solve(total[1:] + (ridge + 1e-9) * np.eye(size), total[0] + ridge * w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return w[:width], float(w[width]) if bias else 0.0
