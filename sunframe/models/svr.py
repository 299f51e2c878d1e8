"""Kernel support-vector regression: one model a step of the horizon and block of training rows.

MLlib has none. The dual is solved by coordinate descent with the bias inside the kernel. A kernel
matrix grows with the square of its rows, so training rows are cut into blocks in time order; blocks
are fitted in parallel and their forecasts averaged by size. With one block it is the plain machine.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.sources.scratch import materialised

KERNELS = ("linear", "poly", "rbf", "sigmoid", "precomputed")
#: Training rows of one kernel matrix.
BLOCK = 2000
#: About as many rows are scored by a task at once.
CHUNK = 4096


def kernel(a: np.ndarray, b: np.ndarray, kind: str, gamma: float, degree: int, coef0: float) -> np.ndarray:
    if kind == "linear":
        return a @ b.T
    if kind == "poly":
        return (gamma * (a @ b.T) + coef0) ** degree
    if kind == "sigmoid":
        return np.tanh(gamma * (a @ b.T) + coef0)
    if kind == "rbf":
        square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        return np.exp(-gamma * np.maximum(square, 0))
    raise ValueError(f"kernel {kind!r} is none of {', '.join(KERNELS)}")


def gamma_of(x: np.ndarray, gamma: str | float) -> float:
    if gamma == "scale":
        return 1.0 / (x.shape[1] * x.var()) if x.size and x.var() > 0 else 1.0
    return 1.0 / x.shape[1] if gamma == "auto" else float(gamma)


def solve(k: np.ndarray, y: np.ndarray, c: float, epsilon: float, sweeps: int = 60, tolerance: float = 1e-5) -> np.ndarray:
    """Dual weights in [-c, c] that minimise the regularised epsilon-insensitive loss; ``k`` holds the bias."""
    beta, f, diagonal = np.zeros(len(y)), np.zeros(len(y)), np.maximum(np.diag(k), 1e-12)
    for _ in range(sweeps):
        largest = 0.0
        for i in range(len(y)):
            rest = y[i] - (f[i] - diagonal[i] * beta[i])
            new = np.clip(np.sign(rest) * max(abs(rest) - epsilon, 0.0) / diagonal[i], -c, c)
            change = new - beta[i]
            if change:
                f += change * k[:, i]
                beta[i] = new
                largest = max(largest, abs(change))
        if largest < tolerance * max(1.0, c):
            break
    return beta


def _fit(settings: dict[str, Any]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = np.array(pdf["x"].tolist(), float), pdf["y"].to_numpy(float)
        gamma = gamma_of(x, settings["gamma"])
        k = x[:, : len(x)] if settings["kernel"] == "precomputed" else kernel(x, x, settings["kernel"], gamma, settings["degree"], settings["coef0"])
        beta = solve(k + 1.0, y, settings["C"], settings["epsilon"])
        used = np.flatnonzero(beta)
        return pd.DataFrame([{"h": int(pdf["h"].iloc[0]), "block": int(pdf["block"].iloc[0]), "rows": len(y), "gamma": gamma, "beta": beta[used].tolist(), "support": x[used].tolist()}])

    return run


def _score(inputs: int, horizon: int, settings: dict[str, Any]):
    def run(rows: pd.DataFrame, machines: pd.DataFrame) -> pd.DataFrame:
        x = np.array(rows["x"].tolist(), float).reshape(len(rows), inputs)
        sums, weights = np.zeros((len(x), horizon)), np.zeros(horizon)
        for h, n, gamma, beta, support in zip(*(machines[c] for c in ("h", "rows", "gamma", "beta", "support")), strict=True):
            if len(beta):
                vectors = np.array(support.tolist(), float).reshape(len(beta), inputs)
                sums[:, h] += n * ((kernel(x, vectors, settings["kernel"], gamma, settings["degree"], settings["coef0"]) + 1.0) @ beta)
            weights[h] += n
        return pd.DataFrame({"_key": rows["_key"], "sums": list(sums), "weights": [weights] * len(x)})

    return run


class SVRForecaster:
    """``machines``: a table of (h, block, rows, gamma, beta, support), which never passes through the driver."""

    SCHEMA = "h int, block long, rows long, gamma double, beta array<double>, support array<array<double>>"

    def __init__(self, inputs: Sequence[str], horizon: int, settings: dict[str, Any], machines: DataFrame) -> None:
        self.inputs, self.horizon, self.settings, self.machines = list(inputs), horizon, settings, machines

    @classmethod
    def fit(cls, train: DataFrame, inputs: Sequence[str], outputs: Sequence[str], settings: dict[str, Any], block: int = BLOCK) -> SVRForecaster:
        """``train`` needs ``sample_id``."""
        x = F.array(*[F.col(f"`{c}`").cast("double") for c in inputs])
        y = F.array(*[F.col(f"`{c}`").cast("double") for c in outputs])
        rows = train.select(x.alias("x"), F.floor(F.col("sample_id") / block).alias("block"), F.posexplode(y).alias("h", "y"))
        fitted = rows.groupBy("h", "block").applyInPandas(_fit(settings), cls.SCHEMA)
        return cls(inputs, len(outputs), settings, materialised(fitted, "machines"))

    def predict(self, df: DataFrame, key: str = "sample_id") -> DataFrame:
        """``df`` with ``forecast array<double>``; ``key`` tells its rows apart.

        Rows are dealt to chunks and machines lie in blocks; a task scores one chunk by the machines of one
        block, and the sums meet by key. Without machines forecasts are zero.
        """
        rows = df.select(F.col(key).alias("_key"), F.array(*[F.col(f"`{c}`").cast("double") for c in self.inputs]).alias("x"))
        chunks, blocks = -(-rows.count() // CHUNK), self.machines.agg(F.max("block") + 1).first()[0]
        zeros = F.array(*[F.lit(0.0)] * self.horizon)
        if not chunks or not blocks:
            return df.withColumn("forecast", zeros)
        by = ["_chunk", "block"]
        dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64("_key"), F.lit(chunks))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
        copied = self.machines.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>")))
        score = _score(len(self.inputs), self.horizon, self.settings)
        schema = f"_key {rows.schema['_key'].dataType.simpleString()}, sums array<double>, weights array<double>"
        parts = dealt.groupBy(*by).cogroup(copied.groupBy(*by)).applyInPandas(score, schema)
        mean = [F.sum(F.col("sums")[i]) / F.greatest(F.sum(F.col("weights")[i]), F.lit(1.0)) for i in range(self.horizon)]
        made = parts.groupBy("_key").agg(F.array(*mean).alias("forecast"))
        return df.join(made, df[key] == made["_key"]).drop("_key")

    def save(self, path: str) -> None:
        self.machines.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, inputs: Sequence[str], horizon: int, settings: dict[str, Any]) -> SVRForecaster:
        return cls(inputs, horizon, settings, spark.read.schema(cls.SCHEMA).parquet(path))
