"""Small neural networks in NumPy: convolutional, recurrent and both, with mini-batch training.

Samples are (steps, features). Training never shuffles. Over several partitions each trains on its
own rows from the same weights, and the weights are averaged by rows after every epoch; with one
partition that is plain mini-batch descent.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one partition trains on.
PARTITION_ROWS = 100_000
MASK = 999.0


def _activate(name: str | None, z: np.ndarray) -> np.ndarray:
    if name is None or name == "linear":
        return z
    if name == "tanh":
        return np.tanh(z)
    if name == "relu":
        return np.maximum(z, 0)
    if name == "sigmoid":
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    if name == "elu":
        return np.where(z > 0, z, np.expm1(np.minimum(z, 0)))
    raise ValueError(f"no activation {name!r}")


def _slope(name: str | None, y: np.ndarray) -> np.ndarray:
    """Derivative by the output."""
    if name is None or name == "linear":
        return np.ones_like(y)
    if name == "tanh":
        return 1 - y * y
    if name == "relu":
        return (y > 0).astype(y.dtype)
    if name == "sigmoid":
        return y * (1 - y)
    return np.where(y > 0, 1.0, y + 1.0)


def _glorot(r: np.random.Generator, *shape: int) -> np.ndarray:
    limit = np.sqrt(6 / (np.prod(shape[:-1]) + shape[-1]))
    return r.uniform(-limit, limit, shape)


class Dense:
    """Applied to the last axis."""

    def __init__(self, n_in: int, n_out: int, activation: str | None, r: np.random.Generator) -> None:
        self.activation, self.weights = activation, [_glorot(r, n_in, n_out), np.zeros(n_out)]

    def forward(self, x: np.ndarray) -> np.ndarray:
        self._x, self._y = x, _activate(self.activation, x @ self.weights[0] + self.weights[1])
        return self._y

    def backward(self, g: np.ndarray) -> np.ndarray:
        g = g * _slope(self.activation, self._y)
        flat_x, flat_g = self._x.reshape(-1, self._x.shape[-1]), g.reshape(-1, g.shape[-1])
        self.gradients = [flat_x.T @ flat_g, flat_g.sum(0)]
        return g @ self.weights[0].T


class Conv1D:
    """Over time, with as many steps out as in: ``same`` pads both ends, ``causal`` the start."""

    def __init__(self, n_in: int, filters: int, size: int, padding: str, activation: str, r: np.random.Generator) -> None:
        self.size, self.activation = size, activation
        self.left = size - 1 if padding == "causal" else (size - 1) // 2
        self.weights = [_glorot(r, size, n_in, filters), np.zeros(filters)]

    def forward(self, x: np.ndarray) -> np.ndarray:
        steps = x.shape[1]
        self._padded = np.pad(x, ((0, 0), (self.left, self.size - 1 - self.left), (0, 0)))
        z = sum(self._padded[:, k : k + steps] @ self.weights[0][k] for k in range(self.size)) + self.weights[1]
        self._y = _activate(self.activation, z)
        return self._y

    def backward(self, g: np.ndarray) -> np.ndarray:
        g = g * _slope(self.activation, self._y)
        steps, back = g.shape[1], np.zeros_like(self._padded)
        w = np.stack([np.einsum("bti,bto->io", self._padded[:, k : k + steps], g) for k in range(self.size)])
        for k in range(self.size):
            back[:, k : k + steps] += g @ self.weights[0][k].T
        self.gradients = [w, g.sum((0, 1))]
        return back[:, self.left : self.left + steps]


class MaxPool1D:
    """Windows of ``size`` steps side by side; the last may be short."""

    weights: list[np.ndarray] = []
    gradients: list[np.ndarray] = []

    def __init__(self, size: int) -> None:
        self.size = size

    def forward(self, x: np.ndarray) -> np.ndarray:
        steps = -(-x.shape[1] // self.size)
        spare = steps * self.size - x.shape[1]
        self._left, self._shape = spare // 2, x.shape
        padded = np.pad(x, ((0, 0), (self._left, spare - self._left), (0, 0)), constant_values=-np.inf)
        parts = padded.reshape(len(x), steps, self.size, x.shape[2])
        self._at = parts.argmax(2)
        return parts.max(2)

    def backward(self, g: np.ndarray) -> np.ndarray:
        back = np.zeros((g.shape[0], g.shape[1], self.size, g.shape[2]))
        np.put_along_axis(back, self._at[:, :, None, :], g[:, :, None, :], 2)
        return back.reshape(g.shape[0], -1, g.shape[2])[:, self._left : self._left + self._shape[1]]


class Flatten:
    weights: list[np.ndarray] = []
    gradients: list[np.ndarray] = []

    def forward(self, x: np.ndarray) -> np.ndarray:
        self._shape = x.shape
        return x.reshape(len(x), -1)

    def backward(self, g: np.ndarray) -> np.ndarray:
        return g.reshape(self._shape)


class LSTM:
    """Long short-term memory; steps that are masked through (all features the mask value) leave its state."""

    def __init__(self, n_in: int, units: int, activation: str, sequences: bool, uniform: bool, masked: bool, r: np.random.Generator) -> None:
        self.units, self.activation, self.sequences, self.masked = units, activation, sequences, masked
        kernel = r.uniform(-0.05, 0.05, (n_in, 4 * units)) if uniform else _glorot(r, n_in, 4 * units)
        recurrent = np.linalg.qr(r.standard_normal((4 * units, units)))[0].T
        self.weights = [kernel, recurrent, np.zeros(4 * units)]

    def forward(self, x: np.ndarray) -> np.ndarray:
        n, steps, u, act = len(x), x.shape[1], self.units, self.activation
        h, c, self._tape, outs = np.zeros((n, u)), np.zeros((n, u)), [], []
        for t in range(steps):
            z = x[:, t] @ self.weights[0] + h @ self.weights[1] + self.weights[2]
            i, f, o = (_activate("sigmoid", z[:, k * u : (k + 1) * u]) for k in (0, 1, 3))
            g = _activate(act, z[:, 2 * u : 3 * u])
            live = ~np.all(x[:, t] == MASK, axis=1, keepdims=True) if self.masked else np.ones((n, 1), bool)
            c_new = np.where(live, f * c + i * g, c)
            a = _activate(act, c_new)
            h_new = np.where(live, o * a, h)
            self._tape.append((x[:, t], h, c, i, f, g, o, a, live))
            h, c = h_new, c_new
            outs.append(h)
        return np.stack(outs, 1) if self.sequences else h

    def backward(self, grad: np.ndarray) -> np.ndarray:
        u, act, steps = self.units, self.activation, len(self._tape)
        dk, dr, db = (np.zeros_like(w) for w in self.weights)
        back = np.zeros((grad.shape[0], steps, self.weights[0].shape[0]))
        dh, dc = np.zeros((grad.shape[0], u)), np.zeros((grad.shape[0], u))
        for t in range(steps - 1, -1, -1):
            x, h, c, i, f, g, o, a, live = self._tape[t]
            dh = dh + (grad[:, t] if self.sequences else grad if t == steps - 1 else 0)
            held_h, held_c = np.where(live, 0, dh), np.where(live, 0, dc)
            dh, dc = np.where(live, dh, 0), np.where(live, dc, 0)
            dc = dc + dh * o * _slope(act, a)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dc * i * _slope(act, g), dh * a * o * (1 - o)], 1)
            dk, dr, db = dk + x.T @ dz, dr + h.T @ dz, db + dz.sum(0)
            back[:, t] = dz @ self.weights[0].T
            dh, dc = dz @ self.weights[1].T + held_h, dc * f + held_c
        self.gradients = [dk, dr, db]
        return back


class Network:
    """A stack of layers made from a model's settings."""

    def __init__(self, model: str, steps: int, features: int, horizon: int, settings: dict[str, Any], seed: int = 0) -> None:
        self.spec = {"model": model, "steps": steps, "features": features, "horizon": horizon, "settings": settings, "seed": seed}
        s, r = settings, np.random.default_rng(seed)
        self.layers: list[Any] = []
        n = features

        def dense(width: int, activation: str | None) -> None:
            nonlocal n
            if width:
                self.layers.append(Dense(n, width, activation, r))
                n = width

        if model in ("CNN", "CNN_LSTM"):
            causal = model == "CNN_LSTM"
            self.layers.append(Conv1D(n, s["filters"], s["kernel_size"], "causal" if causal else "same", s["cnn_activation" if causal else "activation"], r))
            n = s["filters"]
            dense(s["dense"][0], None)
            self.layers.append(MaxPool1D(s["pool_size"]))
            dense(s["dense"][1], "relu")
        if model == "CNN":
            self.layers.append(Flatten())
            n *= -(-steps // s["pool_size"])
            dense(horizon, s["activation"])
        elif model == "CNN_LSTM":
            for k, units in enumerate(s["neurons"][:2]):
                self.layers.append(LSTM(n, units, s["lstm_activation"], k == 0, k == 0, k == 0, r))
                n = units
            dense(horizon, "sigmoid")
        elif model == "LSTM":
            dense(s["dense"][0], None)
            count = len(s["neurons"])
            for k, units in enumerate(s["neurons"]):
                self.layers.append(LSTM(n, units, s["activation"], k < count - 1, k == 0, k == 0 and not s["dense"][0], r))
                n = units
            dense(s["dense"][1] if count > 1 else 0, "relu")
            dense(horizon, None)
        elif model != "CNN":
            raise ValueError(f"no network {model!r}")

    @property
    def weights(self) -> list[np.ndarray]:
        return [w for layer in self.layers for w in layer.weights]

    def set_weights(self, values: list[np.ndarray]) -> None:
        for w, v in zip(self.weights, values, strict=True):
            w[...] = v

    def forward(self, x: np.ndarray) -> np.ndarray:
        for layer in self.layers:
            x = layer.forward(x)
        return x

    def loss(self, x: np.ndarray, y: np.ndarray) -> float:
        gap = self.forward(x) - y
        return float(np.mean(np.abs(gap) if self.spec["settings"]["loss"] == "mean_absolute_error" else gap * gap)) if len(x) else float("nan")

    def step(self, x: np.ndarray, y: np.ndarray) -> float:
        """Forward and backward over one batch: gradients lie in the layers."""
        gap = self.forward(x) - y
        absolute = self.spec["settings"]["loss"] == "mean_absolute_error"
        g = (np.sign(gap) if absolute else 2 * gap) / gap.size
        for layer in reversed(self.layers):
            g = layer.backward(g)
        return float(np.mean(np.abs(gap) if absolute else gap * gap))

    def train_epoch(self, x: np.ndarray, y: np.ndarray, moments: list[np.ndarray], done: int) -> tuple[float, int]:
        """One pass in order; ``moments`` are two arrays a weight, ``done`` the batches so far."""
        s, losses = self.spec["settings"], []
        adam = s["optimizer"].lower() == "adam"
        for at in range(0, len(x), s["n_batch"]):
            losses.append(self.step(x[at : at + s["n_batch"]], y[at : at + s["n_batch"]]))
            done += 1
            gradients = [g for layer in self.layers for g in layer.gradients]
            for k, (w, g) in enumerate(zip(self.weights, gradients, strict=True)):
                m, v = moments[2 * k], moments[2 * k + 1]
                if adam:
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= 0.001 * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.999**done)) + 1e-7)
                else:
                    v += 0.1 * (g * g - v)
                    w -= 0.001 * g / (np.sqrt(v) + 1e-7)
        return float(np.mean(losses)) if losses else 0.0, done


def _blob(arrays: list[np.ndarray]) -> bytes:
    return np.concatenate([a.ravel() for a in arrays]).tobytes() if arrays else b""


def _unblob(blob: bytes, like: list[np.ndarray]) -> list[np.ndarray]:
    flat, out, at = np.frombuffer(blob), [], 0
    for a in like:
        out.append(flat[at : at + a.size].reshape(a.shape).copy())
        at += a.size
    return out


def _arrays(batches: Iterator[pa.RecordBatch], spec: dict[str, Any]) -> tuple[np.ndarray, np.ndarray]:
    xs, ys = [np.zeros((0, spec["steps"], spec["features"]))], [np.zeros((0, spec["horizon"]))]
    for b in batches:
        xs.append(np.array(b.column(0).flatten().flatten(), float).reshape(len(b), spec["steps"], spec["features"]))
        ys.append(np.array(b.column(1).flatten(), float).reshape(len(b), spec["horizon"]))
    return np.concatenate(xs), np.concatenate(ys)


class NetworkForecaster:
    """``predict`` adds ``forecast array<double>`` to tensors (``x``, ``y``)."""

    def __init__(self, network: Network, history: list[tuple[int, float, float]]) -> None:
        self.network, self.history = network, history

    @classmethod
    def fit(cls, train: DataFrame, validation: DataFrame, model: str, steps: int, features: int, horizon: int, settings: dict[str, Any], seed: int = 0) -> NetworkForecaster:
        """``train`` needs ``sample_id, x, y``: rows are dealt to partitions by range and kept in order."""
        net = Network(model, steps, features, horizon, settings, seed)
        n = train.count()
        parts = max(1, -(-n // PARTITION_ROWS))
        rows = train.repartitionByRange(parts, "sample_id").sortWithinPartitions("sample_id").select("x", "y").persist()
        held = validation.select("x", "y").persist()
        zeros = [np.zeros_like(w) for w in net.weights for _ in (0, 1)]
        state, done, history = _blob(net.weights + zeros), 0, []
        for epoch in range(settings["epochs"]):
            spec, now, batches_done = net.spec, state, done

            def one(batches: Iterator[pa.RecordBatch], spec=spec, now=now, batches_done=batches_done) -> Iterator[pa.RecordBatch]:
                own = Network(**spec)
                x, y = _arrays(batches, spec)
                moments = [np.zeros_like(w) for w in own.weights for _ in (0, 1)]
                values = _unblob(now, own.weights + moments)
                own.set_weights(values[: len(own.weights)])
                moments = values[len(own.weights) :]
                loss, count = own.train_epoch(x, y, moments, batches_done)
                yield pa.RecordBatch.from_pylist([{"n": len(x), "loss": loss, "done": count, "state": _blob(own.weights + moments)}])

            got = rows.mapInArrow(one, "n long, loss double, done long, state binary").collect()
            total = max(1, sum(r["n"] for r in got))
            state = (sum(np.frombuffer(r["state"]) * (r["n"] / total) for r in got)).tobytes()
            done = max(r["done"] for r in got)
            net.set_weights(_unblob(state, net.weights + zeros)[: len(net.weights)])
            history.append((epoch, sum(r["loss"] * r["n"] for r in got) / total, cls(net, []).loss(held)))
        rows.unpersist()
        held.unpersist()
        return cls(net, history)

    def loss(self, df: DataFrame) -> float:
        spec, state = self.network.spec, _blob(self.network.weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Network(**spec)
            own.set_weights(_unblob(state, own.weights))
            for b in batches:
                x, y = _arrays(iter([b]), spec)
                if len(x):
                    yield pa.RecordBatch.from_pylist([{"n": len(x), "loss": own.loss(x, y)}])

        row = df.select("x", "y").mapInArrow(run, "n long, loss double").agg(F.sum(F.col("n") * F.col("loss")) / F.sum("n")).first()
        return float("nan") if row[0] is None else row[0]

    def predict(self, df: DataFrame) -> DataFrame:
        spec, state = self.network.spec, _blob(self.network.weights)

        @F.pandas_udf("array<double>")
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = Network(**spec)
            own.set_weights(_unblob(state, own.weights))
            for part in parts:
                x = np.array([np.stack(v) for v in part]).reshape(len(part), spec["steps"], spec["features"])
                yield pd.Series(list(own.forward(x)), dtype=object)

        return df.withColumn("forecast", run("x"))

    def history_frame(self, df: DataFrame) -> DataFrame:
        """``epoch, loss, val_loss``."""
        return df.sparkSession.createDataFrame(self.history, "epoch int, loss double, val_loss double")

    def save(self, df: DataFrame, path: str) -> None:
        rows = [(json.dumps(self.network.spec), _blob(self.network.weights), json.dumps(self.history))]
        df.sparkSession.createDataFrame(rows, "spec string, weights binary, history string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: Any, path: str) -> NetworkForecaster:
        row = spark.read.parquet(path).first()
        net = Network(**json.loads(row["spec"]))
        net.set_weights(_unblob(bytes(row["weights"]), net.weights))
        return cls(net, [tuple(h) for h in json.loads(row["history"])])
