"""The forecast run: build or import, frame, split, scale, fit or load, test, score."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.config import ForecastConfig
from sunframe.functions.columns import clean_nan
from sunframe.models.persistence import cross_scaled, persistence
from sunframe.operators import evaluate, scaling
from sunframe.operators.features import expand
from sunframe.operators.framing import frame, lag_name, lead_name, tensors, trimmed
from sunframe.operators.position import numbered
from sunframe.operators.scaling import Scaler
from sunframe.operators.split import chronological
from sunframe.sources.scratch import materialised
from sunframe.sources.telemetry import prune, read_expanded, read_raw, write_expanded


@dataclass
class Prepared:
    """Framed samples with ``sample_id`` and ``split``, and the scalers fitted on the training part."""

    samples: DataFrame
    counts: tuple[int, int, int]
    inputs: list[str]
    outputs: list[str]
    x_scaler: Scaler
    y_scaler: Scaler

    def part(self, name: str) -> DataFrame:
        return self.samples.filter(F.col("split") == name)

    def scaled(self, df: DataFrame) -> DataFrame:
        return self.y_scaler.transform(self.x_scaler.transform(df, self.inputs), self.outputs)


def load(spark: SparkSession, config: ForecastConfig, raw: DataFrame | None = None, for_framing: bool = False) -> DataFrame:
    """The expanded table: built from the raw one (and saved if asked for), or imported.

    ``for_framing`` leaves a table that is neither saved nor imported in the halo buckets that framing needs.
    """
    if config.mode == "import":
        return read_expanded(spark, config)
    source = clean_nan(raw) if raw is not None else read_raw(spark, config.root, config.resolution)
    placed = source if "rn" in source.columns else numbered(source, ["ts"])
    if for_framing and not config.save_expanded and config.trim != "legacy":
        return expand(placed, config, for_framing=True)
    out = prune(expand(placed, config), config.features)
    if config.save_expanded:
        return spark.read.parquet(write_expanded(out, config))
    return out


def prepare(expanded: DataFrame, config: ForecastConfig) -> Prepared:
    """Samples, their parts and scalers. Networks share a scale by feature; trees and SVR scale every lag by itself."""
    p, h = config.history, config.horizon
    features = [f for f in config.features if f in expanded.columns]
    framed = frame(expanded, features, config.target, p, h, keep_bucket=True)
    if config.is_network and config.trim == "legacy":
        framed = trimmed(framed, expanded.count(), p, h, "legacy")
    samples, counts = chronological(framed, config.split, config.is_network)
    samples = materialised(samples, "samples")
    inputs = [lag_name(f, i) for f in features for i in range(p, -1, -1)]
    outputs = [lead_name(config.target, i) for i in range(1, h + 1)]
    train = samples.filter("split = 'train'")
    if config.is_network:
        x = scaling.fit_pooled(train, {f: [lag_name(f, i) for i in range(p + 1)] for f in features}, config.scaler)
        y = scaling.fit_pooled(train, {config.target: outputs}, config.scaler)
    else:
        x, y = scaling.fit(train, inputs, config.scaler), scaling.fit(train, outputs, config.scaler)
    return Prepared(samples, counts, inputs, outputs, x, y)


def fit_or_load(spark: SparkSession, config: ForecastConfig, data: Prepared, path: str | None = None) -> Any:
    """The model, trained (and saved if asked for) or read from ``path``."""
    from sunframe.models.forest import ForestForecaster
    from sunframe.models.networks import NetworkForecaster
    from sunframe.models.svr import SVRForecaster

    where = path or f"{config.root}/trained_{config.model}"
    s = config.settings
    if not config.train:
        if config.model == "RF":
            return ForestForecaster.load(where, data.inputs, config.horizon)
        if config.model == "SVM":
            return SVRForecaster.load(spark, where, data.inputs, config.horizon, s)
        return NetworkForecaster.load(spark, where)
    train = data.scaled(data.part("train"))
    if config.model == "RF":
        model: Any = ForestForecaster.fit(train, data.inputs, data.outputs, s)
        if config.save_model:
            model.save(where)
    elif config.model == "SVM":
        model = SVRForecaster.fit(train, data.inputs, data.outputs, s)
        if config.save_model:
            model.save(where)
    else:
        features = len(data.inputs) // (config.history + 1)
        tensor = _tensors(train, config, data)
        model = NetworkForecaster.fit(tensor, _tensors(data.scaled(data.part("validation")), config, data), config.model, config.history + 1, features, config.horizon, s)
        if config.save_model:
            model.save(train, where)
    return model


def _tensors(df: DataFrame, config: ForecastConfig, data: Prepared) -> DataFrame:
    features = [n[: -len("_now")] for n in data.inputs if n.endswith("_now")]
    return tensors(df, features, config.target, config.history, config.horizon, keep=("sample_id",))


def test(model: Any, config: ForecastConfig, data: Prepared) -> DataFrame:
    """``sample_id`` and arrays ``forecast``, ``observed``, ``persistence`` of the test part, in the target's units."""
    part = data.part("test")
    scaled = data.scaled(part)
    ready = _tensors(scaled, config, data) if config.is_network else scaled
    made = model.predict(ready).select(F.col("sample_id").alias("_id"), "forecast")
    back = F.array(*[data.y_scaler.invert(F.col("forecast")[i], n) for i, n in enumerate(data.outputs)])
    now = lag_name(config.target, 0)
    if config.persistence_mode == "cross_scaled":
        naive = cross_scaled(F.col(now), data.x_scaler, now, data.y_scaler, data.outputs)
    else:
        naive = persistence(F.col(now), config.horizon)
    truth = part.select("sample_id", F.array(*data.outputs).alias("observed"), naive.alias("persistence"))
    return truth.join(made, truth["sample_id"] == made["_id"]).select("sample_id", back.alias("forecast"), "observed", "persistence")


def score(tested: DataFrame) -> DataFrame:
    """``h, kind, mse, rmse, mae``: the forecaster and persistence against what was observed."""
    parts = [evaluate.errors_by_horizon(evaluate.paired(tested, k, "observed")).withColumn("kind", F.lit(name)) for k, name in (("forecast", "forecaster"), ("persistence", "persistence"))]
    return parts[0].unionByName(parts[1]).select("h", "kind", "mse", "rmse", "mae")


@dataclass
class Forecast:
    data: Prepared
    model: Any
    tested: DataFrame
    errors: DataFrame

    def long(self) -> DataFrame:
        """``sample_id, h, kind, value``."""
        return evaluate.to_long(self.tested, {"forecasted": "forecast", "observed": "observed", "persistence": "persistence"})


def run(spark: SparkSession, config: ForecastConfig, raw: DataFrame | None = None) -> Forecast:
    """The whole run. Actions happen only where a count, a scaler, a model or a result needs one."""
    data = prepare(load(spark, config, raw, for_framing=True), config)
    model = fit_or_load(spark, config, data)
    tested = materialised(test(model, config, data), "tested")
    return Forecast(data, model, tested, score(tested))
