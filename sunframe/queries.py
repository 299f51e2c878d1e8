"""One query for each operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunframe.config import DERIVED, HYPER, THERMAL, ForecastConfig
from sunframe.functions.columns import epoch_ns_to_ts, epoch_s, hour_of_day, interp, require_columns, rounded
from sunframe.models.networks import Network, NetworkForecaster
from sunframe.models.persistence import cross_scaled, daily_persistence, persistence
from sunframe.operators import align, evaluate, scaling
from sunframe.operators.features import expand, rolling, rolling_features
from sunframe.operators.framing import frame, lag_name, lead_name, tensors, trimmed
from sunframe.operators.position import bucket_window, numbered, owned, with_halo
from sunframe.operators.pv import clean_curtailment, clean_power, pv_performance, turbine_power
from sunframe.operators.split import chronological
from sunframe.operators.thermal import relaxation, thermal_model
from sunframe.plans import figures
from sunframe.plans.forecast import load, run
from sunframe.plant import PV
from sunframe.session import prepared
from sunframe.sources.results import read_results, write_results
from sunframe.sources.scratch import shared_path
from sunframe.sources.telemetry import prune, resample, telemetry
from sunframe.streaming.telemetry import hourly, read_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

H, PRE = 10, 5
FEATURES = ("p_solar", "pac", "temp_module", "mean_prev_h")
TREE = ForecastConfig(model="RF", features=FEATURES, scaler="MinMax01")
INPUTS = [lag_name(f, i) for f in FEATURES for i in range(PRE, -1, -1)]
OUTPUTS = [lead_name("p_solar", i) for i in range(1, H + 1)]


def query(f: Query) -> Query:
    """Register under its own name, with the session in UTC."""

    def made(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(prepared(spark), sf_dir)

    made.__doc__ = f.__doc__
    QUERIES[f.__name__] = made
    return f


def keyed(df: DataFrame, *names: str, keys: Sequence[str | Column] | None = None) -> DataFrame:
    """The key and rounded columns; without keys, the time in seconds."""
    key = [epoch_s(F.col("ts")).alias("t")] if keys is None else list(keys)
    return df.select(*key, *[rounded(F.col(n)).alias(n) for n in names])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def pv(spark: SparkSession, sf_dir: str, clamp_mode: str = "row") -> DataFrame:
    return pv_performance(telemetry(spark, sf_dir), clamp_mode=clamp_mode)


def expanded(spark: SparkSession, sf_dir: str, features: tuple[str, ...] = FEATURES) -> DataFrame:
    return expand(telemetry(spark, sf_dir), TREE.with_(features=features))


def framed(spark: SparkSession, sf_dir: str, drop: bool = True, keep_bucket: bool = False, config: ForecastConfig = TREE) -> DataFrame:
    dealt = expand(telemetry(spark, sf_dir), config, for_framing=True)
    return frame(dealt, config.features, config.target, config.history, config.horizon, drop, keep_bucket=keep_bucket)


def split(spark: SparkSession, sf_dir: str, network: bool = False) -> DataFrame:
    return chronological(framed(spark, sf_dir, keep_bucket=True), (70, 20, 10), network)[0]


def tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test samples with persistence and observation side by side by step."""
    test = split(spark, sf_dir).filter("split = 'test'")
    rows = test.select("sample_id", persistence(F.col("p_solar_now"), H).alias("naive"), F.array(*OUTPUTS).alias("observed"))
    return evaluate.paired(rows, "naive", "observed")


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.errors_by_horizon(tested(spark, sf_dir))


@query
def resample_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(resample(events(spark, sf_dir)), "av", "mn", "mx", keys=[epoch_s(F.col("ts")).alias("t"), "n"])


@query
def resample_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly statistics where some values are unknown (NaN) and some very small."""
    x = F.when(F.col("event_id") % 7 == 0, float("nan")).when(F.col("event_id") % 5 == 0, F.col("value") * 1e-8).otherwise(F.col("value"))
    made = resample(events(spark, sf_dir).withColumn("value", x)).withColumn("mn", F.col("mn") * 1e6)
    return keyed(made, "av", "mn", "mx", keys=[epoch_s(F.col("ts")).alias("t"), "n"])


@query
def telemetry_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(telemetry(spark, sf_dir), "poa_irr", "temperature", "wind_speed", "humidity", "pressure", "p_solar", "ghi", "wind_dir", "p_wind", keys=[epoch_s(F.col("ts")).alias("t"), "rn"])


@query
def pv_temp_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(pv(spark, sf_dir), "temp_module")


@query
def pv_temp_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(pv(spark, sf_dir), "temp_cell")


@query
def pv_pac_pdc_row_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(pv(spark, sf_dir), "pac", "pdc")


@query
def pv_pac_pdc_column_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(pv(spark, sf_dir, "column"), "pac", "pdc")


@query
def inverter_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = PV.strings[0]
    percent = interp(F.col("poa_irr") * 5000.0, s.eff_p, s.eff_percent, left=0.0)
    return keyed(telemetry(spark, sf_dir).withColumn("percent", percent), "percent")


@query
def wt_power_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(telemetry(spark, sf_dir).withColumn("power", turbine_power(F.col("wind_speed"))), "power")


@query
def clean_curtailment_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(clean_curtailment(pv(spark, sf_dir)), "p_solar")


@query
def smooth_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(clean_power(pv(spark, sf_dir)), "p_solar", "pac")


@query
def hour_of_day_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", hour_of_day(F.col("ts")).alias("hour_of_day"))


def _rolled(name: str) -> Query:
    def rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
        return keyed(rolling_features(clean_power(pv(spark, sf_dir)), H, names=(name,)), name)

    return rolled


for _query, _feature in (("rolling_mean_h", "mean_prev_h"), ("rolling_std_h", "std_prev_h"), ("rolling_wind_mean", "mean_wind_prev_h"), ("rolling_wind_std", "std_wind_prev_h")):
    _made = _rolled(_feature)
    _made.__name__ = _query
    query(_made)


@query
def rolling_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return keyed(events(spark, sf_dir).withColumn("rolled", rolling(F.col("value"), "mean", 5, w)), "rolled", keys=["event_id"])


@query
def expand_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = expanded(spark, sf_dir, tuple(["p_solar", *(d for d in DERIVED if d not in THERMAL)]))
    names = ("p_solar", "pac", "pdc", "temp_module", "temp_cell", "mean_prev_h", "std_prev_h", "mean_wind_prev_h", "std_wind_prev_h")
    return keyed(df, *names, keys=[epoch_s(F.col("ts")).alias("t"), "hour_of_day"])


#: The default configuration: eighteen features, and the panel's temperature of the thermal balance besides.
DEFAULT = ForecastConfig()


@query
def expand_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expanded table of the default features with the thermal channel."""
    df = expand(telemetry(spark, sf_dir), DEFAULT.with_(features=(*DEFAULT.features, *THERMAL)))
    return keyed(df, *[f for f in (*DEFAULT.features, *THERMAL) if f != "hour_of_day"], keys=["rn", "hour_of_day"])


@query
def frame_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete samples of the default run: all lags of eighteen features, and the target's leads."""
    made = framed(spark, sf_dir, config=DEFAULT)
    return keyed(made, *[c for c in made.columns if c != "rn"], keys=["rn"])


@query
def column_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("p_solar", "temp_module")
    return keyed(prune(require_columns(expanded(spark, sf_dir), names), names), *names, keys=["rn"])


@query
def frame_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(framed(spark, sf_dir, False), *INPUTS, keys=["rn"])


@query
def frame_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(framed(spark, sf_dir, False), *OUTPUTS, keys=["rn"])


@query
def frame_full_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(framed(spark, sf_dir), *INPUTS, *OUTPUTS, keys=["rn"])


@query
def frame_ann_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = expanded(spark, sf_dir)
    return trimmed(frame(rows, FEATURES, "p_solar", PRE, H), rows.count(), PRE, H, "legacy").select("rn")


@query
def tensor_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tensors(framed(spark, sf_dir), FEATURES, "p_solar", PRE, H).select("rn", F.posexplode("x").alias("step", "v"))
    return keyed(rows.select("rn", "step", F.posexplode("v").alias("feature", "value")), "value", keys=["rn", "step", "feature"])


@query
def tensor_y(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tensors(framed(spark, sf_dir), FEATURES, "p_solar", PRE, H).select("rn", F.posexplode("y").alias("i", "value"))
    return keyed(rows, "value", keys=["rn", (F.col("i") + 1).alias("h")])


@query
def outer_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subsets of the columns over all rows, one of them a day later: either side lacks keys of the other."""
    rows = pv(spark, sf_dir)
    both = align.outer_align(rows.select("rn", "pac"), rows.select((F.col("rn") + 24).alias("rn"), "wind_speed"), ["rn"])
    return keyed(both, "pac", "wind_speed", keys=["rn"])


@query
def pad_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir).select("rn", "p_solar")
    return keyed(align.pad_rows(rows, rows.count(), PRE + 1), "p_solar", keys=["rn"])


@query
def split_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(spark, sf_dir).select("rn", "sample_id", "split")


@query
def split_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(spark, sf_dir, True).select("rn", "sample_id", "split")


def _scaled(kind: str, inverse: bool = False) -> Query:
    def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, names = split(spark, sf_dir), ["p_solar_now", "temp_module_lag5"]
        s = scaling.fit(rows.filter("split = 'train'"), names, kind)
        out = s.transform(rows)
        if not inverse:
            return keyed(out, *names, keys=["sample_id"])
        both = out.withColumns({f"{n}_scaled": F.col(n) for n in names})
        return keyed(s.inverse(both, names), *names, *(f"{n}_scaled" for n in names), keys=["sample_id"])

    return scaled


for _query, _kind, _back in (("scale_minmax01", "MinMax01", False), ("scale_minmax11", "MinMax11", False), ("scale_standard", "Standard", False), ("inverse_scale", "MinMax11", True)):
    _made = _scaled(_kind, _back)
    _made.__name__ = _query
    query(_made)


def _pooled(kind: str) -> Query:
    def pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = split(spark, sf_dir, True)
        s = scaling.fit_pooled(rows.filter("split = 'train'"), {"temp_module": [lag_name("temp_module", i) for i in range(PRE + 1)]}, kind)
        return keyed(s.transform(rows), "temp_module_now", "temp_module_lag5", keys=["sample_id"])

    return pooled


for _query, _kind in (("scale_pooled", "MinMax01"), ("scale_pooled_standard", "Standard")):
    _made = _pooled(_kind)
    _made.__name__ = _query
    query(_made)


@query
def scale_constant_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split(spark, sf_dir).select("sample_id", "split", F.lit(3.0).alias("c"))
    made = {k.lower(): scaling.fit(rows.filter("split = 'train'"), ["c"], k).apply(F.col("c"), "c") for k in ("MinMax01", "MinMax11", "Standard")}
    return keyed(rows.withColumns(made), *made, keys=["sample_id"])


@query
def persistence_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(tested(spark, sf_dir), "forecast", "observed", keys=["sample_id", "h"])


@query
def persistence_cross_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split(spark, sf_dir)
    train = rows.filter("split = 'train'")
    x, y = scaling.fit(train, ["p_solar_now"], "Standard"), scaling.fit(train, OUTPUTS, "Standard")
    test = rows.filter("split = 'test'").select("sample_id", cross_scaled(F.col("p_solar_now"), x, "p_solar_now", y, OUTPUTS).alias("naive"), F.array(*OUTPUTS).alias("observed"))
    return keyed(evaluate.paired(test, "naive", "observed"), "forecast", "observed", keys=["sample_id", "h"])


@query
def persistence_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_halo(clean_power(pv(spark, sf_dir)), 24, 0)
    made = owned(rows.withColumn("v", daily_persistence("p_solar", H, 24, bucket_window())))
    return keyed(made.select("rn", F.posexplode("v").alias("i", "forecast")), "forecast", keys=["rn", (F.col("i") + 1).alias("h")])


@query
def metrics_mse_rmse_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: telemetry to errors of persistence by step."""
    return keyed(errors(spark, sf_dir), "mse", "rmse", "mae", keys=["h"])


@query
def metrics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(evaluate.summary(errors(spark, sf_dir)), "rmse", "mae", "mse", keys=[])


@query
def metric_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(evaluate.limits(errors(spark, sf_dir)), "low", "high", keys=[])


@query
def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(evaluate.residuals(tested(spark, sf_dir)), "residual", keys=["sample_id", "h"])


@query
def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return events(spark, sf_dir).select("event_id", F.unix_micros(epoch_ns_to_ts(ns)).alias("us"))


@query
def sort_by_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(events(spark, sf_dir), ["ts", "event_id"]).select("event_id", "rn")


@query
def thermal_relaxation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(relaxation(pv(spark, sf_dir), "temp_module", 0.35, "relaxed", limit=5.0), "relaxed", keys=["rn"])


@query
def thermal_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(thermal_model(pv(spark, sf_dir)), "temp_module", "temp_module_rp", keys=["rn"])


@query
def demand_daily_framing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operators on daily demand of line items."""
    daily = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_shipdate").alias("ts")).agg(F.sum("l_quantity").alias("q"))
    rows = frame(numbered(daily, ["ts"]), ["q"], "q", 5, 5)
    test = chronological(rows, (70, 20, 10), False)[0].filter("split = 'test'")
    made = test.select("sample_id", persistence(F.col("q_now"), 5).alias("naive"), F.array(*[lead_name("q", i) for i in range(1, 6)]).alias("observed"))
    return keyed(evaluate.errors_by_horizon(evaluate.paired(made, "naive", "observed")), "mse", "rmse", "mae", keys=["h"])


#: Hyper-parameters of the forecast queries: recurrent networks with fewer epochs than the default thousand.
_FORECASTS = {"rf": ("RF", {}), "svr": ("SVM", {}), "cnn": ("CNN", {}), "lstm": ("LSTM", {"epochs": 3}), "cnn_lstm": ("CNN_LSTM", {"epochs": 3})}


def _forecast(model: str, hyper: dict) -> Query:
    def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = ForecastConfig(model=model, features=FEATURES, hyper=hyper)
        return keyed(run(spark, config, telemetry(spark, sf_dir)).errors, "mse", "rmse", "mae", keys=["h", "kind"])

    return forecast


for _query, (_model, _hyper) in _FORECASTS.items():
    _made = _forecast(_model, _hyper)
    _made.__name__ = f"{_query}_forecast"
    query(_made)


@query
def import_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and save the expanded table, then import it with fewer features."""
    root = shared_path(spark, "import")
    load(spark, TREE.with_(root=root, save_expanded=True), telemetry(spark, sf_dir))
    names = ("p_solar", "mean_prev_h")
    return keyed(load(spark, TREE.with_(root=root, mode="import", features=names)), *names, keys=["rn"])


@query
def results_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results in long form, written by kind and one kind read back."""
    path = shared_path(spark, "results")
    pairs = tested(spark, sf_dir)
    kinds = [pairs.select("sample_id", "h", F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in (("observed", "observed"), ("persistence", "forecast"))]
    write_results(kinds[0].unionByName(kinds[1]), path)
    return keyed(read_results(spark, path, "persistence"), "value", keys=["sample_id", "h"])


@query
def loss_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and validation loss by epoch."""
    rows = telemetry(spark, sf_dir)
    made = run(spark, ForecastConfig(model="CNN", features=FEATURES), rows).model.history_frame(rows)
    return keyed(made, "loss", "val_loss", keys=["epoch"])


@query
def plot_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four panels of the overview, every row."""
    return keyed(figures.data_plot(telemetry(spark, sf_dir)), "value", keys=[epoch_s(F.col("ts")).alias("t"), "panel"])


@query
def plot_data_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a band by day."""
    return keyed(figures.data_plot(telemetry(spark, sf_dir), interval="1 day"), "low", "value", "high", keys=[epoch_s(F.col("ts")).alias("t"), "panel"])


@query
def plot_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power curve of the turbine and efficiency curves of the inverters."""
    return figures.curves(spark)


def kinds_of_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by kind; the mean of the last hours stands for a forecaster."""
    test = split(spark, sf_dir).filter("split = 'test'")
    made = {"forecaster": "mean_prev_h_now", "persistence": "p_solar_now"}
    rows = test.select("sample_id", *[persistence(F.col(c), H).alias(k) for k, c in made.items()], F.array(*OUTPUTS).alias("observed"))
    parts = [evaluate.errors_by_horizon(evaluate.paired(rows, k, "observed")).withColumn("kind", F.lit(k)) for k in made]
    return parts[0].unionByName(parts[1])


@query
def plot_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(figures.error_plot(kinds_of_errors(spark, sf_dir)), "forecaster", "persistence", keys=["h"])


@query
def plot_rmse_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(figures.error_title(kinds_of_errors(spark, sf_dir)), "rmse", "mae", "mse", keys=[])


#: Small networks whose weights are given, so that SQL can compute the same forecasts.
FIXED = {
    "CNN": {"filters": 3, "dense": [2, 3]},
    "LSTM": {"neurons": [3, 2], "dense": [2, 3]},
    "CNN_LSTM": {"filters": 3, "neurons": [3, 2], "dense": [2, 3]},
}
FIXED_HORIZON = 2


def _fixed(model: str) -> Query:
    def fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
        net = Network(model, PRE + 1, len(FEATURES), FIXED_HORIZON, HYPER[model] | FIXED[model])
        at, values = 0, []
        for w in net.weights:
            values.append(0.4 * np.sin(1.0 + 7.0 * np.arange(at, at + w.size)).reshape(w.shape))
            at += w.size
        net.set_weights(values)
        rows = tensors(framed(spark, sf_dir), FEATURES, "p_solar", PRE, H)
        small = rows.withColumn("x", F.transform("x", lambda step: F.transform(step, lambda v: v / 10)))
        made = NetworkForecaster(net, []).predict(small)
        return keyed(made.select("rn", F.posexplode("forecast").alias("i", "forecast")), "forecast", keys=["rn", (F.col("i") + 1).alias("h")])

    return fixed


for _model in FIXED:
    _made = _fixed(_model)
    _made.__name__ = f"{_model.lower()}_given_weights"
    query(_made)


@query
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly view as a stream over the same files (an extension), run to the end of what is there."""
    path, state = shared_path(spark, "stream-hourly"), shared_path(spark, "stream-state")
    made = hourly(read_events(spark, sf_dir))
    # Each trigger replaces the whole view, on the executors; nothing is gathered on the driver.
    q = made.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    return keyed(spark.read.schema(made.schema).parquet(path), "av", "mn", "mx", keys=[epoch_s(F.col("ts")).alias("t"), "n"])


for _alias in ("clean_curtailment_", "hour_of_day_"):
    QUERIES[_alias.rstrip("_")] = QUERIES.pop(_alias)
