"""Configuration of a forecast, checked when it is made."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from sunframe.errors import ConfigError, ResolutionError

RESOLUTIONS = ("1sec", "1min", "5min", "60min")
SCALERS = ("MinMax01", "MinMax11", "Standard")
MODELS = ("RF", "SVM", "LSTM", "CNN", "CNN_LSTM")
NETWORKS = ("LSTM", "CNN", "CNN_LSTM")

BASE_CHANNELS = ("temperature", "humidity", "wind_speed", "wind_dir", "ghi", "poa_irr", "p_wind", "p_solar", "pressure")
PV_CHANNELS = ("pac", "pdc", "temp_module", "temp_cell")
CALENDAR = ("hour_of_day",)
ROLLING = ("mean_prev_h", "std_prev_h", "mean_wind_prev_h", "std_wind_prev_h")
THERMAL = ("temp_module_rp",)
DERIVED = PV_CHANNELS + THERMAL + CALENDAR + ROLLING
#: The bracketed names of the raw files by canonical name.
RAW_NAMES = {
    "temperature": "TEMPERATURE[degC]",
    "humidity": "HUMIDITY[%]",
    "wind_speed": "WIND_SPEED[m1s]",
    "wind_dir": "WIND_DIR[deg]",
    "ghi": "GHI[kW1m2]",
    "poa_irr": "POA Irr[kW1m2]",
    "p_wind": "P_Gaia[kW]",
    "p_solar": "P_Solar[kW]",
    "pressure": "Pressure[mbar]",
    "pac": "Pac",
    "pdc": "Pdc",
    "temp_module": "TempModule",
    "temp_cell": "TempCell",
    "temp_module_rp": "TempModule_RP",
    "hour_of_day": "HoursOfDay",
    "mean_prev_h": "MeanPrevH",
    "std_prev_h": "StdPrevH",
    "mean_wind_prev_h": "MeanWindSpeedPrevH",
    "std_wind_prev_h": "StdWindSpeedPrevH",
}
#: Default hyper-parameters by model.
HYPER: dict[str, dict[str, Any]] = {
    "RF": {"n_trees": 1, "random_state": 32, "max_depth": 30, "bootstrap": True},
    "SVM": {"kernel": "rbf", "degree": 3, "gamma": "scale", "coef0": 0.0, "C": 3.0, "epsilon": 0.1},
    "LSTM": {"n_batch": 16, "epochs": 1000, "neurons": [15, 15, 15], "dense": [0, 0], "activation": "tanh", "loss": "mean_absolute_error", "optimizer": "adam"},
    "CNN": {"n_batch": 16, "epochs": 3, "filters": 32, "kernel_size": 2, "pool_size": 3, "dense": [10, 10], "activation": "tanh", "loss": "mean_absolute_error", "optimizer": "adam"},
    "CNN_LSTM": {
        "n_batch": 16, "epochs": 1000, "filters": 32, "kernel_size": 3, "pool_size": 2, "dense": [0, 0], "cnn_activation": "tanh",
        "neurons": [10, 15, 10], "lstm_activation": "sigmoid", "loss": "mean_absolute_error", "optimizer": "adam",
    },
}


@dataclass(frozen=True)
class ForecastConfig:
    """All that a run depends on. Unknown values raise at once."""

    resolution: str = "60min"
    mode: str = "build"
    save_expanded: bool = False
    train: bool = True
    save_model: bool = False
    split: tuple[int, int, int] = (70, 20, 10)
    scaler: str = "MinMax01"
    target: str = "p_solar"
    features: tuple[str, ...] = BASE_CHANNELS + PV_CHANNELS + CALENDAR + ROLLING
    model: str = "CNN"
    horizon: int = 10
    history: int = 5
    clamp_mode: str = "row"
    trim: str = "complete"
    persistence_mode: str = "exact"
    hyper: dict[str, Any] = field(default_factory=dict)
    root: str = "."

    def __post_init__(self) -> None:
        if self.resolution not in RESOLUTIONS:
            raise ResolutionError(f"resolution {self.resolution!r} is none of {', '.join(RESOLUTIONS)}")
        for name, allowed in (
            ("mode", ("build", "import")), ("scaler", SCALERS), ("model", MODELS), ("clamp_mode", ("row", "column")),
            ("trim", ("complete", "legacy")), ("persistence_mode", ("exact", "cross_scaled")),
        ):
            if getattr(self, name) not in allowed:
                raise ConfigError(f"{name} {getattr(self, name)!r} is none of {', '.join(allowed)}")
        if len(self.split) != 3 or sum(self.split) != 100 or min(self.split) < 0 or self.split[2] == 0 or self.split[0] >= 100:
            raise ConfigError(f"split {self.split} must be three shares that add up to 100, with a test share")
        if self.horizon < 1 or self.history < 0:
            raise ConfigError("horizon must be at least 1 and history at least 0")
        if self.target not in self.features:
            raise ConfigError(f"the target {self.target} must be one of the features")
        unknown = [k for k in self.hyper if k not in HYPER[self.model]]
        if unknown:
            raise ConfigError(f"{self.model} has no settings {', '.join(unknown)}")

    @property
    def settings(self) -> dict[str, Any]:
        """The model's hyper-parameters."""
        return HYPER[self.model] | self.hyper

    @property
    def is_network(self) -> bool:
        return self.model in NETWORKS

    def with_(self, **changes: Any) -> ForecastConfig:
        return replace(self, **changes)
