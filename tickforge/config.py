"""Parameters of all stages, and their YAML loader.

Fixed values: the defaults of all parameters, and the names of the configuration's sections and keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path

REQUIRED_SECTIONS = ("general", "windows", "common_features")


@dataclass(frozen=True)
class Windows:
    short: int = 14
    medium: int = 20
    long: int = 50
    vol: int = 30
    autocorr: int = 10
    efficiency: int = 14
    spread_ma: int = 20
    slope: int = 5

    @property
    def warmup(self) -> int:
        return max(self.short, self.medium, self.long, self.vol, self.autocorr) + 1


@dataclass(frozen=True)
class FeatureConfig:
    windows: Windows = Windows()
    min_rows: int = 100
    max_missing_ratio: float = 0.1
    drop_threshold: float = 0.5
    outlier_std: float = 5.0
    ranges: dict = field(default_factory=lambda: {"RSI_w": (0.0, 100.0), "log_ret_1": (-0.1, 0.1), "spread_close": (0.0, 0.01)})
    float32: bool = True
    leak_safe: bool = False  # no backward fill


@dataclass(frozen=True)
class BarrierConfig:
    vol_basis: str = "rv"
    price_col: str = "close"
    k_up: float = 2.0
    k_dn: float = 2.0
    horizon: int = 24
    vov_col: str | None = "VoV_wV"
    vov_lower_quant: float = 0.2
    vov_upper_quant: float = 0.8

    def __post_init__(self):
        if self.vol_basis not in ("rv", "atr"):
            raise ValueError(f"{self.vol_basis!r} is no volatility basis; there are rv and atr")
        if self.k_up <= 0 or self.k_dn <= 0:
            raise ValueError("a barrier needs a factor above 0")
        if self.horizon <= 0:
            raise ValueError("a label needs at least one bar ahead")
        if not 0 <= self.vov_lower_quant <= self.vov_upper_quant <= 1:
            raise ValueError("the VoV quantiles must be in order and within 0 and 1")

    @property
    def vol_col(self) -> str:
        return {"rv": "RV_w", "atr": "ATR_w"}[self.vol_basis]


@dataclass(frozen=True)
class AssembleConfig:
    max_nan_ratio: float = 0.1
    drop_features: tuple[str, ...] = ()
    min_retention: float = 0.8
    relaxed_retention: float = 0.5
    relax_above: float = 0.3
    min_samples: int = 100
    imbalance: float = 10.0  # the largest class over the smallest: above it there is a warning


@dataclass(frozen=True)
class SplitConfig:
    train_years: float = 3.0
    val_years: float = 1.0
    step_years: float = 1.0
    gap_days: float = 0.0
    min_samples: int = 100

    def __post_init__(self):
        if self.train_years <= 0 or self.val_years <= 0 or self.step_years <= 0:
            raise ValueError("train_years, val_years and step_years must be positive")
        if self.gap_days < 0:
            raise ValueError("gap_days must not be negative")


@dataclass(frozen=True)
class BoostConfig:
    rounds: int = 1000
    depth: int = 6
    rate: float = 0.1
    min_child_weight: float = 1.0
    gamma: float = 0.1
    alpha: float = 0.1
    lam: float = 1.0
    subsample: float = 0.8
    by_tree: float = 0.8
    by_level: float = 0.8
    patience: int = 50
    stop_on: str = "error"  # or "loss"
    bins: int = 64
    classes: int = 3
    seed: int = 42

    def __post_init__(self):
        if not 2 <= self.bins <= 255:
            raise ValueError("bins must be from 2 to 255")
        if self.stop_on not in ("error", "loss"):
            raise ValueError(f"{self.stop_on!r} is nothing to stop on; there are error and loss")
        if min(self.rounds, self.depth, self.classes) < 1:
            raise ValueError("rounds, depth and classes must be positive")


@dataclass(frozen=True)
class NetworkConfig:
    kind: str = "lstm"  # or "cnn"
    length: int = 64
    units: tuple[int, ...] = (128, 64)
    filters: tuple[int, ...] = (64, 128, 64)
    kernels: tuple[int, ...] = (5, 3, 3)
    pools: tuple[int, ...] = (2, 2, 2)
    dense: tuple[int, ...] = (32, 16)
    dropout: float = 0.3
    rate: float = 0.001
    epochs: int = 100
    steps: int = 8  # of an epoch
    patience: int = 10
    rate_patience: int = 5
    rate_factor: float = 0.5
    least_rate: float = 1e-5
    l1: float = 1e-4
    l2: float = 1e-4
    classes: int = 3
    seed: int = 42

    def __post_init__(self):
        if self.kind not in ("lstm", "cnn"):
            raise ValueError(f"{self.kind!r} is no network; there are lstm and cnn")
        if min(self.length, self.epochs, self.steps, self.rate_patience) < 1:
            raise ValueError("length, epochs, steps and rate_patience must be positive")


def load_yaml(path: str) -> dict:
    """A YAML file's sections; the mandatory ones must be there."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    import yaml

    got = yaml.safe_load(Path(path).read_text()) or {}
    if missing := [s for s in REQUIRED_SECTIONS if s not in got]:
        raise ValueError(f"the configuration lacks sections: {missing}")
    return got


def feature_config(got: dict) -> FeatureConfig:
    """Feature parameters of a loaded configuration; unknown keys are left alone."""
    names = {f.name for f in fields(Windows)}
    windows = {k: int(v) for k, v in got["windows"].items() if k in names}
    validation = got.get("validation", {})
    return FeatureConfig(
        windows=Windows(**windows), min_rows=int(got["general"].get("min_required_rows", 100)), max_missing_ratio=float(got["general"].get("max_missing_ratio", 0.1)),
        drop_threshold=float(validation.get("drop_threshold", 0.5)), outlier_std=float(validation.get("outlier_std_threshold", 5.0)),
    )
