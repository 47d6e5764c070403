"""Settings every operator shares; pass a changed copy to override one."""

from dataclasses import dataclass

KEY = "unique_id"
DAY = "ds"
TARGET = "y"

# The defaults results are published with.
SCOPE = "pooled_all_windows"
METRICS = ("wMAPE", "Bias", "IntervalScore_80", "Coverage_80")


@dataclass(frozen=True)
class Settings:
    horizon: int = 28
    season: int = 7
    windows: int = 3
    step: int = 28
    refit: bool = False
    seed: int = 42
    top_series: int = 1000
    micro_series: int = 50
    min_history: int = 365
    max_zero: float = 0.5
    coverage: float = 0.80
    z: float = 1.2815515655446004  # normal quantile of (1 + coverage) / 2


DEFAULTS = Settings()
