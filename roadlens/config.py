"""Tunable parameters and the file layout of one sensor dataset."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Business parameters (first block) and scale parameters (second block)."""

    rolling_window: int = 12
    forecast_horizon: int = 3
    anomaly_zscore: float = 2.5
    congestion_threshold: float = 0.55
    morning_peak: tuple[int, int] = (7, 10)
    evening_peak: tuple[int, int] = (16, 19)

    # Size of the sketch behind the free-flow percentile of a sensor. Up to so many readings of a sensor
    # it is exact; beyond, its rank error is about 2.5 / size ** 0.94 (0.1 % here), as KLL sketches state it.
    free_flow_sketch: int = 4_096
    # Tasks are dealt into so many groups; a sensor's figures are merged per group first.
    task_groups: int = 64


DEFAULTS = Settings()


@dataclass(frozen=True)
class DatasetLayout:
    """Where the three input files of one sensor dataset live."""

    root: str
    dataset: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.dataset}/{name}"

    @property
    def readings(self) -> str:
        return self._at("sensor-readings.csv")

    @property
    def distances(self) -> str:
        return self._at("distances.csv")

    @property
    def sensors(self) -> str:
        return self._at("sensors.txt")
