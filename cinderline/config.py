"""Settings of the detection pipeline. Every number that shapes a result stands here."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# fixed values: sources in the order that decides between duplicates, with the product each one carries
SOURCES = {"VIIRS_SNPP_SP": "SP", "VIIRS_SNPP_NRT": "NRT", "VIIRS_NOAA20_SP": "SP", "VIIRS_NOAA20_NRT": "NRT", "VIIRS_NOAA21_NRT": "NRT"}
# fixed values: satellite codes
SATELLITES = {"N": "SNPP", "1": "NOAA20", "N20": "NOAA20", "2": "NOAA21", "N21": "NOAA21"}
SHOWN_SATELLITES = ("SNPP", "NOAA20", "NOAA21")


@dataclass(frozen=True)
class Settings:
    # fixed values: thresholds that results rest on
    history_start: date = date(2012, 1, 20)
    days_per_request: int = 5
    request_interval_s: float = 0.25
    refresh_days: int = 10
    land_buffer_m: float = 750.0
    confidence_kept: tuple[str, ...] = ("n", "h")
    static_types: tuple[int, ...] = (1, 2, 3)
    grid_m: float = 1000.0
    least_calendar_months: int = 8
    least_year_months: int = 15
    least_radius_m: float = 1000.0
    eps_m: float = 1500.0
    gap_days: int = 2
    sensitivity_eps_m: tuple[float, ...] = (1000.0, 1500.0, 2000.0)
    sensitivity_gap_days: tuple[int, ...] = (1, 2, 3)
    rolling_days: int = 7
    recent_days: int = 365
    bbox: tuple[float, ...] = (-8.7, 49.8, 1.95, 61.0)


DEFAULT = Settings()
