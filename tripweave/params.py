"""Every tunable of the engine in one frozen object.

The defaults are fixed values: city box, cleaning bounds, grid and clustering
constants that results depend on.
"""

from __future__ import annotations

from dataclasses import dataclass

# Named periods of the day, start inclusive, end exclusive.
# Seconds before 07:00 and from 23:59 on belong to no period.
PERIODS = (
    ("早高峰", "07:00", "09:00"),
    ("日间平峰", "09:00", "17:00"),
    ("晚高峰", "17:00", "19:00"),
    ("夜间", "19:00", "23:59"),
)

# Histogram edges (lower open, upper closed) and labels.
DURATION_EDGES = (0, 5, 10, 20, 30, 60, 120, 240)
DURATION_LABELS = (
    "≤5分钟", "5-10分钟", "10-20分钟", "20-30分钟", "30-60分钟", "60-120分钟", ">120分钟",
)
DISTANCE_EDGES = (0, 1, 3, 5, 10, 20, 30, None)
DISTANCE_LABELS = ("<1km", "1-3km", "3-5km", "5-10km", "10-20km", "20-30km", ">30km")
SPEED_EDGES = (0, 10, 20, 30, 40, 50, 60, 80, None)
SPEED_LABELS = ("0-10", "10-20", "20-30", "30-40", "40-50", "50-60", "60-80", ">80")
PING_SPEED_EDGES = (0, 1, 20, 40, 60, None)
PING_SPEED_LABELS = ("静止(0)", "低速(1-20)", "中速(20-40)", "快速(40-60)", "超快(>60)")


def clock_seconds(text: str) -> int:
    """Seconds of the day of an ``HH:MM`` constant."""
    hours, minutes = text.split(":")
    return int(hours) * 3600 + int(minutes) * 60


@dataclass(frozen=True)
class Params:
    # box, inclusive, degrees
    lng_min: float = 113.5
    lng_max: float = 114.5
    lat_min: float = 22.4
    lat_max: float = 22.9
    # ping speed, inclusive, km/h
    speed_min: float = 0.0
    speed_max: float = 150.0
    # valid trip, inclusive
    trip_minutes_min: float = 1.0
    trip_minutes_max: float = 240.0
    trip_km_min: float = 0.2
    trip_kmh_min: float = 5.0
    trip_kmh_max: float = 100.0
    # peaks
    peak_factor: float = 1.5
    morning_hours: tuple[int, int] = (6, 10)
    evening_hours: tuple[int, int] = (16, 20)
    short_km: float = 3.0
    long_km: float = 10.0
    periods: tuple[tuple[str, str, str], ...] = PERIODS
    # grid step, degrees
    grid_lng: float = 0.01
    grid_lat: float = 0.009
    # hotspot clustering: radius in degrees, metres per degree
    eps_deg: float = 0.005
    min_points: int = 20
    metres_lng: float = 103_000.0
    metres_lat: float = 111_000.0
    top_hotspots: int = 20
    # scale guards
    max_rows_per_task: int = 5_000_000
    max_hot_keys: int = 10_000
    max_broadcast_rows: int = 200_000
    max_listed_sites: int = 1024
    # vehicles are dealt into so many groups by the stateful live trips
    vehicle_groups: int = 1024

    @property
    def n_lng(self) -> int:
        return int((self.lng_max - self.lng_min) / self.grid_lng) + 1

    @property
    def n_lat(self) -> int:
        return int((self.lat_max - self.lat_min) / self.grid_lat) + 1

    @property
    def n_cells(self) -> int:
        return self.n_lng * self.n_lat

    @property
    def eps_m(self) -> float:
        return self.eps_deg * self.metres_lng


DEFAULTS = Params()
