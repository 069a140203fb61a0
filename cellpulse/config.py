"""Every tunable value of the library in one frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass

# Labels, names and bounds that results must agree on.
SLOT_LABELS = ("Night", "Morning", "Afternoon", "Evening")
SLOT_UPPER_HOURS = (6, 12, 18, 24)
RISK_LABELS = ("Low", "Medium", "High")
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
OPTIONAL_COLUMNS = ("Arrest", "Domestic", "District", "Beat", "Description")
KM_PER_DEGREE_LAT = 111.0
KM_PER_DEGREE_LON = 85.0


@dataclass(frozen=True)
class GridConfig:
    """Defaults describe a 500 m city grid observed in six-hour windows."""

    lat_range: tuple[float, float] = (41.6, 42.1)
    lon_range: tuple[float, float] = (-88.0, -87.5)
    cell_meters: float = 500.0
    cell_degrees: float = 500.0 / 111000.0
    window_hours: int = 6
    # (lat_min, lon_min); None takes the minimum of the data, which needs one more scan.
    origin: tuple[float, float] | None = None
    history: tuple[int, ...] = (1, 3, 7, 14)
    neighbor_radius: int = 1
    ewma_spans: tuple[int, ...] = (3, 7)
    volatility_windows: tuple[int, ...] = (3, 7)
    city_center: tuple[float, float] = (41.8781, -87.6298)
    bounded_risk_edges: tuple[float, ...] = (0.0, 1.0, 3.0, 100.0)
    open_risk_edges: tuple[float, ...] = (1.0, 3.0)
    attention_level: float = 5.0
    detection_level: float = 3.0
    preventable_share: float = 0.15
    split_shares: tuple[float, float] = (0.70, 0.85)
    # Rows of the recent, map and cluster views; None is all rows.
    recent_rows: int | None = None
    map_sample: int | None = None
    cluster_points: int | None = None
