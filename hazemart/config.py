"""Domain settings. All operators take them as arguments; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------------------------

# inclusive physical limits of the readings
READING_LIMITS = {
    "aqi": (0, 1000),
    "iaqi": (0, 1000),
    "pm25": (0, 2000),
    "pm10": (0, 3000),
    "pm25_mcp": (0, 2000),
    "temperature": (-60, 60),
    "humidity": (0, 100),
    "pressure": (650, 820),
}

# inclusive physical limits of the weather context
CONTEXT_LIMITS = {
    "weather_temperature": (-60, 60),
    "weather_humidity": (0, 100),
    "precipitation": (0, 500),
    "rain": (0, 500),
    "snowfall": (0, 500),
    "surface_pressure": (650, 1100),
    "wind_speed": (0, 80),
    "wind_direction": (0, 360),
}

# context column -> variable of the source
CONTEXT_SOURCE = {
    "weather_temperature": "temperature_2m",
    "weather_humidity": "relative_humidity_2m",
    "precipitation": "precipitation",
    "rain": "rain",
    "snowfall": "snowfall",
    "surface_pressure": "surface_pressure",
    "wind_speed": "wind_speed_10m",
    "wind_direction": "wind_direction_10m",
}

PEAK_THRESHOLDS = {"aqi": 100, "pm25": 35, "pm10": 150}

WIND_BREAKS = (("calm", 2), ("moderate", 5))
WIND_TOP = "strong"
WIND_UNKNOWN = "unknown"

READING_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CONTEXT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"

# month names as they occur in notices, nominative and genitive
MONTH_NUMBERS = {
    "январь": 1, "января": 1,
    "февраль": 2, "февраля": 2,
    "март": 3, "марта": 3,
    "апрель": 4, "апреля": 4,
    "май": 5, "мая": 5,
    "июнь": 6, "июня": 6,
    "июль": 7, "июля": 7,
    "август": 8, "августа": 8,
    "сентябрь": 9, "сентября": 9,
    "октябрь": 10, "октября": 10,
    "ноябрь": 11, "ноября": 11,
    "декабрь": 12, "декабря": 12,
}

REGIME_STEMS = {"перв": 1, "втор": 2, "трет": 3}
REGIME_LABELS = {0: "Общий прогноз", 1: "Первый режим", 2: "Второй режим", 3: "Третий режим"}

NOTICE_PERIOD_LABEL = "НМУ"
ORDINARY_PERIOD_LABEL = "Обычные часы"

# periods of the notices used when no page could be parsed, all level 0
SEED_PERIODS = (
    ("2026-03-31 19:00:00", "2026-04-01 19:00:00"),
    ("2026-04-07 19:00:00", "2026-04-08 13:00:00"),
    ("2026-04-22 19:00:00", "2026-04-23 07:00:00"),
    ("2026-04-25 19:00:00", "2026-04-26 10:00:00"),
    ("2026-04-26 19:00:00", "2026-04-27 07:00:00"),
    ("2026-04-30 19:00:00", "2026-05-01 19:00:00"),
)

SUPERVISED_FEATURES = (
    "hour",
    "month",
    "weather_temperature",
    "weather_humidity",
    "precipitation",
    "snowfall",
    "surface_pressure",
    "wind_speed",
    "wind_direction",
    "nmu_severity",
)

CLUSTER_FEATURES = (
    "aqi",
    "pm25",
    "pm10",
    "weather_temperature",
    "weather_humidity",
    "wind_speed",
    "surface_pressure",
    "nmu_severity",
)

TEXT_IMPORTANCE_NAME = "nmu_announcement_text_tfidf"

# --- end of fixed values ----------------------------------------------------------------------


@dataclass(frozen=True)
class StreamSettings:
    window: str = "1 hour"
    watermark: str = "2 hours"
    trigger_interval: str = "10 seconds"
    output_mode: str = "update"
    aqi_range: tuple[float, float] = (0, 1000)


@dataclass(frozen=True)
class ModelSettings:
    seed: int = 42
    text_dims: int = 64
    train_percent: int = 80
    trees: int = 80
    depth: int = 8
    logistic_iterations: int = 50
    clusters: int = 4
    features: tuple[str, ...] = SUPERVISED_FEATURES
    cluster_features: tuple[str, ...] = CLUSTER_FEATURES


@dataclass(frozen=True)
class CleaningSpec:
    """How one raw text table becomes a typed one."""

    time_column: str
    time_format: str
    numbers: dict[str, str]
    limits: dict[str, tuple[float, float]]
    key: tuple[str, ...]
    int_keys: tuple[str, ...] = ()
    tie_break: tuple[str, ...] = field(default=())


READING_SPEC = CleaningSpec(
    time_column="time",
    time_format=READING_TIME_FORMAT,
    numbers={name: name for name in READING_LIMITS},
    limits=READING_LIMITS,
    key=("site_id", "timestamp"),
    int_keys=("site_id",),
)

CONTEXT_SPEC = CleaningSpec(
    time_column="time",
    time_format=CONTEXT_TIME_FORMAT,
    numbers=CONTEXT_SOURCE,
    limits=CONTEXT_LIMITS,
    key=("timestamp",),
)
