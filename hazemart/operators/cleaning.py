"""Raw text tables to typed, clamped, deduplicated tables, and the audit of that step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hazemart import config
from hazemart.config import CleaningSpec
from hazemart.functions import coerce, derive
from hazemart.operators.dedup import first_per_key

READING_COLUMNS = (
    "site_id", "timestamp", "date", "hour", "month", *config.READING_LIMITS,
    "is_pollution_peak", "has_missing_pollution_value",
)
CONTEXT_COLUMNS = (
    "timestamp", "date", "hour", *config.CONTEXT_LIMITS, "wind_speed_group", "has_precipitation",
)


def cast_rows(raw: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Every row with typed columns; what cannot be read is null. Tie-break columns are kept."""
    return raw.select(
        *[coerce.integer(F.col(c)).alias(c) for c in spec.int_keys],
        coerce.timestamp(F.col(spec.time_column), spec.time_format).alias("timestamp"),
        *[coerce.number(F.col(source)).alias(target) for target, source in spec.numbers.items()],
        *[c for c in spec.tie_break],
    )


def typed(raw: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Typed and clamped rows that have a whole key; tie-break columns are kept.

    Cast and clamp are two projections, so that the clamp reads each cast value once.
    """
    return whole_rows(cast_rows(raw, spec), spec)


def whole_rows(cast: DataFrame, spec: CleaningSpec) -> DataFrame:
    return derive.clamp_columns(cast, spec.limits).dropna(subset=list(spec.key))


def deduplicated(rows: DataFrame, spec: CleaningSpec) -> DataFrame:
    """First row per key by the tie-break columns, or by all values where none are declared.

    A declared tie-break must be unique within a key. Values that nobody reads later are then
    neither sorted nor scanned.
    """
    order = spec.tie_break or [c for c in rows.columns if c not in spec.key]
    return first_per_key(rows, list(spec.key), order).drop(*spec.tie_break)


def reading_flags(thresholds: dict[str, float] | None = None) -> dict[str, Column]:
    limits = config.PEAK_THRESHOLDS if thresholds is None else thresholds
    return {
        "is_pollution_peak": derive.above_any(limits),
        "has_missing_pollution_value": derive.missing_any(list(limits)),
    }


def clean_readings(raw: DataFrame, spec: CleaningSpec = config.READING_SPEC) -> DataFrame:
    return flagged(deduplicated(typed(raw, spec), spec))


def flagged(rows: DataFrame) -> DataFrame:
    parts = derive.calendar_parts(F.col("timestamp"))
    return rows.withColumns({**parts, **reading_flags()}).select(*READING_COLUMNS)


def clean_context(
    raw: DataFrame,
    spec: CleaningSpec = config.CONTEXT_SPEC,
    breaks=config.WIND_BREAKS,
    top: str = config.WIND_TOP,
    unknown: str = config.WIND_UNKNOWN,
) -> DataFrame:
    rows = deduplicated(typed(raw, spec), spec)
    return rows.withColumns(
        {
            **derive.calendar_parts(F.col("timestamp"), month=False),
            "wind_speed_group": derive.bucket(F.col("wind_speed"), breaks, top, unknown),
            "has_precipitation": derive.positive(F.col("precipitation")),
        }
    ).select(*CONTEXT_COLUMNS)


def _reasons(spec: CleaningSpec) -> list[Column]:
    """Counts over cast rows: all of them, those without a key number, and of the others those without a time."""
    bad_key = F.lit(False)
    for name in spec.int_keys:
        bad_key = bad_key | F.col(name).isNull()
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        derive.count_if(bad_key).alias("bad_key_rows"),
        derive.count_if(~bad_key & F.col("timestamp").isNull()).alias("bad_time_rows"),
    ]


def cleaning_audit(raw: DataFrame, cleaned: DataFrame, spec: CleaningSpec = config.READING_SPEC) -> DataFrame:
    """One row: raw, cleaned and removed counts, and why rows were removed."""
    kept = cleaned.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = cast_rows(raw, spec).agg(*_reasons(spec)).withColumn("cleaned_rows", kept)
    removed = F.col("raw_rows") - F.col("cleaned_rows")
    return counts.withColumns({"removed_rows": removed, "duplicate_rows": removed - F.col("bad_key_rows") - F.col("bad_time_rows")})


class CleaningAudit:
    """The audit of one cleaning, filled by the action that writes its result, without another pass.

    A session that has observed cannot evaluate Spark ML's model summaries any more (its observation
    manager does not serialize), so a job observes in a session of its own.
    """

    def __init__(self) -> None:
        self._before, self._after = Observation("before"), Observation("after")

    def clean(self, raw: DataFrame, spec: CleaningSpec = config.READING_SPEC) -> DataFrame:
        cast = cast_rows(raw, spec).observe(self._before, *_reasons(spec))
        rows = flagged(deduplicated(whole_rows(cast, spec), spec))
        return rows.observe(self._after, F.count(F.lit(1)).alias("cleaned_rows"))

    def counts(self) -> dict[str, int]:
        """After the action; it waits for one that still runs."""
        found = {**self._before.get, **self._after.get}
        found["removed_rows"] = found["raw_rows"] - found["cleaned_rows"]
        found["duplicate_rows"] = found["removed_rows"] - found["bad_key_rows"] - found["bad_time_rows"]
        return found
