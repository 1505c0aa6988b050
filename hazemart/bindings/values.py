"""Row-wise parsing and derivation on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazemart import config
from hazemart.bindings import tables as t
from hazemart.bindings.registry import query
from hazemart.bindings.tables import SQL_CONTEXT, SQL_EVENTS, with_roles
from hazemart.functions import coerce, derive
from hazemart.ml.metrics import regression_scores
from hazemart.operators.intervals import valid_intervals
from hazemart.plans.views import is_correct


@query(
    "parse_timestamps",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE WHEN k <> 13 THEN hr END AS reading_time, date_trunc('minute', ts) AS context_time FROM ev"""),
)
def _parse_timestamps(spark, sf_dir):
    both = t.events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("k") == t.BAD_TIME, "yesterday").otherwise(F.date_format("hr", config.READING_TIME_FORMAT)).alias("a"),
        F.date_format("ts", config.CONTEXT_TIME_FORMAT).alias("b"),
    )
    return both.select(
        "event_id",
        coerce.timestamp(F.col("a"), config.READING_TIME_FORMAT).alias("reading_time"),
        coerce.timestamp(F.col("b"), config.CONTEXT_TIME_FORMAT).alias("context_time"),
    )


@query(
    "parse_multi_format",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE k % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
                                WHEN 2 THEN date_trunc('minute', ts) WHEN 3 THEN date_trunc('day', ts) END AS parsed
    FROM ev"""),
)
def _parse_multi_format(spark, sf_dir):
    kind = F.pmod("k", F.lit(5))
    written = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, F.date_format("ts", " yyyy-MM-dd HH:mm "))
        .when(kind == 3, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "dd/MM/yyyy"))
    )
    return t.events(spark, sf_dir).select("event_id", written.alias("w")).select(
        "event_id", coerce.timestamp_any(F.col("w")).alias("parsed")
    )


@query(
    "parse_decimal_comma",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE k WHEN 17 THEN NULL WHEN 37 THEN -1 ELSE q END AS aqi, q * 0.5 AS pressure_part FROM ev"""),
)
def _parse_decimal_comma(spark, sf_dir):
    raw = t.raw_readings(spark, sf_dir).select("event_id", "aqi", "iaqi")
    return raw.select(
        "event_id", coerce.number(F.col("aqi")).alias("aqi"), coerce.number(F.col("iaqi")).alias("pressure_part")
    )


@query(
    "parse_int_via_double",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE WHEN k <> 33 THEN CAST(user_id AS INTEGER) END AS site_id, CAST(floor(q) AS INTEGER) AS whole
    FROM ev"""),
)
def _parse_int_via_double(spark, sf_dir):
    raw = t.raw_readings(spark, sf_dir).select("event_id", "site_id", F.replace("iaqi", F.lit("."), F.lit(",")).alias("half"))
    return raw.select(
        "event_id",
        coerce.integer(F.col("site_id")).alias("site_id"),
        (coerce.number(F.col("half")) * 2).try_cast("int").alias("whole"),
    )


@query(
    "rename_coerce",
    with_roles(SQL_EVENTS, SQL_CONTEXT, select="""
    SELECT hr AS "timestamp", t AS weather_temperature, h AS weather_humidity, CAST(p AS DOUBLE) AS precipitation,
           sp AS surface_pressure, ws AS wind_speed, wd AS wind_direction FROM context_raw"""),
)
def _rename_coerce(spark, sf_dir):
    """Values before the clamp, under their canonical names."""
    renamed = coerce.rename_coerce(t.raw_context(spark, sf_dir), config.CONTEXT_SOURCE)
    return renamed.select(
        coerce.timestamp(F.col("time"), config.CONTEXT_TIME_FORMAT).alias("timestamp"),
        "weather_temperature", "weather_humidity", "precipitation", "surface_pressure", "wind_speed", "wind_direction",
    )


@query(
    "clamp_to_null",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE WHEN q * 0.5 BETWEEN 0 AND 100 THEN q * 0.5 END AS humidity,
           CASE WHEN q * 0.25 - 50 BETWEEN -60 AND 60 THEN q * 0.25 - 50 END AS temperature,
           CASE WHEN k NOT IN (17, 37) THEN q END AS aqi, CASE WHEN k <> 21 THEN q * 0.25 END AS pm25
    FROM ev"""),
)
def _clamp_to_null(spark, sf_dir):
    names = ["humidity", "temperature", "aqi", "pm25"]
    raw = t.raw_readings(spark, sf_dir)
    typed = raw.select("event_id", *[coerce.number(F.col(n)).alias(n) for n in names])
    return derive.clamp_columns(typed, {n: config.READING_LIMITS[n] for n in names})


@query(
    "calendar_features",
    """SELECT event_id, CAST(ts AS DATE) AS "date", CAST(hour(ts) AS INTEGER) AS "hour",
              CAST(month(ts) AS INTEGER) AS "month" FROM events""",
)
def _calendar_features(spark, sf_dir):
    ev = t.table(spark, sf_dir, "events").select("event_id", "ts")
    return ev.withColumns(derive.calendar_parts(F.col("ts"))).drop("ts")


@query(
    "threshold_flag",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, coalesce(q > 100, false) OR coalesce(q * 0.25 > 35, false)
                     OR coalesce(CASE WHEN k <> 29 THEN q * 0.5 END > 150, false) AS is_pollution_peak FROM ev"""),
)
def _threshold_flag(spark, sf_dir):
    rows = t.events(spark, sf_dir).select(
        "event_id", F.col("q").alias("aqi"), (F.col("q") * 0.25).alias("pm25"),
        F.when(F.col("k") != t.NO_PM10, F.col("q") * 0.5).alias("pm10"),
    )
    return rows.select("event_id", derive.above_any(config.PEAK_THRESHOLDS).alias("is_pollution_peak"))


@query(
    "missing_flag",
    with_roles(SQL_EVENTS, select="SELECT event_id, k IN (17, 29) AS has_missing_pollution_value FROM ev"),
)
def _missing_flag(spark, sf_dir):
    raw = t.raw_readings(spark, sf_dir).select("event_id", *[coerce.number(F.col(n)).alias(n) for n in config.PEAK_THRESHOLDS])
    return raw.select("event_id", derive.missing_any(list(config.PEAK_THRESHOLDS)).alias("has_missing_pollution_value"))


@query(
    "bucketize",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE WHEN k = 29 THEN 'unknown' WHEN q / 16 < 2 THEN 'calm' WHEN q / 16 < 5 THEN 'moderate'
                          ELSE 'strong' END AS wind_speed_group FROM ev"""),
)
def _bucketize(spark, sf_dir):
    speed = F.when(F.col("k") != 29, F.col("q") / 16)
    group = derive.bucket(speed, config.WIND_BREAKS, config.WIND_TOP, config.WIND_UNKNOWN)
    return t.events(spark, sf_dir).select("event_id", group.alias("wind_speed_group"))


@query(
    "positive_flag",
    with_roles(SQL_EVENTS, select="SELECT event_id, k <> 29 AND q - 10 > 0 AS is_positive FROM ev"),
)
def _positive_flag(spark, sf_dir):
    value = F.when(F.col("k") != 29, F.col("q") - 10)
    return t.events(spark, sf_dir).select("event_id", derive.positive(value).alias("is_positive"))


@query(
    "parse_bool",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 4 THEN NULL ELSE 0 END AS mart_flag,
           CASE WHEN k % 5 IN (0, 1) THEN 1 ELSE 0 END AS serving_flag FROM ev"""),
)
def _parse_bool(spark, sf_dir):
    """Three-valued and two-valued reading of the same text, shown as 1, 0 or null."""
    words = F.element_at(F.array(F.lit("TRUE"), F.lit("true"), F.lit("False"), F.lit("no"), F.lit(None)), F.pmod("k", F.lit(5)) + 1)
    rows = t.events(spark, sf_dir).select("event_id", words.alias("w"))
    return rows.select(
        "event_id",
        coerce.boolean(F.col("w")).cast("int").alias("mart_flag"),
        coerce.boolean(F.col("w"), unknown=False).cast("int").alias("serving_flag"),
    )


@query(
    "default_fill",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE WHEN k < 60 THEN k ELSE 0 END AS nmu_regime_level,
           CASE WHEN k < 60 THEN event_type ELSE '' END AS announcement_text FROM ev"""),
)
def _default_fill(spark, sf_dir):
    known = F.col("k") < 60
    rows = t.events(spark, sf_dir).select(
        "event_id", F.when(known, F.col("k")).alias("nmu_regime_level"), F.when(known, F.col("event_type")).alias("announcement_text")
    )
    return rows.withColumns(derive.fill({"nmu_regime_level": 0, "announcement_text": ""}))


@query(
    "ordinal_severity",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 1 + k % 4 ELSE 0 END AS nmu_severity FROM ev"""),
)
def _ordinal_severity(spark, sf_dir):
    noticed = F.col("event_type") == "error"
    rows = t.events(spark, sf_dir).select(
        "event_id", F.when(noticed, F.lit(1)).alias("nmu_present"), F.when(noticed, F.pmod("k", F.lit(4))).alias("nmu_regime_level")
    )
    filled = rows.withColumns(derive.fill({"nmu_present": 0, "nmu_regime_level": 0}))
    return filled.select(
        "event_id", derive.severity(F.col("nmu_present"), F.col("nmu_regime_level")).alias("nmu_severity")
    )


@query(
    "valid_intervals",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate AS period_start, l_shipdate AS period_end
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate""",
)
def _valid_intervals(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("period_end"))
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("period_start"))
    return valid_intervals(lines.join(orders, "l_orderkey"))


@query(
    "score_regression",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, 'line' AS model, round(CAST(q AS DECIMAL(18, 6)), 2)::DOUBLE AS actual_aqi,
           round(CAST(q * 0.75 + 2 AS DECIMAL(18, 6)), 2)::DOUBLE AS predicted_aqi,
           round(CAST(abs(q * 0.75 + 2 - q) AS DECIMAL(18, 6)), 2)::DOUBLE AS abs_error FROM ev"""),
)
def _score_regression(spark, sf_dir):
    scored = t.events(spark, sf_dir).select("event_id", F.col("q").alias("label"), (F.col("q") * 0.75 + 2).alias("prediction"))
    return scored.withColumns({"model": F.lit("line"), **regression_scores()}).drop("label", "prediction")


@query(
    "score_classification",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE WHEN q > 100 THEN 1 ELSE 0 END AS actual_peak, CASE WHEN k > 80 THEN 1 ELSE 0 END AS predicted_peak,
           CASE WHEN (q > 100) = (k > 80) THEN 1 ELSE 0 END AS is_correct FROM ev"""),
)
def _score_classification(spark, sf_dir):
    rows = t.events(spark, sf_dir).select(
        "event_id", (F.col("q") > 100).cast("int").alias("actual_peak"), (F.col("k") > 80).cast("int").alias("predicted_peak")
    )
    return rows.withColumn("is_correct", is_correct())
