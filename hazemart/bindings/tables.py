"""The roles of the engine, played by the given tables.

Each event is one raw reading: ``user_id`` is the site and the hour of ``ts`` its time. Measured
values are multiples of 1/8, the resolution of the sensor, so sums are exact in any order. Some
payload numbers stand for the dirt of real sources: unreadable times, sites and values. Hours with
view events have weather, large error events announce notices, suppliers name the sites.

``SQL_*`` are the same roles as common table expressions for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemart import config
from hazemart.functions import text
from hazemart.operators.cleaning import clean_context, clean_readings
from hazemart.operators.notices import notice_hours
from hazemart.plans.marts import hourly_mart

BAD_TIME, BAD_AQI, NAN_PM25, NO_PM10, BAD_SITE, NEGATIVE_AQI = 13, 17, 21, 29, 33, 37

READING_SPEC = config.CleaningSpec(
    **{**config.READING_SPEC.__dict__, "tie_break": ("event_id",)}
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_measures(events: DataFrame) -> DataFrame:
    """Payload number ``k``, value ``q`` at sensor resolution and full hour ``hr``; works on streams too."""
    return events.withColumns(
        {
            "k": F.get_json_object("props", "$.k").try_cast("int"),
            "q": F.floor(F.col("value") * 8) / 8,
            "ts": F.col("ts").cast("timestamp"),
        }
    ).withColumn("hr", F.date_trunc("HOUR", "ts"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_measures(table(spark, sf_dir, "events"))


def as_raw_readings(measured: DataFrame, *keep: str) -> DataFrame:
    """Text columns as a source would deliver them, with decimal commas; ``keep`` names more columns."""
    k, q = F.col("k"), F.col("q")

    def written(value):
        return value.cast("string")

    return measured.select(
        F.when(k == BAD_SITE, "x7").otherwise(F.concat(written(F.col("user_id")), F.lit(".0"))).alias("site_id"),
        F.when(k == BAD_TIME, "yesterday")
        .otherwise(F.date_format("hr", config.READING_TIME_FORMAT)).alias("time"),
        F.when(k == BAD_AQI, "n/a").when(k == NEGATIVE_AQI, "-1")
        .otherwise(F.replace(written(q), F.lit("."), F.lit(","))).alias("aqi"),
        written(q * 0.5).alias("iaqi"),
        F.when(k == NAN_PM25, "NaN").otherwise(written(q * 0.25)).alias("pm25"),
        F.when(k != NO_PM10, written(q * 0.5)).alias("pm10"),
        written(q * 0.25).alias("pm25_mcp"),
        written(q * 0.25 - 50).alias("temperature"),
        written(q * 0.5).alias("humidity"),
        written(q * 0.5 + 640).alias("pressure"),
        "event_id",
        *keep,
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw_readings(events(spark, sf_dir))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_readings(raw_readings(spark, sf_dir), READING_SPEC)


def raw_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = events(spark, sf_dir).where("event_type = 'view'").groupBy("hr").agg(
        F.count(F.lit(1)).alias("n"), F.max("q").alias("mx"), F.min("q").alias("mn"), F.sum("q").alias("sm")
    )
    wet = F.when(F.col("n") >= 3, F.col("mn") * 0.25).otherwise(F.lit(0.0))
    measured = {
        "temperature_2m": F.col("mx") * 0.25 - 20,
        "relative_humidity_2m": F.col("mx") * 0.5,
        "precipitation": wet,
        "rain": wet * 0.5,
        "snowfall": F.lit(0.0),
        "surface_pressure": F.pmod(F.col("sm") * 0.5, F.lit(500.0)) + 640,
        "wind_speed_10m": F.when(F.col("n") > 1, F.col("mx") / 16),
        "wind_direction_10m": F.pmod(F.col("sm") * 2, F.lit(400.0)),
    }
    return views.select(
        F.date_format("hr", config.CONTEXT_TIME_FORMAT).alias("time"),
        *[value.cast("string").alias(name) for name, value in measured.items()],
    )


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_context(raw_context(spark, sf_dir))


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = events(spark, sf_dir).where("event_type = 'error'")
    hours = F.floor(F.col("value") / 20).cast("int")
    level = F.pmod(F.col("k"), F.lit(4)).cast("int")
    return alarms.select(
        F.col("hr").alias("period_start"),
        (F.col("hr") + F.make_dt_interval(hours=hours)).alias("period_end"),
        text.regime_label(level).alias("regime"),
        level.alias("regime_level"),
        F.concat(F.lit("level "), level.cast("string"), F.lit(" for "), hours.cast("string"), F.lit(" hours"))
        .alias("announcement_text"),
    )


def hours_under_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notice_hours(notices(spark, sf_dir))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("site_id"), F.col("s_name").alias("site_name")
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_mart(readings(spark, sf_dir), context(spark, sf_dir))


# --- the same in SQL --------------------------------------------------------------------------

SQL_EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         floor(value * 8) / 8 AS q,
         date_trunc('hour', ts) AS hr
  FROM events)
"""

SQL_READINGS = SQL_EVENTS + """
, first_ev AS (
  SELECT * FROM ev WHERE k NOT IN (13, 33)
  QUALIFY row_number() OVER (PARTITION BY user_id, hr ORDER BY event_id) = 1)
, measured AS (
  SELECT CAST(user_id AS INTEGER) AS site_id, hr AS "timestamp", CAST(hr AS DATE) AS "date",
         CAST(hour(hr) AS INTEGER) AS "hour", CAST(month(hr) AS INTEGER) AS "month",
         CASE WHEN k NOT IN (17, 37) AND q BETWEEN 0 AND 1000 THEN q END AS aqi,
         CASE WHEN q * 0.5 BETWEEN 0 AND 1000 THEN q * 0.5 END AS iaqi,
         CASE WHEN k <> 21 AND q * 0.25 BETWEEN 0 AND 2000 THEN q * 0.25 END AS pm25,
         CASE WHEN k <> 29 AND q * 0.5 BETWEEN 0 AND 3000 THEN q * 0.5 END AS pm10,
         CASE WHEN q * 0.25 BETWEEN 0 AND 2000 THEN q * 0.25 END AS pm25_mcp,
         CASE WHEN q * 0.25 - 50 BETWEEN -60 AND 60 THEN q * 0.25 - 50 END AS temperature,
         CASE WHEN q * 0.5 BETWEEN 0 AND 100 THEN q * 0.5 END AS humidity,
         CASE WHEN q * 0.5 + 640 BETWEEN 650 AND 820 THEN q * 0.5 + 640 END AS pressure
  FROM first_ev)
, readings AS (
  SELECT *, coalesce(aqi > 100, false) OR coalesce(pm25 > 35, false) OR coalesce(pm10 > 150, false) AS is_pollution_peak,
         aqi IS NULL OR pm25 IS NULL OR pm10 IS NULL AS has_missing_pollution_value
  FROM measured)
"""

SQL_CONTEXT = """
, view_hours AS (
  SELECT hr, count(*) AS n, max(q) AS mx, min(q) AS mn, sum(q) AS sm
  FROM ev WHERE event_type = 'view' GROUP BY hr)
, context_raw AS (
  SELECT hr, mx * 0.25 - 20 AS t, mx * 0.5 AS h, CASE WHEN n >= 3 THEN mn * 0.25 ELSE 0.0 END AS p,
         (sm * 0.5) % 500 + 640 AS sp, CASE WHEN n > 1 THEN mx / 16 END AS ws, (sm * 2) % 400 AS wd
  FROM view_hours)
, context AS (
  SELECT hr AS "timestamp", CAST(hr AS DATE) AS "date", CAST(hour(hr) AS INTEGER) AS "hour",
         CASE WHEN t BETWEEN -60 AND 60 THEN t END AS weather_temperature,
         CASE WHEN h BETWEEN 0 AND 100 THEN h END AS weather_humidity,
         CASE WHEN p BETWEEN 0 AND 500 THEN CAST(p AS DOUBLE) END AS precipitation,
         CASE WHEN p * 0.5 BETWEEN 0 AND 500 THEN CAST(p * 0.5 AS DOUBLE) END AS rain,
         CAST(0 AS DOUBLE) AS snowfall,
         CASE WHEN sp BETWEEN 650 AND 1100 THEN sp END AS surface_pressure,
         CASE WHEN ws BETWEEN 0 AND 80 THEN ws END AS wind_speed,
         CASE WHEN wd BETWEEN 0 AND 360 THEN wd END AS wind_direction,
         CASE WHEN ws IS NULL OR ws > 80 THEN 'unknown' WHEN ws < 2 THEN 'calm' WHEN ws < 5 THEN 'moderate'
              ELSE 'strong' END AS wind_speed_group,
         coalesce(p BETWEEN 0 AND 500 AND p > 0, false) AS has_precipitation
  FROM context_raw)
"""

SQL_NOTICES = """
, notices AS (
  SELECT hr AS period_start, hr + to_hours(CAST(floor(value / 20) AS BIGINT)) AS period_end,
         CAST(k % 4 AS INTEGER) AS regime_level,
         CASE k % 4 WHEN 0 THEN 'Общий прогноз' WHEN 1 THEN 'Первый режим' WHEN 2 THEN 'Второй режим'
              ELSE 'Третий режим' END AS regime,
         'level ' || (k % 4) || ' for ' || CAST(floor(value / 20) AS INTEGER) || ' hours' AS announcement_text
  FROM ev WHERE event_type = 'error')
, notice_steps AS (
  SELECT *, unnest(generate_series(period_start, period_end, INTERVAL 1 HOUR)) AS "timestamp" FROM notices)
, notice_hours AS (
  SELECT "timestamp", CAST("timestamp" AS DATE) AS "date", CAST(hour("timestamp") AS INTEGER) AS "hour",
         true AS is_nmu, regime, regime_level, announcement_text
  FROM notice_steps WHERE "timestamp" < period_end
  QUALIFY row_number() OVER (PARTITION BY "timestamp"
                             ORDER BY regime_level DESC, period_start, period_end, announcement_text) = 1)
"""

SQL_SITES = """
, sites AS (SELECT CAST(s_suppkey AS INTEGER) AS site_id, s_name AS site_name FROM supplier)
"""

SQL_HOURLY = """
, hourly AS (
  SELECT r.site_id, r."timestamp", r."date", r."hour", r."month", r.aqi, r.pm25, r.pm10,
         r.temperature AS air_temperature, r.humidity AS air_humidity, r.pressure AS air_pressure,
         r.is_pollution_peak, r.has_missing_pollution_value,
         c.weather_temperature, c.weather_humidity, c.precipitation, c.rain, c.snowfall, c.surface_pressure,
         c.wind_speed, c.wind_direction, c.wind_speed_group, c.has_precipitation
  FROM readings r LEFT JOIN context c USING ("timestamp"))
"""


def with_roles(*parts: str, select: str) -> str:
    return "WITH " + "".join(parts) + select


ALL_ROLES = (SQL_READINGS, SQL_CONTEXT, SQL_NOTICES, SQL_SITES, SQL_HOURLY)
