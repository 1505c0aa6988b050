"""Cleaning, joins, marts and views on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazemart.bindings import tables as t
from hazemart.bindings.registry import query
from hazemart.bindings.tables import ALL_ROLES, SQL_CONTEXT, SQL_EVENTS, SQL_HOURLY, SQL_NOTICES, SQL_READINGS, SQL_SITES, with_roles
from hazemart.functions import coerce
from hazemart.ml.clusters import group_profile
from hazemart.operators import cleaning, dedup, intervals, joins
from hazemart.operators.compare import notice_periods
from hazemart.plans import marts, views
from hazemart.plans.features import feature_table
from hazemart.plans.serving import SERVING_SCHEMAS

SQL_DAILY = """
, daily AS (
  SELECT "date", site_id, count(*) AS rows_count,
         avg(aqi) AS avg_aqi, max(aqi) AS max_aqi, avg(pm25) AS avg_pm25, max(pm25) AS max_pm25,
         avg(pm10) AS avg_pm10, max(pm10) AS max_pm10,
         avg(weather_temperature) AS avg_weather_temperature, avg(weather_humidity) AS avg_weather_humidity,
         avg(wind_speed) AS avg_wind_speed, sum(precipitation) AS total_precipitation,
         CAST(count(*) FILTER (WHERE is_pollution_peak) AS BIGINT) AS pollution_peak_count,
         CAST(count(*) FILTER (WHERE has_precipitation) AS BIGINT) AS precipitation_hours
  FROM hourly GROUP BY "date", site_id)
"""
SQL_BUCKET = """
, bucket AS (
  SELECT site_id, wind_speed_group, count(*) AS rows_count, avg(aqi) AS avg_aqi, avg(pm25) AS avg_pm25,
         avg(pm10) AS avg_pm10, CAST(count(*) FILTER (WHERE is_pollution_peak) AS BIGINT) AS pollution_peak_count
  FROM hourly GROUP BY site_id, wind_speed_group)
"""
SQL_QUALITY = """
, quality AS (
  SELECT count(*) AS rows_count, count(*) FILTER (WHERE weather_temperature IS NULL) AS missing_weather_rows,
         count(*) FILTER (WHERE has_missing_pollution_value) AS missing_pollution_rows,
         count(DISTINCT site_id) AS site_count, min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp
  FROM hourly)
"""


@query("clean_readings", with_roles(SQL_READINGS, select="SELECT * FROM readings"))
def _clean_readings(spark, sf_dir):
    return t.readings(spark, sf_dir)


@query("clean_context", with_roles(SQL_EVENTS, SQL_CONTEXT, select="SELECT * FROM context"))
def _clean_context(spark, sf_dir):
    return t.context(spark, sf_dir)


@query(
    "cleaning_audit",
    with_roles(SQL_READINGS, select="""
    SELECT (SELECT count(*) FROM events) AS raw_rows, (SELECT count(*) FROM readings) AS cleaned_rows,
           (SELECT count(*) FROM events) - (SELECT count(*) FROM readings) AS removed_rows,
           count(*) FILTER (WHERE k = 33) AS bad_key_rows, count(*) FILTER (WHERE k = 13) AS bad_time_rows,
           count(*) FILTER (WHERE k IS NULL OR k NOT IN (13, 33)) - (SELECT count(*) FROM readings) AS duplicate_rows
    FROM ev"""),
)
def _cleaning_audit(spark, sf_dir):
    return cleaning.cleaning_audit(t.raw_readings(spark, sf_dir), t.readings(spark, sf_dir))


@query(
    "dedup_readings",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) = 1""",
)
def _dedup_readings(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    return dedup.first_per_key(
        t.table(spark, sf_dir, "lineitem").select(*columns),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"],
    )


@query(
    "dedup_context",
    with_roles(SQL_EVENTS, select="""
    SELECT hr AS "timestamp", q AS weather_value, event_id FROM ev
    QUALIFY row_number() OVER (PARTITION BY hr ORDER BY event_id) = 1"""),
)
def _dedup_context(spark, sf_dir):
    rows = t.events(spark, sf_dir).select(F.col("hr").alias("timestamp"), F.col("q").alias("weather_value"), "event_id")
    return dedup.first_per_key(rows, ["timestamp"], ["event_id"])


@query(
    "dedup_keep_last",
    with_roles(SQL_EVENTS, select="""
    SELECT hr AS period_start, hr + to_hours(CAST(floor(value / 20) + 1 AS BIGINT)) AS period_end, event_id AS seq, k % 4 AS level
    FROM ev
    QUALIFY row_number() OVER (PARTITION BY hr, floor(value / 20) ORDER BY event_id DESC) = 1"""),
)
def _dedup_keep_last(spark, sf_dir):
    rows = t.events(spark, sf_dir).select(
        F.col("hr").alias("period_start"),
        (F.col("hr") + F.make_dt_interval(hours=(F.floor(F.col("value") / 20) + 1).cast("int"))).alias("period_end"),
        F.col("event_id").alias("seq"),
        F.pmod("k", F.lit(4)).alias("level"),
    )
    return dedup.last_per_key(rows, ["period_start", "period_end"], "seq")


@query("expand_intervals", with_roles(SQL_EVENTS, SQL_NOTICES, select="SELECT * FROM notice_hours"))
def _expand_intervals(spark, sf_dir):
    return t.hours_under_notice(spark, sf_dir)


def order_spans(spark, sf_dir):
    """From order to shipment of every line."""
    lines = t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_orderdate").cast("timestamp").alias("period_start"),
        F.col("l_shipdate").cast("timestamp").alias("period_end"),
    )


@query(
    "expand_order_months",
    """WITH spans AS (
         SELECT o_orderdate AS period_start, l_shipdate AS period_end
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate)
       , months AS (
         SELECT period_end,
                unnest(generate_series(date_trunc('month', period_start), period_end, INTERVAL 1 MONTH)) AS open_month
         FROM spans)
       SELECT open_month, count(*) AS open_lines FROM months WHERE open_month < period_end GROUP BY open_month""",
)
def _expand_order_months(spark, sf_dir):
    """Order lines that are open in each month: long intervals, many of them reversed."""
    months = intervals.expand_intervals(order_spans(spark, sf_dir), slot="open_month", unit="MONTH", align=True)
    return months.groupBy("open_month").agg(F.count(F.lit(1)).alias("open_lines"))


@query(
    "expand_order_days",
    """WITH spans AS (
         SELECT o_orderdate AS period_start, l_shipdate AS period_end
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate)
       , days AS (SELECT period_end, unnest(generate_series(period_start, period_end, INTERVAL 1 DAY)) AS day FROM spans)
       SELECT date_trunc('month', day) AS open_month, count(*) AS open_line_days FROM days WHERE day < period_end
       GROUP BY 1""",
)
def _expand_order_days(spark, sf_dir):
    """Days that order lines stay open, by month."""
    days = intervals.count_steps(order_spans(spark, sf_dir), slot="day", unit="DAY", count="open_lines")
    return days.groupBy(F.date_trunc("MONTH", "day").alias("open_month")).agg(F.sum("open_lines").alias("open_line_days"))


@query(
    "hourly_mart",
    with_roles(SQL_READINGS, SQL_CONTEXT, SQL_HOURLY, select="""
    SELECT * REPLACE (CAST(has_precipitation AS INTEGER) AS has_precipitation) FROM hourly"""),
)
def _hourly_mart(spark, sf_dir):
    """``has_precipitation`` is null where there is no weather; shown as 1, 0 or null."""
    return t.hourly(spark, sf_dir).withColumn("has_precipitation", F.col("has_precipitation").cast("int"))


@query("daily_mart", with_roles(SQL_READINGS, SQL_CONTEXT, SQL_HOURLY, SQL_DAILY, select="SELECT * FROM daily"))
def daily_mart(spark, sf_dir):
    return marts.daily_mart(t.hourly(spark, sf_dir))


@query("bucket_mart", with_roles(SQL_READINGS, SQL_CONTEXT, SQL_HOURLY, SQL_BUCKET, select="SELECT * FROM bucket"))
def _bucket_mart(spark, sf_dir):
    return marts.bucket_mart(t.hourly(spark, sf_dir))


@query("quality_summary", with_roles(SQL_READINGS, SQL_CONTEXT, SQL_HOURLY, SQL_QUALITY, select="SELECT * FROM quality"))
def _quality_summary(spark, sf_dir):
    return marts.quality_mart(t.hourly(spark, sf_dir))


SQL_FEATURES = """
, features AS (
  SELECT r.site_id, r."timestamp", r."hour", r."month", r.aqi, r.pm25, r.pm10,
         CAST(r.is_pollution_peak AS INTEGER) AS is_pollution_peak,
         c.weather_temperature, c.weather_humidity, c.precipitation, c.snowfall, c.surface_pressure,
         c.wind_speed, c.wind_direction,
         coalesce(n.regime_level, 0) AS nmu_regime_level,
         CASE WHEN n."timestamp" IS NULL THEN 0 ELSE 1 END AS nmu_present,
         coalesce(n.announcement_text, '') AS announcement_text,
         CASE WHEN n."timestamp" IS NULL THEN 0 ELSE 1 END AS is_nmu,
         CASE WHEN n."timestamp" IS NULL THEN 0 ELSE 1 + n.regime_level END AS nmu_severity,
         r."date"
  FROM readings r LEFT JOIN context c USING ("timestamp") LEFT JOIN notice_hours n USING ("timestamp"))
"""
FEATURE_ROLES = (SQL_READINGS, SQL_CONTEXT, SQL_NOTICES, SQL_FEATURES)


def features(spark, sf_dir):
    return feature_table(t.readings(spark, sf_dir), t.context(spark, sf_dir), t.hours_under_notice(spark, sf_dir))


@query("feature_table", with_roles(*FEATURE_ROLES, select="SELECT * FROM features"))
def _feature_table(spark, sf_dir):
    return features(spark, sf_dir)


@query(
    "dim_enrich",
    with_roles(SQL_READINGS, SQL_SITES, select="""
    SELECT r.site_id, r."timestamp", r.aqi, s.site_name FROM readings r LEFT JOIN sites s USING (site_id)"""),
)
def _dim_enrich(spark, sf_dir):
    facts = t.readings(spark, sf_dir).select("site_id", "timestamp", "aqi")
    return joins.attach_names(facts, t.sites(spark, sf_dir), "site_id", ["site_name"])


@query(
    "mark_existing",
    with_roles(SQL_READINGS, SQL_NOTICES, select="""
    SELECT r.site_id, r."timestamp", n."timestamp" IS NOT NULL AS under_notice
    FROM readings r LEFT JOIN (SELECT DISTINCT "timestamp" FROM notice_hours) n USING ("timestamp")"""),
)
def _mark_existing(spark, sf_dir):
    facts = t.readings(spark, sf_dir).select("site_id", "timestamp")
    return joins.mark_existing(facts, t.hours_under_notice(spark, sf_dir), ["timestamp"], "under_notice")


@query(
    "filter_id_set",
    """SELECT event_id, user_id, ts FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
)
def _filter_id_set(spark, sf_dir):
    ids = t.table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("user_id"))
    return joins.keep_ids(t.table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ids, "user_id")


@query(
    "compare_periods",
    with_roles(SQL_READINGS, SQL_NOTICES, select="""
    SELECT CASE WHEN n."timestamp" IS NOT NULL THEN 'НМУ' ELSE 'Обычные часы' END AS nmu_status,
           count(*) AS rows_count, avg(aqi) AS avg_aqi, avg(pm25) AS avg_pm25, avg(pm10) AS avg_pm10,
           count(*) FILTER (WHERE is_pollution_peak) AS pollution_peak_count,
           count(*) FILTER (WHERE is_pollution_peak) / count(*) AS pollution_peak_share
    FROM readings r LEFT JOIN (SELECT DISTINCT "timestamp" FROM notice_hours) n USING ("timestamp")
    GROUP BY 1"""),
)
def _compare_periods(spark, sf_dir):
    return notice_periods(t.readings(spark, sf_dir), t.hours_under_notice(spark, sf_dir))


_POLLUTANTS = """avg(aqi) AS avg_aqi, max(aqi) AS max_aqi, avg(pm25) AS avg_pm25, max(pm25) AS max_pm25,
                 avg(pm10) AS avg_pm10, max(pm10) AS max_pm10"""
_COUNTS = """count(*) FILTER (WHERE is_pollution_peak) AS pollution_peak_count,
             count(*) FILTER (WHERE has_missing_pollution_value) AS missing_pollution_count"""


@query(
    "view_daily_by_site",
    with_roles(SQL_READINGS, SQL_SITES, select=f"""
    SELECT "date", site_id, site_name, count(*) AS rows_count, {_POLLUTANTS}, avg(temperature) AS avg_temperature,
           avg(humidity) AS avg_humidity, avg(pressure) AS avg_pressure, {_COUNTS}
    FROM readings LEFT JOIN sites USING (site_id) GROUP BY "date", site_id, site_name"""),
)
def _view_daily_by_site(spark, sf_dir):
    return views.daily_by_site(t.readings(spark, sf_dir), t.sites(spark, sf_dir))


@query(
    "view_hourly_profile",
    with_roles(SQL_READINGS, SQL_SITES, select="""
    SELECT site_id, site_name, "hour", count(*) AS rows_count, avg(aqi) AS avg_aqi, avg(pm25) AS avg_pm25,
           avg(pm10) AS avg_pm10, avg(temperature) AS avg_temperature,
           count(*) FILTER (WHERE is_pollution_peak) AS pollution_peak_count
    FROM readings LEFT JOIN sites USING (site_id) GROUP BY site_id, site_name, "hour" """),
)
def _view_hourly_profile(spark, sf_dir):
    return views.hourly_profile(t.readings(spark, sf_dir), t.sites(spark, sf_dir))


@query(
    "view_site_summary",
    with_roles(SQL_READINGS, SQL_SITES, select=f"""
    SELECT site_id, site_name, count(*) AS rows_count, min("timestamp") AS first_timestamp,
           max("timestamp") AS last_timestamp, {_POLLUTANTS}, {_COUNTS}
    FROM readings LEFT JOIN sites USING (site_id) GROUP BY site_id, site_name"""),
)
def _view_site_summary(spark, sf_dir):
    return views.site_summary(t.readings(spark, sf_dir), t.sites(spark, sf_dir))


@query(
    "view_passthrough",
    with_roles(SQL_READINGS, SQL_CONTEXT, SQL_SITES, SQL_HOURLY, SQL_DAILY, select="""
    SELECT daily.*, site_name FROM daily LEFT JOIN sites USING (site_id)"""),
)
def _view_passthrough(spark, sf_dir):
    return views.named(marts.daily_mart(t.hourly(spark, sf_dir)), t.sites(spark, sf_dir))


@query(
    "view_by_wind",
    with_roles(SQL_READINGS, SQL_CONTEXT, SQL_SITES, SQL_HOURLY, SQL_BUCKET, select="""
    SELECT bucket.*, site_name FROM bucket LEFT JOIN sites USING (site_id)"""),
)
def _view_by_wind(spark, sf_dir):
    return views.named(marts.bucket_mart(t.hourly(spark, sf_dir)), t.sites(spark, sf_dir))


@query(
    "group_profile",
    with_roles(*FEATURE_ROLES, select="""
    SELECT "hour", count(*) AS rows_count, round(avg(aqi), 4) AS avg_aqi, round(avg(nmu_severity), 4) AS avg_nmu_severity,
           round(avg(is_pollution_peak), 4) AS peak_share
    FROM features GROUP BY "hour" """),
)
def _group_profile(spark, sf_dir):
    averages = {
        "avg_aqi": ("aqi", 4), "avg_nmu_severity": ("nmu_severity", 4), "peak_share": ("is_pollution_peak", 4),
    }
    return group_profile(features(spark, sf_dir), "hour", averages)


@query(
    "coerce_schema",
    with_roles(SQL_EVENTS, SQL_CONTEXT, select="SELECT * FROM context"),
)
def _coerce_schema(spark, sf_dir):
    """The context as text, booleans included, shaped again by the schema of its serving table."""
    typed = t.context(spark, sf_dir)
    as_text = typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns])
    return coerce.coerce_to(as_text, SERVING_SCHEMAS["weather_cleaned"], unknown_bool=False)


@query(
    "sorted_report",
    with_roles(*ALL_ROLES, SQL_DAILY, select='SELECT "date", site_id, rows_count, max_aqi FROM daily ORDER BY "date", max_aqi DESC, site_id'),
)
def _sorted_report(spark, sf_dir):
    daily = marts.daily_mart(t.hourly(spark, sf_dir)).select("date", "site_id", "rows_count", "max_aqi")
    return daily.orderBy("date", F.col("max_aqi").desc(), "site_id")
