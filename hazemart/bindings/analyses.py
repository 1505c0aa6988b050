"""Integer jobs, quality control, anomalies and comparisons on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazemart import config
from hazemart.bindings import tables as t
from hazemart.bindings.registry import query
from hazemart.bindings.tables import SQL_CONTEXT, SQL_EVENTS, SQL_HOURLY, SQL_READINGS, with_roles
from hazemart.functions import coerce
from hazemart.operators import anomaly, compare, integers, ordered, quality
from hazemart.session import scratch_path
from hazemart.sources.tabular import read_integers

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def part_keys(spark, sf_dir):
    """``l_partkey`` as a text file of integers, read back by the integer scan."""
    path = scratch_path(spark, "integers")
    t.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("value")).write.text(path)
    return read_integers(spark, path)


@query("mr_max", "SELECT max(l_partkey) AS max_value FROM lineitem")
def _mr_max(spark, sf_dir):
    return integers.largest(part_keys(spark, sf_dir))


@query("mr_mean", "SELECT CAST(sum(l_partkey) AS DOUBLE) / count(l_partkey) AS mean_value FROM lineitem")
def _mr_mean(spark, sf_dir):
    return integers.mean(part_keys(spark, sf_dir))


@query("mr_distinct", "SELECT DISTINCT l_partkey AS value FROM lineitem")
def _mr_distinct(spark, sf_dir):
    return integers.distinct(part_keys(spark, sf_dir))


@query("mr_count_distinct", "SELECT count(DISTINCT l_partkey) AS distinct_count FROM lineitem")
def _mr_count_distinct(spark, sf_dir):
    return integers.distinct_count(part_keys(spark, sf_dir))


def measured(spark, sf_dir):
    return t.events(spark, sf_dir).select("event_id", "event_type", "user_id", "ts", "q")


@query(
    "quality_gaps",
    with_roles(SQL_EVENTS, select="""
    , hours AS (SELECT unnest(generate_series((SELECT min(hr) FROM ev), (SELECT max(hr) FROM ev), INTERVAL 1 HOUR)) AS hour_start)
    SELECT s.event_type, h.hour_start FROM (SELECT DISTINCT event_type FROM ev) s CROSS JOIN hours h
    WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.event_type = s.event_type AND ev.hr = h.hour_start)"""),
)
def _quality_gaps(spark, sf_dir):
    return quality.hourly_gaps(measured(spark, sf_dir), "event_type", "ts")


@query(
    "quality_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _quality_duplicates(spark, sf_dir):
    return quality.duplicate_keys(t.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "quality_suspicious",
    with_roles(SQL_EVENTS, select="""
    SELECT event_type, count(*) FILTER (WHERE k = 37) AS aqi_out_of_range,
           count(*) FILTER (WHERE q * 0.5 > 100) AS humidity_out_of_range,
           count(*) FILTER (WHERE q * 0.5 + 640 NOT BETWEEN 650 AND 820) AS pressure_out_of_range
    FROM ev GROUP BY event_type"""),
)
def _quality_suspicious(spark, sf_dir):
    names = ["aqi", "humidity", "pressure"]
    ev = t.events(spark, sf_dir).select(
        "event_type",
        F.when(F.col("k") == t.NEGATIVE_AQI, F.lit("-1")).otherwise(F.col("q").cast("string")).alias("aqi"),
        (F.col("q") * 0.5).cast("string").alias("humidity"),
        (F.col("q") * 0.5 + 640).cast("string").alias("pressure"),
    )
    typed = coerce.rename_coerce(ev, {n: n for n in names})
    return quality.suspicious_counts(typed, {n: config.READING_LIMITS[n] for n in names}, ["event_type"])


@query(
    "anomaly_iqr",
    with_roles(SQL_EVENTS, select="""
    , f AS (SELECT event_type, quantile_cont(q, 0.25) AS q1, quantile_cont(q, 0.75) AS q3 FROM ev GROUP BY event_type)
    SELECT event_id, event_type, q, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence,
           q < q1 - 1.5 * (q3 - q1) OR q > q3 + 1.5 * (q3 - q1) AS is_outlier
    FROM ev JOIN f USING (event_type)"""),
)
def _anomaly_iqr(spark, sf_dir):
    return anomaly.iqr_outliers(measured(spark, sf_dir), ["event_type"], "q").select(
        "event_id", "event_type", "q", "lower_fence", "upper_fence", "is_outlier"
    )


@query(
    "anomaly_hour_median",
    with_roles(SQL_EVENTS, select="""
    , m AS (SELECT event_type, hour(ts) AS h, median(q) AS median_value FROM ev GROUP BY 1, 2)
    SELECT event_id, ev.event_type, CAST(h AS INTEGER) AS hour_of_day, q, median_value, q - median_value AS deviation
    FROM ev JOIN m ON m.event_type = ev.event_type AND m.h = hour(ts)"""),
)
def _anomaly_hour_median(spark, sf_dir):
    rows = measured(spark, sf_dir).withColumn("hour_of_day", F.hour("ts"))
    return anomaly.median_deviation(rows, ["event_type", "hour_of_day"], "q").select(
        "event_id", "event_type", "hour_of_day", "q", "median_value", "deviation"
    )


@query(
    "exceedance_days",
    with_roles(SQL_EVENTS, select="""
    , d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (WHERE q > 100) AS n FROM ev GROUP BY 1, 2)
    SELECT user_id, CAST(sum(n) AS BIGINT) AS exceedance_count, count(*) FILTER (WHERE n > 0) AS exceedance_days,
           count(*) AS observed_days FROM d GROUP BY user_id"""),
)
def _exceedance_days(spark, sf_dir):
    by_day = anomaly.exceedance_by_day(measured(spark, sf_dir), "user_id", "ts", "q", 100)
    return anomaly.exceedance_sites(by_day, "user_id")


@query(
    "jump_flag",
    with_roles(SQL_EVENTS, select="""
    , p AS (SELECT *, lag(q) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous_value FROM ev)
    SELECT event_id, event_type, q, previous_value, q - previous_value AS change,
           coalesce(abs(q - previous_value) > 80, false) AS is_jump FROM p"""),
)
def _jump_flag(spark, sf_dir):
    flagged = anomaly.jumps(measured(spark, sf_dir), ["event_type"], "ts", "q", 80, ["event_id"], piece_unit="MINUTE")
    return flagged.select("event_id", "event_type", "q", "previous_value", "change", "is_jump")


@query(
    "rank_sites",
    with_roles(SQL_EVENTS, select="""
    , s AS (SELECT user_id, avg(q) AS avg_value, max(q) AS max_value FROM ev GROUP BY user_id)
    SELECT user_id, avg_value, max_value, CAST(rank() OVER (ORDER BY avg_value DESC) AS INTEGER) AS rank_by_mean,
           CAST(rank() OVER (ORDER BY max_value DESC) AS INTEGER) AS rank_by_max FROM s"""),
)
def _rank_sites(spark, sf_dir):
    by_site = measured(spark, sf_dir).groupBy("user_id").agg(F.avg("q").alias("avg_value"), F.max("q").alias("max_value"))
    return ordered.competition_ranks(by_site, {"rank_by_mean": "avg_value", "rank_by_max": "max_value"})


@query(
    "compare_weekend",
    with_roles(SQL_EVENTS, select="""
    SELECT CASE WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_kind, count(*) AS row_count,
           avg(q) AS avg_value, max(q) AS max_value FROM ev GROUP BY 1"""),
)
def _compare_weekend(spark, sf_dir):
    return compare.by_weekend(measured(spark, sf_dir), "ts", "q")


@query(
    "compare_season",
    """SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
                   WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
              count(*) AS row_count, avg(floor(o_totalprice)) AS avg_value, max(floor(o_totalprice)) AS max_value
       FROM orders GROUP BY 1""",
)
def _compare_season(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select("o_orderdate", F.floor("o_totalprice").cast("double").alias("price"))
    return compare.by_season(orders, "o_orderdate", "price")


@query(
    "weekly_dynamics",
    with_roles(SQL_EVENTS, select="""
    SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS week_start, count(*) AS row_count, avg(q) AS avg_value,
           max(q) AS max_value, count(*) FILTER (WHERE q > 100) AS peak_count FROM ev GROUP BY 1, 2"""),
)
def _weekly_dynamics(spark, sf_dir):
    return compare.by_week(measured(spark, sf_dir), ["event_type"], "ts", "q", 100)


@query(
    "weather_relation",
    with_roles(SQL_READINGS, SQL_CONTEXT, SQL_HOURLY, select="""
    SELECT count(*) AS row_count, round(corr(aqi, wind_speed), 6) AS corr_wind_speed,
           round(corr(aqi, weather_humidity), 6) AS corr_weather_humidity,
           round(corr(aqi, precipitation), 6) AS corr_precipitation FROM hourly"""),
)
def _weather_relation(spark, sf_dir):
    factors = ["wind_speed", "weather_humidity", "precipitation"]
    related = compare.weather_correlation(t.hourly(spark, sf_dir), "aqi", factors)
    return related.select("row_count", *[F.round(f"corr_{f}", 6).alias(f"corr_{f}") for f in factors])


@query(
    "weather_buckets",
    with_roles(SQL_READINGS, SQL_CONTEXT, SQL_HOURLY, select="""
    SELECT wind_speed_group, count(*) AS row_count, avg(aqi) AS avg_value FROM hourly GROUP BY wind_speed_group"""),
)
def _weather_buckets(spark, sf_dir):
    return compare.mean_by_bucket(t.hourly(spark, sf_dir), "wind_speed_group", "aqi")


@query(
    "latest_vs_mean",
    with_roles(SQL_EVENTS, select="""
    , l AS (SELECT user_id, ts, q FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    , m AS (SELECT user_id, avg(q) AS mean_value FROM ev GROUP BY user_id)
    SELECT user_id, ts AS latest_time, q AS latest_value, mean_value, q - mean_value AS difference FROM l JOIN m USING (user_id)"""),
)
def _latest_vs_mean(spark, sf_dir):
    return compare.latest_and_mean(measured(spark, sf_dir), "user_id", ["ts", "event_id"], "q")


@query(
    "quota_share",
    with_roles(SQL_EVENTS, select="""
    , d AS (SELECT user_id, CAST(ts AS DATE) AS day, max(q) AS top FROM ev GROUP BY 1, 2)
    SELECT user_id, count(*) AS observed_days, avg(CASE WHEN top <= 100 THEN 1.0 ELSE 0.0 END) AS share_within_quota
    FROM d GROUP BY user_id"""),
)
def _quota_share(spark, sf_dir):
    return compare.quota_share(measured(spark, sf_dir), "user_id", "ts", "q", 100)


@query(
    "pivot_sites",
    with_roles(
        SQL_EVENTS,
        select='SELECT CAST(ts AS DATE) AS "date", '
        + ", ".join(f"avg(q) FILTER (WHERE event_type = '{e}') AS {e}" for e in EVENT_TYPES)
        + " FROM ev GROUP BY 1",
    ),
)
def _pivot_sites(spark, sf_dir):
    return compare.sites_as_columns(measured(spark, sf_dir), "event_type", EVENT_TYPES, "ts", "q")


@query(
    "quantiles_by_flag",
    """
    SELECT l_returnflag, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.25), 6) AS q25,
           round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.5), 6) AS q50,
           round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.99), 6) AS q99
    FROM lineitem GROUP BY l_returnflag""",
)
def _quantiles_by_flag(spark, sf_dir):
    """Groups with very many distinct values, cut into slices."""
    prices = t.table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("price"))
    found = ordered.exact_quantiles(prices, ["l_returnflag"], "price", {"q25": 0.25, "q50": 0.5, "q99": 0.99})
    return found.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q99")})


@query(
    "rank_orders",
    """
    SELECT o_orderkey, CAST(rank() OVER (ORDER BY CAST(o_totalprice AS DOUBLE) DESC) AS INTEGER) AS price_rank FROM orders""",
)
def _rank_orders(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    return ordered.competition_ranks(orders, {"price_rank": "price"}).select("o_orderkey", "price_rank")
