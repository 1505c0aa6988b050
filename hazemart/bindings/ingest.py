"""Sources, payloads, ingest bookkeeping and sinks on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazemart.bindings import tables as t
from hazemart.bindings.registry import query
from hazemart.bindings.tables import SQL_CONTEXT, SQL_EVENTS, SQL_HOURLY, SQL_READINGS, with_roles
from hazemart.bindings.marts import SQL_DAILY
from hazemart.functions import coerce
from hazemart.operators.cleaning import READING_COLUMNS
from hazemart.plans import marts
from hazemart.plans.serving import SERVING_SCHEMAS
from hazemart.session import scratch_path
from hazemart.sources import ingest, payload, sinks, tabular

TIME = "yyyy-MM-dd HH:mm:ss"


@query(
    "src_csv_roundtrip",
    with_roles(SQL_EVENTS, select="""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN k = 33 THEN 'x7' ELSE user_id || '.0' END AS site_id,
           CASE WHEN k = 13 THEN 'yesterday' ELSE strftime(hr, '%Y-%m-%d %H:%M:%S') END AS time,
           CASE k WHEN 17 THEN 'n/a' WHEN 37 THEN '-1' ELSE replace(CAST(q AS VARCHAR), '.', ',') END AS aqi,
           CASE WHEN k <> 29 THEN CAST(q * 0.5 AS VARCHAR) END AS pm10, props AS _raw
    FROM ev"""),
)
def _src_csv_roundtrip(spark, sf_dir):
    """Raw readings as CSV, quotes in ``_raw`` and commas in numbers, read back as text."""
    columns = ["event_id", "site_id", "time", "aqi", "pm10", "_raw"]
    raw = t.as_raw_readings(t.events(spark, sf_dir), "props").withColumnRenamed("props", "_raw").select(*columns)
    path = scratch_path(spark, "raw-csv")
    sinks.export_csv(raw, path)
    return tabular.read_text_table(spark, path, columns)


@query(
    "src_csv_multiline",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, length(text) AS n, md5(text) AS digest FROM documents",
)
def _src_csv_multiline(spark, sf_dir):
    path = scratch_path(spark, "notes-csv")
    columns = ["doc_id", "lang", "text"]
    sinks.export_csv(t.table(spark, sf_dir, "documents").select(*columns), path)
    back = tabular.read_text_table(spark, path, columns, multi_line=True)
    return back.select("doc_id", "lang", F.length("text").cast("long").alias("n"), F.md5("text").alias("digest"))


def json_payloads(spark, sf_dir):
    """One payload per event with two records, held in one of six places; some are malformed."""
    k, q = F.col("k"), F.col("q")
    first = F.struct(
        F.col("user_id").alias("site"), F.lit(None).cast("long").alias("site_id"), F.date_format("hr", TIME).alias("time"),
        F.lit(None).cast("string").alias("datetime"), q.alias("aqi"), (q * 0.25 - 50).alias("t"),
        F.lit(None).cast("double").alias("temperature"),
    )
    second = F.struct(
        F.lit(None).cast("long").alias("site"), (F.col("user_id") + 1).alias("site_id"), F.lit(None).cast("string").alias("time"),
        F.date_format("hr", TIME).alias("datetime"), (q * 2).alias("aqi"), F.lit(None).cast("double").alias("t"),
        (q * 0.5 - 50).alias("temperature"),
    )
    records = F.to_json(F.array(first, second))
    place = F.pmod(k, F.lit(6))
    wrapped = F.when(place == 0, F.concat(F.lit('{"data":'), records, F.lit("}")))
    for number, name in enumerate((*payload.RECORD_KEYS, "other"), start=1):
        wrapped = wrapped.when(place == number, F.concat(F.lit('{"data":{"' + name + '":'), records, F.lit("}}")))
    return t.events(spark, sf_dir).select("event_id", F.when(k == 99, "{oops").otherwise(wrapped).alias("payload"))


@query(
    "src_json_records",
    with_roles(SQL_EVENTS, select="""
    , good AS (SELECT * FROM ev WHERE k % 6 <> 5 AND k <> 99)
    SELECT event_id, 0 AS record_no, CAST(user_id AS INTEGER) AS site_id, hr AS time, q AS aqi, q * 0.25 - 50 AS temperature FROM good
    UNION ALL
    SELECT event_id, 1, CAST(user_id + 1 AS INTEGER), hr, q * 2, q * 0.5 - 50 FROM good"""),
)
def _src_json_records(spark, sf_dir):
    found = payload.records(json_payloads(spark, sf_dir), "payload", keep=["event_id"])
    rows = payload.resolve_aliases(found, "_raw", payload.READING_ALIASES, keep=["event_id", "record_no"])
    return rows.select(
        "event_id", "record_no", coerce.integer(F.col("site_id")).alias("site_id"),
        coerce.timestamp(F.col("time"), TIME).alias("time"), coerce.number(F.col("aqi")).alias("aqi"),
        coerce.number(F.col("temperature")).alias("temperature"),
    )


@query(
    "src_arrays_zip",
    with_roles(SQL_EVENTS, select="""
    , n AS (SELECT * FROM (VALUES (0), (1), (2)) v(row_no))
    SELECT event_id, row_no, hr + to_hours(row_no) AS time, CASE WHEN row_no < 2 THEN q + row_no END AS temperature_2m,
           CASE WHEN row_no < 1 THEN q END AS rain, CAST(NULL AS DOUBLE) AS snowfall
    FROM ev, n"""),
)
def _src_arrays_zip(spark, sf_dir):
    """Three times, two temperatures, one rain value and no snowfall array in every payload."""
    def hours_later(n):
        return F.date_format(F.col("hr") + F.make_dt_interval(hours=F.lit(n)), TIME)

    hourly = F.struct(
        F.array(*[hours_later(n) for n in range(3)]).alias("time"),
        F.array(F.col("q"), F.col("q") + 1).alias("temperature_2m"),
        F.array(F.col("q")).alias("rain"),
    )
    payloads = t.events(spark, sf_dir).select("event_id", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))
    variables = ["temperature_2m", "rain", "snowfall"]
    rows = payload.parallel_arrays(payloads, "payload", variables, keep=["event_id"])
    return rows.select(
        "event_id", "row_no", coerce.timestamp(F.col("time"), TIME).alias("time"),
        *[coerce.number(F.col(v)).alias(v) for v in variables],
    )


@query(
    "src_nested_dim",
    """SELECT CAST(s_suppkey AS INTEGER) AS site_id, s_name AS site_name, n_nationkey AS project_id, n_name AS project_name,
              'N' || n_nationkey AS project_short_name, floor(s_acctbal) / 8 AS latitude, CAST(NULL AS DOUBLE) AS longitude
       FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey IN (SELECT user_id FROM events)
       ORDER BY site_id""",
)
def _src_nested_dim(spark, sf_dir):
    """Nations are the projects and suppliers their sites, names and places under varying aliases."""
    listed = F.to_json(F.array(F.struct(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("short_name"),
    )))
    projects = t.table(spark, sf_dir, "nation").select(F.concat(F.lit('{"data":'), listed, F.lit("}")).alias("payload"))
    even = F.pmod("s_suppkey", F.lit(2)) == 0
    latitude = F.floor("s_acctbal") / 8
    site = F.struct(
        F.col("s_suppkey").alias("id"), F.when(even, F.col("s_name")).alias("name"), F.when(~even, F.col("s_name")).alias("title"),
        F.when(even, latitude).alias("geom_y"), F.when(~even, latitude).alias("lat"),
    )
    site_payloads = t.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("project_id"),
        F.concat(F.lit('{"data":{"sites":'), F.to_json(F.array(site)), F.lit("}}")).alias("payload"),
    )
    ids = t.table(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("site_id"))
    return payload.site_dimension(projects, site_payloads, ids).drop("raw_json").orderBy("site_id")


@query(
    "src_alias_coalesce",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CAST(user_id AS VARCHAR) AS site_id, strftime(hr, '%Y-%m-%d %H:%M:%S') AS time,
           CASE WHEN k % 3 = 0 THEN '0.0' ELSE CAST(q AS VARCHAR) END AS temperature FROM ev"""),
)
def _src_alias_coalesce(spark, sf_dir):
    """A temperature of 0 under the first alias is kept although the second also has a value."""
    kind, q = F.pmod("k", F.lit(3)), F.col("q")
    time = F.date_format("hr", TIME)
    record = F.to_json(F.struct(
        F.when(kind == 0, F.col("user_id")).alias("site"), F.when(kind != 0, F.col("user_id")).alias("site_id"),
        F.when(kind == 0, time).alias("time"), F.when(kind == 1, time).alias("date"), F.when(kind == 2, time).alias("datetime"),
        F.when(kind == 0, F.lit(0.0)).when(kind == 1, q).alias("t"), F.when(kind != 1, q).alias("temperature"),
    ))
    rows = t.events(spark, sf_dir).select("event_id", record.alias("_raw"))
    aliases = {n: payload.READING_ALIASES[n] for n in ("site_id", "time", "temperature")}
    return payload.resolve_aliases(rows, "_raw", aliases, keep=["event_id"])


@query(
    "src_keep_raw",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","pm10":'
           || CASE WHEN k = 29 THEN 'null' ELSE CAST(q AS VARCHAR) END || '}' AS _raw FROM ev"""),
)
def _src_keep_raw(spark, sf_dir):
    rows = t.events(spark, sf_dir).select("event_id", "event_type", F.when(F.col("k") != t.NO_PM10, F.col("q")).alias("pm10"))
    return payload.keep_raw(rows).select("event_id", "_raw")


def deliveries(spark, sf_dir):
    """Pages of a source: every event in the chunk of its day, views once more in the next chunk."""
    start = F.to_timestamp(F.lit("2024-01-01"))
    first = t.events(spark, sf_dir).select(
        "event_id", "user_id", "hr", "event_type", ingest.chunk_number(F.col("ts"), start, 1).alias("chunk_no"), F.lit(0).alias("page_no")
    )
    again = first.where("event_type = 'view'").withColumns({"chunk_no": F.col("chunk_no") + 1, "page_no": F.lit(1)})
    return ingest.union_pages([first, again])


SQL_DELIVERIES = SQL_EVENTS + """
, deliveries AS (
  SELECT event_id, user_id, hr, event_type, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS chunk_no,
         0 AS page_no FROM ev
  UNION ALL
  SELECT event_id, user_id, hr, event_type, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) + 1, 1
  FROM ev WHERE event_type = 'view')
"""


@query("union_chunks", with_roles(SQL_DELIVERIES, select="SELECT * FROM deliveries"))
def _union_chunks(spark, sf_dir):
    return deliveries(spark, sf_dir)


@query(
    "dedup_keep_first",
    with_roles(SQL_DELIVERIES, select="""
    SELECT * FROM deliveries QUALIFY row_number() OVER (PARTITION BY user_id, hr ORDER BY chunk_no, page_no, event_id) = 1"""),
)
def _dedup_keep_first(spark, sf_dir):
    return ingest.keep_first(deliveries(spark, sf_dir), ["user_id", "hr"], ["chunk_no", "page_no", "event_id"])


@query(
    "ingest_audit",
    with_roles(SQL_DELIVERIES, select="""
    , firsts AS (SELECT user_id, hr, min(chunk_no) AS chunk_no FROM deliveries GROUP BY 1, 2)
    SELECT chunk_no, count(*) AS rows_count,
           (SELECT count(*) FROM firsts f WHERE f.chunk_no = d.chunk_no) AS added_rows_count
    FROM deliveries d GROUP BY chunk_no"""),
)
def _ingest_audit(spark, sf_dir):
    return ingest.ingest_audit(deliveries(spark, sf_dir), ["user_id", "hr"], "chunk_no")


def order_ranges(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("timestamp").alias("range_start"), (F.max("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("range_end")
    )


SQL_RANGES = """
ranges AS (
  SELECT o_custkey, min(o_orderdate) AS range_start, max(o_orderdate) + INTERVAL 1 DAY AS range_end FROM orders
  GROUP BY o_custkey)
"""


@query(
    "range_chunks",
    with_roles(SQL_RANGES, select="""
    , c AS (SELECT *, unnest(generate_series(range_start, range_end, INTERVAL 90 DAY)) AS chunk_start FROM ranges)
    SELECT o_custkey, chunk_start, least(chunk_start + INTERVAL 90 DAY, range_end) AS chunk_end FROM c
    WHERE chunk_start < range_end"""),
)
def _range_chunks(spark, sf_dir):
    return ingest.time_chunks(order_ranges(spark, sf_dir), "range_start", "range_end", 90).select(
        "o_custkey", "chunk_start", "chunk_end"
    )


@query(
    "range_date_chunks",
    with_roles(SQL_RANGES, select="""
    , c AS (SELECT *, unnest(generate_series(date_trunc('day', range_start), date_trunc('day', range_end - INTERVAL 1 SECOND),
                                             INTERVAL 90 DAY)) AS chunk_start FROM ranges)
    SELECT o_custkey, CAST(chunk_start AS DATE) AS chunk_start,
           CAST(least(chunk_start + INTERVAL 89 DAY, date_trunc('day', range_end - INTERVAL 1 SECOND)) AS DATE) AS chunk_end
    FROM c"""),
)
def _range_date_chunks(spark, sf_dir):
    return ingest.date_chunks(order_ranges(spark, sf_dir), "range_start", "range_end", 90).select(
        "o_custkey", "chunk_start", "chunk_end"
    )


@query(
    "source_fallback",
    """SELECT 'empty' AS primary_state, event_id, value, 'fallback' AS source FROM events WHERE event_type = 'error'
       UNION ALL SELECT 'filled', event_id, value, 'parsed' FROM events WHERE event_type = 'view'""",
)
def _source_fallback(spark, sf_dir):
    ev = t.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    spare = ev.where("event_type = 'error'").drop("event_type")
    empty = ev.where("event_type = 'unheard of'").drop("event_type")
    filled = ev.where("event_type = 'view'").drop("event_type")
    return (
        ingest.with_fallback(empty, spare).withColumn("primary_state", F.lit("empty"))
        .unionByName(ingest.with_fallback(filled, spare).withColumn("primary_state", F.lit("filled")))
    )


@query("snk_roundtrip_csv", with_roles(SQL_READINGS, SQL_CONTEXT, SQL_HOURLY, SQL_DAILY, select="SELECT * FROM daily"))
def _snk_roundtrip_csv(spark, sf_dir):
    """Daily mart exported as CSV and loaded again through the schema of its serving table."""
    path = scratch_path(spark, "daily-csv")
    sinks.export_csv(marts.daily_mart(t.hourly(spark, sf_dir)), path)
    schema = SERVING_SCHEMAS["mart_air_weather_daily"]
    return coerce.coerce_to(tabular.read_text_table(spark, path, schema.names), schema)


@query("snk_parquet_staging", with_roles(SQL_READINGS, select="SELECT * FROM readings"))
def _snk_parquet_staging(spark, sf_dir):
    path = scratch_path(spark, "staging")
    sinks.write_staging(t.readings(spark, sf_dir), path)
    return spark.read.parquet(path).select(*READING_COLUMNS)


@query(
    "snk_json",
    with_roles(SQL_DELIVERIES, select="""
    , firsts AS (SELECT * FROM deliveries QUALIFY row_number() OVER (PARTITION BY user_id, hr ORDER BY chunk_no, page_no, event_id) = 1)
    SELECT (SELECT count(*) FROM firsts) AS rows_count, (SELECT count(DISTINCT chunk_no) FROM deliveries) AS requests_count,
           CAST((SELECT sum(event_id) FROM firsts) AS BIGINT) AS id_sum"""),
)
def _snk_json(spark, sf_dir):
    """Rows and request log written as JSON, both read back."""
    rows, key = deliveries(spark, sf_dir), ["user_id", "hr"]
    kept = ingest.keep_first(rows, key, ["chunk_no", "page_no", "event_id"])
    path = scratch_path(spark, "snapshot")
    sinks.write_json_snapshot(kept, ingest.ingest_audit(rows, key, "chunk_no"), path)
    requests = spark.read.schema("chunk_no int").json(f"{path}/requests").agg(F.count("chunk_no").alias("n"))
    return spark.read.schema("event_id long").json(f"{path}/rows").agg(
        F.count("event_id").alias("rows_count"), F.sum("event_id").alias("id_sum")
    ).withColumn("requests_count", requests.scalar())


@query(
    "sink_json_kv",
    with_roles(SQL_EVENTS, select="""
    SELECT CAST(user_id AS VARCHAR) AS "key", '{"site_id":' || user_id || ',"event_type":"' || event_type || '"'
           || CASE WHEN k = 29 THEN '' ELSE ',"pm10":' || CAST(q AS VARCHAR) END || '}' AS "value" FROM ev"""),
)
def _sink_json_kv(spark, sf_dir):
    rows = t.events(spark, sf_dir).select(
        F.col("user_id").alias("site_id"), "event_type", F.when(F.col("k") != t.NO_PM10, F.col("q")).alias("pm10")
    )
    return sinks.key_value(rows, "site_id")
