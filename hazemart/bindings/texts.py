"""Page text and notices on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazemart.bindings import tables as t
from hazemart.bindings.registry import query
from hazemart.bindings.tables import SQL_EVENTS, with_roles
from hazemart.functions import text
from hazemart.ml.preprocess import tfidf
from hazemart.operators import notices


@query(
    "html_to_text",
    r"""
    WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g') AS x FROM pages)
    , b AS (SELECT page_id, regexp_replace(x, '(?is)<style[^>]*>.*?</style>', ' ', 'g') AS x FROM a)
    , c AS (SELECT page_id, regexp_replace(x, '<[^>]+>', ' ', 'g') AS x FROM b)
    , d AS (SELECT page_id, replace(replace(replace(replace(replace(replace(x, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'),
                   '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' ') AS x FROM c)
    , e AS (SELECT page_id, regexp_replace(x, '&amp;?', '&', 'g') AS x FROM d)
    SELECT page_id, trim(regexp_replace(x, '[\s\x{00A0}\x{200B}\x0B]+', ' ', 'g')) AS text FROM e""",
)
def _html_to_text(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query(
    "text_split_on_marker",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, 0 AS piece_no, 'шум 1.2.2024' AS piece FROM ev
    UNION ALL SELECT event_id, 1, strftime(ts, '%d.%m.%Y') || ' ' || event_type FROM ev
    UNION ALL SELECT event_id, 2, strftime(ts + INTERVAL 1 DAY, '%d.%m.%Y') || ': 112.01.2024 ' || k FROM ev"""),
)
def _text_split_on_marker(spark, sf_dir):
    """Dates with too many or too few digits do not open a piece."""
    written = F.concat(
        F.lit("шум 1.2.2024 "), F.date_format("ts", "dd.MM.yyyy "), F.col("event_type"), F.lit("\n"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), "dd.MM.yyyy"), F.lit(": 112.01.2024 "), F.col("k").cast("string"),
    )
    return t.events(spark, sf_dir).select("event_id", F.posexplode(text.split_at_dates(written)).alias("piece_no", "piece"))


@query(
    "text_relevance",
    with_roles(SQL_EVENTS, select="SELECT event_id, k % 4 IN (0, 1) AS is_relevant FROM ev"),
)
def _text_relevance(spark, sf_dir):
    words = F.array(F.lit("Ожидаются НМУ"), F.lit("Первый РЕЖИМ"), F.lit("нму без слова"), F.col("event_type"))
    rows = t.events(spark, sf_dir).select("event_id", F.element_at(words, F.pmod("k", F.lit(4)) + 1).alias("w"))
    return rows.select("event_id", text.mentions_notice(F.col("w")).alias("is_relevant"))


@query(
    "classify_by_stem",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 0 END AS regime_level,
           CASE k % 5 WHEN 0 THEN 'Первый режим' WHEN 1 THEN 'Второй режим' WHEN 2 THEN 'Третий режим'
                      ELSE 'Общий прогноз' END AS regime FROM ev"""),
)
def _classify_by_stem(spark, sf_dir):
    words = F.array(
        F.lit("объявлен Первый режим"), F.lit("ВТОРОГО  РЕЖИМА"), F.lit("в период третьего режима"), F.lit("первый снег"), F.lit("режим")
    )
    rows = t.events(spark, sf_dir).select("event_id", F.element_at(words, F.pmod("k", F.lit(5)) + 1).alias("w"))
    leveled = rows.select("event_id", text.regime_level(F.col("w")).alias("regime_level"))
    return leveled.withColumn("regime", text.regime_label(F.col("regime_level")))


# a period of no hour is no notice, but its sentence can be read
SQL_ALARMS = "event_type = 'error' AND value >= 20"
SQL_SPOKEN = """
, alarms AS (
  SELECT event_id, k, hr AS s, hr + to_hours(CAST(floor(value / 20) AS BIGINT)) AS e, CAST(k % 4 AS INTEGER) AS level
  FROM ev WHERE <which>)
, said AS (
  SELECT event_id, k, 1 AS no, s, e, level FROM alarms
  UNION ALL SELECT event_id, k, 2, s + INTERVAL 1 DAY, e + INTERVAL 1 DAY, (level + 1) % 4 FROM alarms)
, spoken AS (
  SELECT *, strftime(s, '%d.%m.%Y') AS published,
         ['Общий прогноз', 'Первый режим', 'Второй режим', 'Третий режим'][level + 1] AS regime,
         ['января', 'февраля', 'марта', 'апреля', 'мая', 'июня', 'июля', 'августа', 'сентября', 'октября', 'ноября',
          'декабря'][month(s)] AS sm,
         ['января', 'февраля', 'марта', 'апреля', 'мая', 'июня', 'июля', 'августа', 'сентября', 'октября', 'ноября',
          'декабря'][month(e)] AS em
  FROM said)
, sentences AS (
  SELECT *, published || ' ' || regime || ': НМУ ожидаются с ' || strftime(s, '%H') || ' часов ' || strftime(s, '%d') || ' '
         || sm || ' ' || year(s) || ' года до ' || strftime(e, '%H') || ' часов ' || strftime(e, '%d') || ' ' || em || ' '
         || year(e) AS sentence
  FROM spoken)
"""


def notice_pages(spark, sf_dir):
    """One HTML page per error event with two notices, good if it lasts an hour, and three that must be skipped."""
    alarms = t.events(spark, sf_dir).where("event_type = 'error'")
    day = F.expr("INTERVAL 1 DAY")
    start = F.col("hr")
    end = start + F.make_dt_interval(hours=F.floor(F.col("value") / 20).cast("int"))
    level = F.pmod("k", F.lit(4)).cast("int")
    first = notices.render_notice(start, level, start, end)
    second = notices.render_notice(start + day, F.pmod(level + 1, F.lit(4)), start + day, end + day)
    reversed_period = notices.render_notice(end, level, end, start)
    html = F.concat(
        F.lit("<html><script>var d = '01.01.2024 НМУ с 1 часа';</script><body><h1>Прогноз&nbsp;НМУ</h1><p>"), first,
        F.lit("</p>\n<p>"), second, F.lit("</p><p>"), reversed_period,
        F.lit("</p><p>05.02.2024 НМУ с 10 часов 30 февраля 2024 года до 12 часов 31 февраля 2024 года.</p>"),
        F.lit("<p>06.02.2024 Погода &laquo;без осадков&raquo; с 1 часа 1 марта 2024 до 2 часов 1 марта 2024</p></body></html>"),
    )
    return alarms.select("event_id", html.alias("html"))


@query(
    "notice_parse",
    with_roles(SQL_EVENTS, SQL_SPOKEN.replace("<which>", SQL_ALARMS), select="""
    SELECT published, regime, level AS regime_level, s AS period_start, e AS period_end, sentence AS announcement_text,
           'parsed' AS source
    FROM sentences QUALIFY row_number() OVER (PARTITION BY s, e ORDER BY event_id DESC, no DESC) = 1"""),
)
def _notice_parse(spark, sf_dir):
    pages = notice_pages(spark, sf_dir).select("event_id", text.html_to_text(F.col("html")).alias("text"))
    return notices.parse_notices(pages, "text", order=["event_id"])


@query(
    "text_normalize",
    with_roles(SQL_EVENTS, SQL_SPOKEN.replace("<which>", "true"), select="""
    SELECT event_id, substr(repeat('Внимание! ', k) || sentence, 1, 400) AS announcement_text FROM sentences WHERE no = 1"""),
)
def _text_normalize(spark, sf_dir):
    """Whole text read, cut behind its period, blanks collapsed, 400 characters published."""
    alarms = t.events(spark, sf_dir)
    end = F.col("hr") + F.make_dt_interval(hours=F.floor(F.col("value") / 20).cast("int"))
    said = notices.render_notice(F.col("hr"), F.pmod("k", F.lit(4)).cast("int"), F.col("hr"), end)
    loud = F.concat(F.repeat(F.lit("Внимание! "), F.col("k")), F.replace(said, F.lit(" "), F.lit(" \t ")), F.lit(" и далее"))
    return alarms.select("event_id", text.published_announcement(text.announcement(loud)).alias("announcement_text"))


@query(
    "tfidf_exact",
    r"""
    WITH tok AS (SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s')) AS term FROM documents)
    , tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY 1, 2)
    , df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)
    SELECT doc_id, term, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tfidf
    FROM tf JOIN df USING (term)""",
)
def _tfidf_exact(spark, sf_dir):
    weights = tfidf(t.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return weights.withColumn("tfidf", F.round("tfidf", 6))
