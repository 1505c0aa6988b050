"""Page text, notice parsing and notice hours."""

import datetime as dt
import html as html_module
import re

import pytest
from pyspark.sql import functions as F

from hazemart.functions import text
from hazemart.operators.compare import notice_periods
from hazemart.operators.intervals import expand_intervals
from hazemart.operators.notices import notice_hours, parse_notices, seed_notices


def visible(raw):
    """Brute-force answer of one page."""
    out = re.sub(r"<(script|style)[^>]*>.*?</\1>", " ", raw, flags=re.I | re.S)
    out = html_module.unescape(re.sub(r"<[^>]+>", " ", out))
    return re.sub("[\\s​ ]+", " ", out).strip()


PAGES = [
    "<p>a&nbsp;&laquo;b&raquo; &mdash; c</p>",
    "<SCRIPT type='x'>var a = '<p>';</SCRIPT>x<style>\n.a{}\n</style>y",
    "&amp;lt; &lt;b&gt; &amp;amp; &ampx &AMP; &copy2 &notit; &notin; &unknown; &#; &# &;",
    "&#8212;&#x2014;&#X41;&#65&#128;&#159;&#129;&#0;&#xD800;&#1114112;&#99999999999999999999;&#x110000;&#xFFFFFFFFFF;&#11;&#1;&#10;",
    "&CounterClockwiseContourIntegral; &NotEqualTilde; &acE; &#x1F600; &eacute &Eacute;x",
    "нет  тегов​ \t\n здесь", "", "<b", "a < b > c", "&" * 5,
]


def test_page_text_equals_brute_force(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PAGES)], "i int, p string")
    found = {r.i: r.t for r in df.select("i", text.html_to_text(F.col("p")).alias("t")).collect()}
    for i, page in enumerate(PAGES):
        assert found[i] == visible(page), page


def test_given_pages_equal_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in pages.select("html", text.html_to_text(F.col("html")).alias("t")).collect():
        assert row.t == visible(row.html)


def at(*parts):
    return dt.datetime(*parts)


NOTICES = [
    ("16.01.2026 Первый режим НМУ с 15.30 16 января 2026 года до 24 часов 17 января 2026 года", (1, at(2026, 1, 16, 15, 30), at(2026, 1, 18))),
    ("18.01.2026 В период третьего режима с 7 часов 18 ЯНВАРЯ 2026 до 19:15 19 января 2026", (3, at(2026, 1, 18, 7), at(2026, 1, 19, 19, 15))),
    ("20.01.2026 НМУ с 1 часа 20 май 2026 до 2 часов 21 мая 2026", (0, at(2026, 5, 20, 1), at(2026, 5, 21, 2))),
    ("20.01.2026 Второго режима НМУ с 00 часов 02 марта 2026, продлён, до 9.00 11 марта 2026", (2, at(2026, 3, 2), at(2026, 3, 11, 9))),
    # without an hour, "10 марта" reads as hour 1 of a day 0
    ("20.01.2026 НМУ с 00 часов 02 марта 2026 до 10 марта 2026", None),
    ("20.01.2026 НМУ с 1 часа 20 брюмера 2026 до 2 часов 21 мая 2026", None),
    ("20.01.2026 НМУ с 1 часа 20 января 2026 до 2 часов 30 февраля 2026", None),
    ("20.01.2026 НМУ с 3 часов 20 января 2026 до 3 часов 20 января 2026", None),
    ("20.01.2026 НМУ с 5 часов 20 января 2026 до 3 часов 20 января 2026", None),
    ("20.01.2026 НМУ ожидаются", None),
    ("20.01.2026 Погода с 1 часа 20 января 2026 до 2 часов 21 января 2026", None),
    ("НМУ с 1 часа 20 января 2026 до 2 часов 21 января 2026", None),
    ("120.01.2026 НМУ с 1 часа 20 января 2026 до 2 часов 21 января 2026", None),
]


@pytest.mark.parametrize("sentence, expected", NOTICES)
def test_notice(spark, sentence, expected):
    found = parse_notices(spark.createDataFrame([(sentence,)], "text string")).collect()
    assert [(r.regime_level, r.period_start, r.period_end) for r in found] == ([expected] if expected else [])


def test_last_mention_of_a_period_wins(spark):
    period = "с 1 часа 20 января 2026 до 2 часов 21 января 2026"
    pages = spark.createDataFrame(
        [(1, f"19.01.2026 Первый режим НМУ {period}. 20.01.2026 Второй режим НМУ {period}."), (0, f"18.01.2026 Третий режим НМУ {period}")],
        "page int, text string",
    )
    (row,) = parse_notices(pages, "text", ["page"]).collect()
    assert (row.published, row.regime, row.source) == ("20.01.2026", "Второй режим", "parsed")
    assert row.announcement_text == f"20.01.2026 Второй режим НМУ {period}"


def test_text_is_cut_behind_its_period_and_published_short(spark):
    body = "01.01.2026 НМУ " + "слово  " * 100 + "с 1 часа 2 января 2026 до 3 часов 3 января 2026 и прочее"
    (row,) = parse_notices(spark.createDataFrame([(body,)], "text string")).collect()
    assert row.announcement_text.count("слово") == 100 and "  " not in row.announcement_text
    assert row.announcement_text.endswith("до 3 часов 3 января 2026")
    hours = notice_hours(parse_notices(spark.createDataFrame([(body,)], "text string")))
    assert {r.announcement_text for r in hours.collect()} == {row.announcement_text}
    published = hours.select(text.published_announcement(F.col("announcement_text")).alias("t")).first().t
    assert published == row.announcement_text[:400]
    assert row.period_end == at(2026, 1, 3, 3)


def test_seed_notices_expand_to_the_published_hours(spark):
    seeds = seed_notices(spark)
    hours = notice_hours(seeds)
    assert hours.count() == 105
    assert hours.where(F.month("timestamp") == 4).count() == 81
    readings = spark.range(5).select(F.col("id").cast("int").alias("site_id"), F.explode(F.expr(
        "sequence(timestamp'2026-04-01', timestamp'2026-04-30 23:00:00', interval 1 hour)")).alias("timestamp"))
    readings = readings.withColumns({c: F.lit(1.0) for c in ("aqi", "pm25", "pm10")}).withColumn("is_pollution_peak", F.lit(False))
    counts = {r.nmu_status: r.rows_count for r in notice_periods(readings, hours).collect()}
    assert counts == {"НМУ": 405, "Обычные часы": 3195}
    # the seed texts are what the parser would have read
    again = parse_notices(seeds.select(F.col("announcement_text").alias("text"), "period_start"), "text", ["period_start"])
    assert sorted((r.period_start, r.period_end) for r in again.collect()) == sorted((r.period_start, r.period_end) for r in seeds.collect())


def intervals(spark, *pairs):
    return spark.createDataFrame([tuple(p) for p in pairs], "period_start timestamp, period_end timestamp")


def test_interval_grid(spark):
    day = (2026, 1, 1)
    df = intervals(spark, (at(*day, 19, 30), at(*day, 22)), (at(*day, 1), at(*day, 1)), (at(*day, 2), at(*day, 1)), (at(*day, 1), None))
    assert [r[0].strftime("%H:%M") for r in expand_intervals(df).select("timestamp").orderBy("timestamp").collect()] == ["19:30", "20:30", "21:30"]
    assert [r[0].hour for r in expand_intervals(df, align=True).select("timestamp").orderBy("timestamp").collect()] == [19, 20, 21]


@pytest.mark.parametrize("piece", [1, 7, 24, 1000])
def test_long_intervals_are_whole_for_any_piece(spark, piece):
    df = intervals(spark, (at(2026, 1, 1, 0, 15), at(2026, 3, 1, 7)), (at(2026, 2, 1), at(2026, 2, 1, 0, 30)))
    found = expand_intervals(df, steps_per_piece=piece).select("timestamp")
    expected = 59 * 24 + 7 + 1
    assert found.count() == expected and found.distinct().count() == expected


def test_strongest_notice_of_an_hour(spark):
    start, end = at(2026, 1, 1), at(2026, 1, 1, 2)
    data = [
        (start, end, "a", 0, "late"), (start, end, "b", 2, "zz"), (at(2026, 1, 1, 1), end, "b", 2, "aa"), (start, end, "b", 2, "mm"),
    ]
    df = spark.createDataFrame(data, "period_start timestamp, period_end timestamp, regime string, regime_level int, announcement_text string")
    for parts in (1, 4):
        found = notice_hours(df.repartition(parts)).orderBy("timestamp").collect()
        assert [(r.hour, r.regime_level, r.announcement_text) for r in found] == [(0, 2, "mm"), (1, 2, "mm")]
