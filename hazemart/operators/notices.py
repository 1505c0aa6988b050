"""Notice text to notice rows to notice hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemart import config
from hazemart.functions import coerce, text
from hazemart.operators.dedup import first_per_key, strongest_per_key
from hazemart.operators.intervals import expand_intervals, valid_intervals

NOTICE_COLUMNS = (
    "published", "regime", "regime_level", "period_start", "period_end", "announcement_text", "source",
)
NOTICE_HOUR_COLUMNS = (
    "timestamp", "date", "hour", "is_nmu", "regime", "regime_level", "announcement_text",
)


def notice_pieces(pages: DataFrame, text_column: str, order: list[str]) -> DataFrame:
    """One row per dated, relevant piece of every page; ``piece_no`` counts within the page."""
    pieces = pages.select(*order, F.posexplode(text.split_at_dates(F.col(text_column))).alias("piece_no", "piece"))
    return pieces.where(text.published_on(F.col("piece")) != "").where(text.mentions_notice(F.col("piece")))


def parse_notices(pages: DataFrame, text_column: str = "text", order: list[str] | None = None) -> DataFrame:
    """Valid notices of all pages, the last mention of a period winning.

    ``order`` names the columns that put the pages in sequence.
    """
    order = order or []
    # the piece is searched once; the ten parts are then read from the short period text
    periods = notice_pieces(pages, text_column, order).withColumn("_period", text.period_text(F.col("piece")))
    moments = periods.where(F.col("_period") != "").withColumns(
        {
            "published": text.published_on(F.col("piece")),
            "regime_level": text.regime_level(F.col("piece")),
            "period_start": text.moment(text.period_parts(F.col("_period"), 0)),
            "period_end": text.moment(text.period_parts(F.col("_period"), 1)),
        }
    )
    valid = valid_intervals(moments)
    latest = [F.col(c).desc() for c in [*order, "piece_no"]]
    kept = first_per_key(valid, ["period_start", "period_end"], latest)
    return kept.withColumns(
        {
            "regime": text.regime_label(F.col("regime_level")),
            "announcement_text": text.announcement(F.col("piece")),
            "source": F.lit("parsed"),
        }
    ).select(*NOTICE_COLUMNS)


def render_notice(published: Column, level: Column, start: Column, end: Column) -> Column:
    """Notice sentence for a period, in the wording that :func:`parse_notices` reads."""
    names = {number: name for name, number in config.MONTH_NUMBERS.items()}  # the genitive comes last
    month_names = F.array(*[F.lit(names[m]) for m in range(1, 13)])

    def spoken(when: Column) -> Column:
        return F.concat(
            F.date_format(when, "HH"), F.lit(" часов "), F.date_format(when, "dd "),
            F.element_at(month_names, F.month(when)), F.date_format(when, " yyyy"), F.lit(" года"),
        )

    return F.concat(
        F.date_format(published, "dd.MM.yyyy "), text.regime_label(level),
        F.lit(": НМУ ожидаются с "), spoken(start), F.lit(" до "), spoken(end), F.lit("."),
    )


def seed_notices(spark: SparkSession) -> DataFrame:
    """The notices that stand in when no page could be parsed."""
    periods = spark.createDataFrame(list(config.SEED_PERIODS), "period_start string, period_end string")
    start, end = (coerce.timestamp(F.col(c), config.READING_TIME_FORMAT) for c in periods.columns)
    level = F.lit(0)
    return periods.select(
        F.date_format(start, "dd.MM.yyyy").alias("published"),
        text.regime_label(level).alias("regime"),
        level.alias("regime_level"),
        start.alias("period_start"),
        end.alias("period_end"),
        render_notice(start, level, start, end).alias("announcement_text"),
        F.lit("fallback").alias("source"),
    )


def notice_hours(notices: DataFrame, align: bool = False, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """One row per hour under notice, the highest level winning; ties go to the earlier start."""
    hours = expand_intervals(notices, align=align)
    ties = ["period_start", "period_end", *tie_break, "announcement_text"]
    strongest = strongest_per_key(hours, ["timestamp"], "regime_level", ties)
    return strongest.withColumns(
        {
            "date": F.to_date("timestamp"),
            "hour": F.hour("timestamp"),
            "is_nmu": F.lit(True),
        }
    ).select(*NOTICE_HOUR_COLUMNS)
