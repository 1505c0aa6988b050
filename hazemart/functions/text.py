"""Column expressions over page text and notice text. No Python runs per row."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazemart import config

# \s of Python text patterns, plus no-break and zero-width blanks; (?U) makes Java agree
BLANKS = r"(?U)[\s\x1c-\x1f\u200b\u00a0]+"
PYTHON_BLANKS = r"(?U)[\s\x1c-\x1f]+"

ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)"
# names that also count without the semicolon, longest first so that the longest one wins
_OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
_OPEN_NAME = "^&(" + "|".join(_OPEN_NAMES) + ")"
_FREQUENT = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;", "middot;", "copy;", "laquo;", "raquo;",
             "mdash;", "ndash;", "hellip;")
# numeric references 128..159 are read as Windows-1252
_C1 = {str(code): bytes([code]).decode("cp1252", errors="ignore") or chr(code) for code in range(128, 160)}


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _numeric_reference(token: Column) -> Column:
    digits = F.regexp_extract(token, r"^&#([0-9]+)", 1)
    hexed = F.regexp_extract(token, r"^&#[xX]([0-9a-fA-F]+)", 1)
    code = F.when(digits != "", digits.try_cast("long")).otherwise(
        F.conv(F.when(F.length(F.ltrim(hexed, F.lit("0"))) <= 8, hexed).otherwise("FFFFFFFF"), 16, 10).try_cast("long")
    )
    code = F.coalesce(code, F.lit(0x110000))
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    # control characters and non-characters vanish
    dropped = (
        code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127)
        | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    return (
        F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), "�")
        .when(code.between(128, 159), F.try_element_at(_literal_map(_C1), code.cast("string")))
        .when(dropped, "")
        .otherwise(character)
    )


def _decode_entity(token: Column) -> Column:
    frequent = _literal_map({f"&{name}": html5[name] for name in _FREQUENT})
    every = _literal_map({f"&{name}": value for name, value in html5.items()})
    open_name = F.concat(F.lit("&"), F.regexp_extract(token, _OPEN_NAME, 1))
    by_prefix = F.when(
        open_name != "&",
        F.concat(F.try_element_at(every, open_name), F.substr(token, F.length(open_name) + 1)),
    )
    return F.when(token.startswith("&#"), _numeric_reference(token)).otherwise(
        F.coalesce(F.try_element_at(frequent, token), F.try_element_at(every, token), by_prefix, token)
    )


def unescape(text: Column) -> Column:
    """Replace every character reference once, so ``&amp;lt;`` becomes ``&lt;``."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), 0), _decode_entity)
    parts = F.arrays_zip(F.split(text, ENTITY, -1).alias("plain"), tokens.alias("decoded"))
    joined = F.array_join(
        F.transform(parts, lambda p: F.concat(p["plain"], F.coalesce(p["decoded"], F.lit("")))), ""
    )
    return F.when(text.contains("&"), joined).otherwise(text)


# fixed patterns of page text
HIDDEN_PARTS = r"(?is)<(script|style)[^>]*>.*?</\1>"
TAGS = r"<[^>]+>"
# end of fixed patterns


def html_to_text(html: Column) -> Column:
    """Visible text: no scripts, styles or tags, references decoded, blanks collapsed."""
    bare = F.regexp_replace(html, HIDDEN_PARTS, " ")
    bare = F.regexp_replace(bare, TAGS, " ")
    return F.trim(F.regexp_replace(unescape(bare), BLANKS, " "))


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, PYTHON_BLANKS, " ")


# --- notices ----------------------------------------------------------------------------------

# fixed patterns of the notice language
DATE_START = r"(?U)(?=(?<!\d)\d{2}\.\d{2}\.\d{4}\b)"
PUBLISHED = r"(?U)^(\d{2}\.\d{2}\.\d{4})\b"
MOMENT = r"(\d{1,2})(?:[.:](\d{2}))?\s*(?:час\w*\s+)?(\d{1,2})\s+([а-яё]+)\s+(\d{4})"
PERIOD = r"(?iuUd)с\s+" + MOMENT + r".*?\bдо\s+" + MOMENT
THROUGH_PERIOD = r"(?iuUd)^(?s:.*?)" + PERIOD.removeprefix("(?iuUd)")
REGIME = r"(?iuU)(перв|втор|трет)\w*\s+режим"
# end of fixed patterns

NOTICE_TEXT_LENGTH = 400


def split_at_dates(text: Column) -> Column:
    """Array of pieces, each but the first starting with a dd.MM.yyyy date."""
    return F.transform(F.split(text, DATE_START, -1), lambda piece: F.regexp_replace(piece, r"(?U)^\s+|\s+$", ""))


def mentions_notice(text: Column) -> Column:
    return text.contains("НМУ") | F.lower(text).contains("режим")


def published_on(piece: Column) -> Column:
    """The leading date as written, '' when the piece does not start with one."""
    return F.regexp_extract(piece, PUBLISHED, 1)


def period_text(piece: Column) -> Column:
    """The period as written, '' when there is none."""
    return F.regexp_extract(piece, PERIOD, 0)


def period_parts(period: Column, which: int) -> list[Column]:
    """hour, minute, day, month name and year of the first (0) or second (1) moment of a period text."""
    return [F.regexp_extract(period, PERIOD, 5 * which + i) for i in range(1, 6)]


def moment(parts: list[Column]) -> Column:
    """Timestamp of the five text parts. Hour 24 or more is midnight of the next day.

    Unknown months and days that do not exist give null.
    """
    hour, minute, day, month_name, year = parts
    months = _literal_map({name: str(number) for name, number in config.MONTH_NUMBERS.items()})
    month = F.try_element_at(months, F.lower(month_name)).try_cast("int")
    day_start = F.try_make_timestamp(
        year.try_cast("int"), month, day.try_cast("int"), F.lit(0), F.lit(0), F.lit(0)
    )
    exact = F.try_make_timestamp(
        year.try_cast("int"), month, day.try_cast("int"), hour.try_cast("int"),
        F.coalesce(minute.try_cast("int"), F.lit(0)), F.lit(0),
    )
    return F.when(hour.try_cast("int") >= 24, day_start + F.expr("INTERVAL 1 DAY")).otherwise(exact)


def regime_level(piece: Column) -> Column:
    """Level of the first stem followed by the regime word, 0 when there is none."""
    stems = _literal_map({stem: str(level) for stem, level in config.REGIME_STEMS.items()})
    stem = F.lower(F.regexp_extract(piece, REGIME, 1))
    return F.coalesce(F.try_element_at(stems, stem).try_cast("int"), F.lit(0))


def regime_label(level: Column) -> Column:
    labels = _literal_map({str(level): label for level, label in config.REGIME_LABELS.items()})
    return F.try_element_at(labels, level.cast("string"))


def announcement(piece: Column) -> Column:
    """The whole piece up to the end of its period, blanks collapsed."""
    return collapse(F.regexp_extract(piece, THROUGH_PERIOD, 0))


def published_announcement(whole: Column) -> Column:
    """An announcement as it is published; layers and features keep the whole text."""
    return F.substring(whole, 1, NOTICE_TEXT_LENGTH)
