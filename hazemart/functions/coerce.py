"""Text to typed values. Nothing here raises under ANSI mode: bad text becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# single-letter month, day and hour patterns also take two digits
FLEXIBLE_TIME_FORMATS = ("yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d")


def number(text: Column) -> Column:
    """Double from text with a decimal comma or point."""
    return F.replace(text.cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def integer(text: Column) -> Column:
    """Integer from text, by way of double so that ``3837.0`` is accepted."""
    return number(text).try_cast("int")


def timestamp(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def timestamp_any(text: Column, patterns: tuple[str, ...] = FLEXIBLE_TIME_FORMATS) -> Column:
    """First pattern that fits, after ``T`` was turned into a blank."""
    plain = F.replace(F.trim(text), F.lit("T"), F.lit(" "))
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(p)) for p in patterns])


def boolean(text: Column, unknown: bool | None = None) -> Column:
    """``true`` in any case is true. Null text stays null unless ``unknown`` is given.

    With ``unknown`` set, text other than true/false also takes that value.
    """
    lowered = F.lower(text.cast("string"))
    if unknown is None:
        return lowered == "true"
    return F.when(lowered == "true", True).when(lowered == "false", False).otherwise(unknown)


def value_of_type(text: Column, data_type: T.DataType, unknown_bool: bool | None = None) -> Column:
    if isinstance(data_type, T.StringType):
        return text.cast("string")
    if isinstance(data_type, T.BooleanType):
        return boolean(text, unknown_bool)
    if isinstance(data_type, (T.IntegerType, T.LongType, T.ShortType)):
        return text.cast("string").try_cast("double").try_cast(data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return text.cast("string").try_cast(data_type)
    return text.cast("string").try_cast(data_type)


def coerce_to(df: DataFrame, schema: T.StructType, unknown_bool: bool | None = None) -> DataFrame:
    """Exactly the columns of ``schema``, in its order; values that do not fit become null."""
    return df.select(
        *[value_of_type(F.col(f.name), f.dataType, unknown_bool).alias(f.name) for f in schema.fields]
    )


def rename_coerce(df: DataFrame, sources: dict[str, str]) -> DataFrame:
    """Add ``target`` = number(``source``) for every pair, in one projection."""
    return df.withColumns({target: number(F.col(source)) for target, source in sources.items()})
