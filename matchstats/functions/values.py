"""Column expressions that clean raw payload values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def number(text: Column) -> Column:
    """Plain decimal text as a double, anything else as NULL."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def percent_value(text: Column) -> Column:
    """``55`` and ``55%`` are numbers, other text is 0, unreadable percentages and NULL are NULL."""
    return F.when(text.contains("%"), number(F.replace(text, F.lit("%"), F.lit("")))).otherwise(
        F.when(text.isNotNull(), F.coalesce(number(text), F.lit(0.0)))
    )


def stat_value(text: Column) -> Column:
    """A player statistic: NULL counts as 0, booleans as 1/0, unreadable text is NULL."""
    return (
        F.when(text.isNull(), F.lit(0.0))
        .when(text == "true", F.lit(1.0))
        .when(text == "false", F.lit(0.0))
        .otherwise(number(text))
    )


def is_scalar(text: Column) -> Column:
    """False for nested JSON objects and arrays."""
    return text.isNull() | ~text.rlike(r"^\s*[{\[]")


def match_date(text: Column) -> Column:
    """Epoch seconds or ISO text, decided row by row, as a UTC wall-clock time; else NULL."""
    seconds = number(text).cast("bigint")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    from_epoch = F.timestamp_add("SECOND", seconds, epoch)
    zoned = F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")
    has_zone = text.rlike(r"([zZ]|[+-][0-9]{2}:?[0-9]{2})$") & text.contains(":")
    return (
        F.when(seconds.isNotNull(), from_epoch)
        .when(has_zone, zoned)
        .otherwise(text.try_cast("timestamp_ntz"))
    )


def match_title(home: Column, away: Column) -> Column:
    """``home vs away``; NULL if either name is missing."""
    return F.concat(home, F.lit(" vs "), away)


def day_text(timestamp: Column) -> Column:
    return F.date_format(F.to_date(timestamp), "dd/MM/yyyy")


def split_camel_case(key: Column) -> Column:
    """``expectedGoalsOnTargetX`` -> ``Expected Goals On Target X``."""
    words = F.regexp_replace(key, "(.)([A-Z][a-z]+)", "$1 $2")
    return F.initcap(F.regexp_replace(words, "([a-z0-9])([A-Z])", "$1 $2"))
