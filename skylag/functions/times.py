"""Scheduled and actual times out of date parts and hhmm fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def scheduled_hour(hhmm: str) -> Column:
    """Hour of a zero-padded ``hhmm`` on the flight's date; NULL when malformed."""
    return F.try_make_timestamp_ntz(
        F.col("YEAR"),
        F.col("MONTH"),
        F.col("DAY_OF_MONTH"),
        F.substring(hhmm, 1, 2).try_cast("int"),
        F.lit(0),
        F.lit(0).cast("decimal(16,6)"),
    )


def scheduled_minute(hhmm: str) -> Column:
    """Scheduled time to the minute; NULL when malformed."""
    return F.try_make_timestamp_ntz(
        F.col("YEAR"),
        F.col("MONTH"),
        F.col("DAY_OF_MONTH"),
        F.substring(hhmm, 1, 2).try_cast("int"),
        F.substring(hhmm, 3, 2).try_cast("int"),
        F.lit(0).cast("decimal(16,6)"),
    )


def with_rollover(arrival: Column, departure: Column) -> Column:
    """An arrival earlier than its departure belongs to the next day."""
    return F.when(arrival < departure, arrival + F.make_dt_interval(days=F.lit(1))).otherwise(arrival)


def clock_text(hhmm: Column) -> Column:
    """Numeric hhmm as ``HH:MM`` text."""
    digits = F.lpad(hhmm.cast("int").cast("string"), 4, "0")
    return F.regexp_replace(digits, r"(\d{2})(\d{2})", "$1:$2")


def day_and_clock(day: Column, clock: Column) -> Column:
    """Date plus ``HH:MM`` as a timestamp; NULL when the clock is not valid."""
    text = F.concat(day.cast("string"), F.lit(" "), clock)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")


def departure_hour_of_day(hhmm: Column) -> Column:
    return F.floor(hhmm / 100).cast("int")
