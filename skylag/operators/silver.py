"""Flights joined to the hourly weather at their origin or destination."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.functions.airports import CODES
from skylag.operators.flights import KEY
from skylag.operators.weather import MEASURES
from skylag.session import new_path, stage
from skylag.sources.layout import save_bucketed

# Column order of both silver tables.
SILVER_COLUMNS = [
    "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "DEP_DELAY", "ARR_DELAY", "FL_DATE", "DAY_OF_WEEK", "MONTH", "YEAR",
    "hour", "QUARTER", "DAY_OF_MONTH", *MEASURES,
]

# An hourly row in a hash table: 8-byte time, 6 doubles, short code, row overhead.
HOURLY_ROW_BYTES = 160
BROADCAST_LIMIT = 256 * 1024 * 1024


def to_silver(df: DataFrame, with_key: bool = False) -> DataFrame:
    """The 17-column layout, led by the row key when asked for."""
    return df.select(*([KEY] if with_key else []), *SILVER_COLUMNS)


def scope_hours(hourly: DataFrame) -> DataFrame:
    """Hours of the airports in scope; the inner joins need no others."""
    return hourly.where(F.col("call_sign").isin(CODES))


def hourly_table(hourly: DataFrame) -> DataFrame:
    """Hourly weather of the airports in scope as a written table.

    Written once, so both directions read it back instead of aggregating the
    reports again, and so the join can check its exact size.
    """
    return stage(scope_hours(hourly), "hourly")


def attach_weather(
    flights: DataFrame, hourly: DataFrame, hour_col: str, code_col: str, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Inner join on (scheduled hour, airport); ``hourly`` is a written table.

    The table has at most one row per airport and hour, so it is broadcast
    after its rows are counted (a footer read) and the flights never move. Past
    the limit both sides go through a plain shuffle, where the session's
    skew-join setting splits hot (hour, airport) partitions.
    """
    small = hourly.count() * HOURLY_ROW_BYTES <= limit
    right = F.broadcast(hourly) if small else hourly.hint("merge")
    return flights.join(right, [F.col(hour_col) == F.col("time"), F.col(code_col) == F.col("call_sign")], "inner")


def silver_dep(flights: DataFrame, hourly: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    return attach_weather(flights, hourly, "sched_dep_hour", "ORIGIN", limit)


def silver_arr(flights: DataFrame, hourly: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    return attach_weather(flights, hourly, "sched_arr_hour", "DEST", limit)


#: Flights of one hour and airport from which on they are spread over several buckets.
HOT_FLIGHTS = 1_000_000


def hot_hours(flights: DataFrame, hour_col: str, code_col: str, most: int = HOT_FLIGHTS) -> DataFrame:
    """(time, call_sign, salts) of hours with more than ``most`` flights; at most one in ``most`` flights gives a row."""
    counted = flights.groupBy(F.col(hour_col).alias("time"), F.col(code_col).alias("call_sign")).agg(F.count(F.lit(1)).alias("n"))
    return stage(counted.where(F.col("n") > most).select("time", "call_sign", F.ceil(F.col("n") / most).cast("int").alias("salts")), "hot")


def bucketed_sides(
    flights: DataFrame, hourly: DataFrame, hour_col: str, code_col: str, label: str, buckets: int, most: int = HOT_FLIGHTS
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a weather join as stored tables in buckets of hour, airport and salt.

    The flights of a hot hour are dealt over salts, and its weather row is repeated for each. Written once, the tables
    are joined by ``attach_bucketed`` any number of times without a shuffle.
    """
    spark = flights.sparkSession
    hot = hot_hours(flights, hour_col, code_col, most)
    named = hot.select(F.col("time").alias("hot_time"), F.col("call_sign").alias("hot_code"), "salts")
    key = F.xxhash64(*[c for c in flights.columns])
    dealt = flights.join(named, [F.col(hour_col) == F.col("hot_time"), F.col(code_col) == F.col("hot_code")], "left").withColumn(
        "salt", F.coalesce(F.pmod(key, F.col("salts")), F.lit(0)).cast("int")).select(*flights.columns, "salt")
    repeated = hourly.join(named, [F.col("time") == F.col("hot_time"), F.col("call_sign") == F.col("hot_code")], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).select(*hourly.columns, "salt")
    sides = []
    for rows, side, keys in ((dealt, "flights", [hour_col, code_col, "salt"]), (repeated, "hours", ["time", "call_sign", "salt"])):
        path = new_path(spark, f"{label}-{side}")
        sides.append(save_bucketed(rows, path.rpartition("/")[2].replace("-", "_"), path, keys, buckets))
    return sides[0], sides[1]


def attach_bucketed(flights: DataFrame, hourly: DataFrame, hour_col: str, code_col: str) -> DataFrame:
    """Inner join of two ``bucketed_sides`` on (scheduled hour, airport); nothing is shuffled, whatever their size."""
    right = hourly.withColumnRenamed("salt", "hour_salt").hint("merge")
    same = [F.col(hour_col) == F.col("time"), F.col(code_col) == F.col("call_sign"), F.col("salt") == F.col("hour_salt")]
    return flights.join(right, same, "inner").drop("salt", "hour_salt")
