"""Flight projections, scope filters and scheduled hours."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.functions.airports import CODES
from skylag.functions.times import scheduled_hour, scheduled_minute, with_rollover

# The flight columns the analysis keeps.
FLIGHT_COLUMNS = [
    "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "FL_DATE", "CRS_ARR_TIME", "CRS_DEP_TIME", "DEP_DELAY",
    "ARR_DELAY", "ORIGIN_CITY_NAME", "DEST_CITY_NAME", "ORIGIN", "DEST", "DAY_OF_WEEK", "MONTH", "YEAR",
    "QUARTER", "DAY_OF_MONTH", "OP_UNIQUE_CARRIER", "DEP_TIME",
]
# Row key of the derived fixture; carried along when present as a tie-break.
KEY = "FLIGHT_KEY"


def select_flights(df: DataFrame) -> DataFrame:
    keep = [KEY] if KEY in df.columns else []
    return df.select(*keep, *FLIGHT_COLUMNS)


def between_open(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Both bounds excluded."""
    return df.where((F.col(col) > F.lit(lo)) & (F.col(col) < F.lit(hi)))


def between_closed(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Both bounds included."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def in_scope(df: DataFrame, codes: list[str] = CODES) -> DataFrame:
    """Origin and destination both in the code list."""
    return df.where(F.col("DEST").isin(codes) & F.col("ORIGIN").isin(codes))


def semi_in_scope(df: DataFrame, dim: DataFrame) -> DataFrame:
    """The same filter as two semi joins with the 13-row airport dimension."""
    for side in ("ORIGIN", "DEST"):
        keys = F.broadcast(dim.select(F.col("code").alias(side)))
        df = df.join(keys, side, "left_semi")
    return df


def at_origin(df: DataFrame, airport_id: int) -> DataFrame:
    return df.where(F.col("ORIGIN_AIRPORT_ID") == airport_id)


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every named column is present."""
    return df.na.drop(subset=list(cols))


def dep_clock() -> Column:
    """Actual departure ``hhmm`` as the analysis tables carry it."""
    return F.round("DEP_TIME", 2)


def with_schedule(df: DataFrame, rollover: bool = False) -> DataFrame:
    """Add ``hour`` and the scheduled departure and arrival hours.

    Arrivals use the departure date unless ``rollover`` moves an arrival that
    would precede its departure to the next day.
    """
    arrival = scheduled_hour("CRS_ARR_TIME")
    if rollover:
        earlier = scheduled_minute("CRS_ARR_TIME") < scheduled_minute("CRS_DEP_TIME")
        arrival = F.when(earlier, arrival + F.make_dt_interval(days=F.lit(1))).otherwise(arrival)
    return df.withColumns(
        {"hour": dep_clock(), "sched_dep_hour": scheduled_hour("CRS_DEP_TIME"), "sched_arr_hour": arrival}
    )


def with_exact_schedule(df: DataFrame) -> DataFrame:
    """Scheduled times to the minute, arrivals after midnight on the next day."""
    dep = scheduled_minute("CRS_DEP_TIME")
    return df.withColumns({"sched_dep": dep, "sched_arr": with_rollover(scheduled_minute("CRS_ARR_TIME"), dep)})


def clean_flights(df: DataFrame, after=None, before=None, rollover: bool = False) -> DataFrame:
    """Bronze flights: 18 columns, optional open date range, scope, valid schedule."""
    flights = select_flights(df)
    if after is not None and before is not None:
        flights = between_open(flights, "FL_DATE", after, before)
    flights = with_schedule(in_scope(flights), rollover)
    return require(flights, "sched_dep_hour", "sched_arr_hour")
