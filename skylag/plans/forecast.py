"""Forecast inputs, forecasts by stage and the 24-hour view of an airport."""

import math

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.functions.times import with_rollover
from skylag.operators.flights import KEY, at_origin
from skylag.operators.model import score_stages
from skylag.operators.monitor import by_stage
from skylag.operators.ordered import ROWS_PER_CHUNK, fill_both
from skylag.operators.silver import SILVER_COLUMNS
from skylag.params import Params
from skylag.sources.registry import PRODUCTION, STAGING, load_stage
from skylag.sources.tables import between_dates


def forecast_input(silver: DataFrame, params: Params, inclusive_start: bool = True) -> DataFrame:
    """Silver rows at the airport from the training end to the inference date."""
    rows = between_dates(at_origin(silver, params.airport_id), params.training_end, params.inference_date)
    return rows if inclusive_start else rows.where(F.col("FL_DATE") > F.lit(params.training_end))


def training_input(silver: DataFrame, params: Params) -> DataFrame:
    return between_dates(at_origin(silver, params.airport_id), params.training_start, params.training_end)


def time_order(rows: DataFrame) -> list:
    """Date, hour, then the row key if there is one, else all other columns."""
    rest = [KEY] if KEY in rows.columns else [c for c in rows.columns if c not in ("FL_DATE", "hour")]
    return [F.asc_nulls_last(c) for c in ("FL_DATE", "hour", *rest)]


def filled(rows: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Forward then backward fill in time order over all columns that may be missing."""
    cols = [c for c in SILVER_COLUMNS if c != "FL_DATE" and c in rows.columns and not c.endswith("AIRPORT_ID")]
    return fill_both(rows, cols, time_order(rows), ["ORIGIN_AIRPORT_ID"], chunk_rows)


def forecast_by_stage(models: dict[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """Each stage's forecast of the same filled rows, sorted by hour."""
    scored, predictions = score_stages(models, filled(rows))
    return timeline(by_stage(scored, predictions, "model").select(*rows.columns, "model", "yhat"))


def timeline(scored: DataFrame) -> DataFrame:
    return scored.orderBy(F.asc_nulls_last("hour"), "model", *([KEY] if KEY in scored.columns else ["FL_DATE"]))


def with_times(flights: DataFrame) -> DataFrame:
    """Scheduled times to the minute from the flight date, so a date filter can reach the scan."""

    def at(hhmm):
        day = F.col("FL_DATE")
        return F.try_make_timestamp_ntz(
            F.year(day), F.month(day), F.dayofmonth(day), F.substring(hhmm, 1, 2).try_cast("int"),
            F.substring(hhmm, 3, 2).try_cast("int"), F.lit(0).cast("decimal(16,6)"))

    dep = at("CRS_DEP_TIME")
    return flights.withColumns({"sched_dep": dep, "sched_arr": with_rollover(at("CRS_ARR_TIME"), dep)})


def _near(flights: DataFrame, mark, days_before: int, hours: int) -> DataFrame:
    """Flights whose date can matter for the mark; a plain range on FL_DATE."""
    return flights.where(F.col("FL_DATE").between(
        F.date_sub(mark.cast("date"), days_before),
        (mark + F.make_dt_interval(hours=F.lit(hours))).cast("date")))


def next_hours(flights: DataFrame, airport: str, mark: str, hours: int = 24) -> DataFrame:
    """Flights due to leave or reach the airport within ``hours`` after the mark."""
    start = F.lit(mark).cast("timestamp_ntz")
    end = start + F.make_dt_interval(hours=F.lit(hours))

    def within(col):
        return (F.col(col) >= start) & (F.col(col) < end)

    leaving = (F.col("ORIGIN") == airport) & within("sched_dep")
    coming = (F.col("DEST") == airport) & within("sched_arr")
    return with_times(_near(flights, start, 1, hours)).where(leaving | coming).withColumn(
        "direction", F.when(leaving, "departure").otherwise("arrival"))


def in_flight(flights: DataFrame, airport: str, mark: str) -> DataFrame:
    """Inbound flights that have left and have not arrived, with their duration in minutes.

    A flight whose arrival delay is not known is taken to arrive on time. The dates read follow from the earliest
    departure and the latest arrival among all delays, so no flight is lost.
    """
    now = F.lit(mark).cast("timestamp_ntz")
    bound = flights.where(F.col("DEST") == airport)
    early, late = bound.agg(F.min("DEP_DELAY"), F.max("ARR_DELAY")).first()
    # an arrival is scheduled at most a day after its departure, which is within a day of the flight's date
    days = 2 + math.ceil(max(0, late or 0) / 1440)
    near = _near(bound, now, days, math.ceil(max(0, -(early or 0)) / 60) + 1)
    left = F.col("sched_dep") + F.make_dt_interval(mins=F.col("DEP_DELAY").cast("int"))
    arrives = F.col("sched_arr") + F.make_dt_interval(mins=F.coalesce(F.col("ARR_DELAY"), F.lit(0)).cast("int"))
    planned = F.timestamp_diff("MINUTE", F.col("sched_dep"), F.col("sched_arr"))
    return with_times(near).where((left < now) & (arrives >= now)).withColumn(
        "duration_min", planned + F.col("ARR_DELAY") - F.col("DEP_DELAY"))


#: Seconds of the buckets of time in which flights in the air are looked for, and buckets of one size that a flight is put in.
AIR_BUCKETS, MOST_BUCKETS = (3600, 86_400, 30 * 86_400), 48


def _seconds(time) -> Column:
    """Seconds of a local time since 1970."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), time)


def next_hours_at(flights: DataFrame, marks: DataFrame, hours: int = 24) -> DataFrame:
    """``next_hours`` for each row (airport, mark) of a table, which may be of any length.

    Departures and arrivals are looked up by airport and bucket of time, ``hours`` wide, of which a mark's span touches two.
    """
    width = hours * 3600
    timed = with_times(flights)
    events = timed.select("*", F.inline(F.array(
        F.struct(F.col("ORIGIN").alias("at"), F.col("sched_dep").alias("due"), F.lit("departure").alias("direction")),
        F.struct(F.col("DEST").alias("at"), F.col("sched_arr").alias("due"), F.lit("arrival").alias("direction"))))).where(F.col("due").isNotNull())
    bucket = F.floor(_seconds(F.col("due")) / width)
    first = F.floor(_seconds(F.col("mark")) / width)
    asked = marks.select("airport", F.col("mark").cast("timestamp_ntz").alias("mark")).distinct()
    spread = asked.withColumn("bucket", F.explode(F.array(first, first + 1)))
    end = F.col("mark") + F.make_dt_interval(hours=F.lit(hours))

    def within(col):
        return (F.col(col) >= F.col("mark")) & (F.col(col) < end)

    # a flight that leaves and reaches the airport in the span counts as leaving
    twice = (F.col("direction") == "arrival") & (F.col("ORIGIN") == F.col("airport")) & F.coalesce(within("sched_dep"), F.lit(False))
    met = events.withColumn("due_bucket", bucket).join(spread, [F.col("at") == F.col("airport"), F.col("due_bucket") == F.col("bucket")])
    return met.where(within("due") & ~twice).select("airport", "mark", *timed.columns, "direction")


def in_flight_at(flights: DataFrame, marks: DataFrame) -> DataFrame:
    """``in_flight`` for each row (airport, mark) of a table, which may be of any length.

    A flight is put in the buckets of time that it is in the air in: of an hour, or of a day or a month if it takes very
    long. A mark lies in one bucket of each size, so each pair meets once, and nothing is compared but what shares a bucket.
    """
    timed = with_times(flights)
    left = F.col("sched_dep") + F.make_dt_interval(mins=F.col("DEP_DELAY").cast("int"))
    arrives = F.col("sched_arr") + F.make_dt_interval(mins=F.coalesce(F.col("ARR_DELAY"), F.lit(0)).cast("int"))
    air = timed.withColumns({"left_at": left, "arrives_at": arrives}).where("left_at < arrives_at")
    took = _seconds(F.col("arrives_at")) - _seconds(F.col("left_at"))
    width = F.lit(AIR_BUCKETS[-1])
    for w in reversed(AIR_BUCKETS[:-1]):
        width = F.when(took <= w * MOST_BUCKETS, w).otherwise(width)
    air = air.withColumn("width", width).withColumn("bucket", F.explode(F.sequence(
        F.floor(_seconds(F.col("left_at")) / F.col("width")), F.floor(_seconds(F.col("arrives_at")) / F.col("width")))))
    asked = marks.select("airport", F.col("mark").cast("timestamp_ntz").alias("mark")).distinct().withColumn(
        "mark_width", F.explode(F.array(*map(F.lit, AIR_BUCKETS))))
    asked = asked.withColumn("mark_bucket", F.floor(_seconds(F.col("mark")) / F.col("mark_width")))
    met = air.join(asked, [F.col("DEST") == F.col("airport"), F.col("width") == F.col("mark_width"), F.col("bucket") == F.col("mark_bucket")])
    planned = F.timestamp_diff("MINUTE", F.col("sched_dep"), F.col("sched_arr"))
    return met.where((F.col("left_at") < F.col("mark")) & (F.col("arrives_at") >= F.col("mark"))).withColumn(
        "duration_min", planned + F.col("ARR_DELAY") - F.col("DEP_DELAY")).select("airport", "mark", *timed.columns, "duration_min")


def forecast_stages(base: str, name: str, rows: DataFrame, stages: tuple[str, ...] = (STAGING, PRODUCTION)) -> DataFrame:
    """Forecasts by the registered model of ``name`` in each stage; a stage that none is in is left out."""
    models = {}
    for stage in stages:
        try:
            models[stage] = load_stage(rows.sparkSession, base, name, stage)
        except LookupError:
            continue
    if not models:
        raise LookupError(f"no version of {name!r} is in any of the stages {', '.join(stages)}")
    return forecast_by_stage(models, rows)
