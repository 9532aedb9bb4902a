"""Weather reports: projection, quality filter, hourly aggregate."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.functions import weather_fields as wf

# Report columns kept, valid report types, good quality code,
# station text of an unknown call sign.
REPORT_COLUMNS = [
    "DATE", "LATITUDE", "LONGITUDE", "TMP", "VIS", "ELEVATION", "CIG", "DEW", "SLP", "WND", "AA1", "CALL_SIGN",
]
REPORT_TYPES = ["FM-15", "FM-13"]
GOOD = "5"
UNKNOWN_STATION = "999"
# What the packed fields hold when a measurement is missing.
MISSING = {"WND": "9999", "VIS": "999999", "DEW": "+9999", "SLP": "99999"}

MEASURES = ["avg_temp_f", "tot_precip_mm", "avg_wnd_mps", "avg_vis_m", "avg_slp_hpa", "avg_dewpt_f"]


def select_reports(df: DataFrame) -> DataFrame:
    return df.select(*REPORT_COLUMNS)


def good_reports(df: DataFrame) -> DataFrame:
    """Known station, accepted report type, good temperature and precipitation.

    A report without precipitation has no quality code there and is dropped.
    """
    return df.where(
        F.col("REPORT_TYPE").isin(REPORT_TYPES)
        & (wf.station_code() != UNKNOWN_STATION)
        & (wf.part("AA1", 3) == GOOD)
        & (wf.part("TMP", 1) == GOOD)
    )


def parse_reports(df: DataFrame) -> DataFrame:
    """Every packed field as its own column next to the report's columns."""
    return df.withColumns(
        wf.temperature()
        | wf.wind()
        | wf.visibility()
        | wf.dew_point()
        | wf.pressure()
        | wf.precipitation()
        | {"time": wf.report_hour(), "station": wf.station_code()}
    )


def report_measures(df: DataFrame, null_sentinels: bool = False, keep: list[str] = ()) -> DataFrame:
    """Good reports as (time, call_sign, six measures), ready to aggregate.

    ``null_sentinels`` turns missing-value codes into NULL; the default keeps
    them as numbers.
    """

    def kept(packed: str, index: int, value):
        if not null_sentinels or packed not in MISSING:
            return value
        return F.when(wf.part(packed, index) != MISSING[packed], value)

    return good_reports(df).select(
        *keep,
        wf.report_hour().alias("time"),
        wf.station_code().alias("call_sign"),
        wf.fahrenheit("TMP").alias("temp_f"),
        wf.precipitation()["precip_mm"].alias("precip_mm"),
        kept("WND", 3, wf.number("WND", 3) / 10).alias("wnd_mps"),
        kept("VIS", 0, wf.number("VIS", 0)).alias("vis_m"),
        kept("SLP", 0, wf.number("SLP", 0) / 10).alias("slp_hpa"),
        kept("DEW", 0, wf.fahrenheit("DEW")).alias("dew_pt_f"),
    )


def hourly_aggregates():
    return [
        F.avg("temp_f").alias("avg_temp_f"),
        F.sum("precip_mm").alias("tot_precip_mm"),
        F.avg("wnd_mps").alias("avg_wnd_mps"),
        F.avg("vis_m").alias("avg_vis_m"),
        F.avg("slp_hpa").alias("avg_slp_hpa"),
        F.avg("dew_pt_f").alias("avg_dewpt_f"),
    ]


def hourly_weather(df: DataFrame, null_sentinels: bool = False) -> DataFrame:
    """Five means and one sum per (hour, station); partial sums form before the shuffle."""
    return report_measures(df, null_sentinels).groupBy("time", "call_sign").agg(*hourly_aggregates())


# Means and the sum of an hour, by the measure each comes from.
_MEANS = {"avg_temp_f": "temp_f", "avg_wnd_mps": "wnd_mps", "avg_vis_m": "vis_m", "avg_slp_hpa": "slp_hpa", "avg_dewpt_f": "dew_pt_f"}
_TOTAL = {"tot_precip_mm": "precip_mm"}
HOUR_KEYS = ["time", "call_sign"]
HOUR_SUMS = [f"{k}_{c}" for c in _MEANS.values() for k in ("sum", "n")] + [f"sum_{c}" for c in _TOTAL.values()]
PARTIAL_HOURS = "time timestamp_ntz, call_sign string, " + ", ".join(f"{c} {'long' if c.startswith('n_') else 'double'}" for c in HOUR_SUMS)


def partial_hours(measured: DataFrame) -> DataFrame:
    """Sums and counts per (hour, station); those of several batches add up to those of all their reports."""
    return measured.groupBy(*HOUR_KEYS).agg(*[
        f(c).alias(f"{k}_{c}") for c in _MEANS.values() for k, f in (("sum", F.sum), ("n", F.count))
    ], *[F.sum(c).alias(f"sum_{c}") for c in _TOTAL.values()])


def finished_hours(partial: DataFrame) -> DataFrame:
    """Hourly weather from added-up partial hours."""
    out = {name: F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}")) for name, c in _MEANS.items()}
    out |= {name: F.col(f"sum_{c}") for name, c in _TOTAL.items()}
    return partial.select(*HOUR_KEYS, *[out[m].alias(m) for m in MEASURES])


def settled(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    """Means and sums to fixed places, so equal readings compare equal.

    The last bits of a mean depend on the order rows were added in; counting
    distinct values or cutting bins needs them gone.
    """
    return df.withColumns({c: F.round(F.col(c) + 1e-9, places) for c in cols})
