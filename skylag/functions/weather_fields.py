"""Packed comma-joined report fields as typed columns.

Every cast is a ``try_cast`` and every element access is bounds-safe, so one
malformed report yields NULLs instead of failing the job.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(packed: str, index: int) -> Column:
    """Sub-field ``index`` of a packed column, NULL when missing."""
    if index == 0:
        return F.substring_index(F.col(packed), ",", 1)  # no array needed for the first one
    return F.get(F.split(F.col(packed), ","), index)


def number(packed: str, index: int) -> Column:
    return part(packed, index).try_cast("double")


def fahrenheit(packed: str) -> Column:
    """Tenths of a degree Celsius to Fahrenheit."""
    return number(packed, 0) * 9 / 50 + 32


def temperature() -> dict[str, Column]:
    return {"temp_f": fahrenheit("TMP"), "temp_qual": part("TMP", 1)}


def wind() -> dict[str, Column]:
    return {
        "wnd_deg": part("WND", 0),
        "wnd_1": part("WND", 1),
        "wnd_2": part("WND", 2),
        "wnd_mps": number("WND", 3) / 10,
        "wnd_4": part("WND", 4),
    }


def visibility() -> dict[str, Column]:
    return {
        "vis_m": part("VIS", 0),
        "vis_1": part("VIS", 1),
        "vis_2": part("VIS", 2),
        "vis_3": part("VIS", 3),
    }


def dew_point() -> dict[str, Column]:
    return {"dew_pt_f": fahrenheit("DEW"), "dew_1": part("DEW", 1)}


def pressure() -> dict[str, Column]:
    return {"slp_hpa": number("SLP", 0) / 10, "slp_1": part("SLP", 1)}


def precipitation() -> dict[str, Column]:
    depth = number("AA1", 1) / 10
    return {
        "precip_hr_dur": part("AA1", 0),
        "precip_mm_intvl": depth,
        "precip_cond": part("AA1", 2),
        "precip_qual": part("AA1", 3),
        "precip_mm": F.try_divide(depth, number("AA1", 0)),
    }


def station_code(call_sign: str = "CALL_SIGN") -> Column:
    """Three-letter station out of a five-character padded call sign."""
    return F.substring(F.col(call_sign), -4, 3)


def report_hour(ts: str = "DATE") -> Column:
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
