"""Queries of the ingest path: scans, projections, parsing, hourly weather, silver joins."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.sql import CODES_SQL, SILVER_COLS, cols, ctes, hour_ts, r
from checks import fixtures as fx
from skylag.functions import airports, times, weather_fields as wf
from skylag.operators import flights as fl
from skylag.operators import silver as sv
from skylag.operators import weather as wx
from skylag.session import stage

FLIGHT_OUT = ["FLIGHT_KEY", *fl.FLIGHT_COLUMNS]
DELAYS = {"DEP_DELAY", "ARR_DELAY", "DEP_TIME"}
SPAN = ("1996-01-01", "2000-01-01")


def bronze(spark, sf_dir):
    return fl.clean_flights(fx.flights(spark, sf_dir))


def hourly(spark, sf_dir):
    return wx.hourly_weather(fx.reports(spark, sf_dir))


def silver(spark, sf_dir, direction, with_key=True, hours=None):
    """Silver rows of one direction over the given hourly table, or a freshly written one."""
    join = {"dep": sv.silver_dep, "arr": sv.silver_arr}[direction]
    joined = join(bronze(spark, sf_dir), sv.hourly_table(hourly(spark, sf_dir)) if hours is None else hours)
    return sv.to_silver(joined, with_key)


def silver_table(spark, sf_dir, direction, *keep):
    """Columns of a silver table, written once for queries that read them more than once."""
    return stage(silver(spark, sf_dir, direction).select(*keep), "silver")


# --- flights ---------------------------------------------------------------

@query("project_flights", f"{ctes('flights')} SELECT {cols(FLIGHT_OUT, DELAYS)} FROM flights")
def _(spark, sf):
    return fl.select_flights(fx.flights(spark, sf))


@query("project_weather", f"{ctes('reports')} SELECT {cols(wx.REPORT_COLUMNS, {'LATITUDE','LONGITUDE','ELEVATION'})} FROM reports")
def _(spark, sf):
    return wx.select_reports(fx.reports(spark, sf))


@query("filter_date_open", f"""{ctes('flights')} SELECT {cols(FLIGHT_OUT, DELAYS)} FROM flights
WHERE FL_DATE > DATE '{SPAN[0]}' AND FL_DATE < DATE '{SPAN[1]}'""")
def _(spark, sf):
    return fl.between_open(fl.select_flights(fx.flights(spark, sf)), "FL_DATE", *SPAN)


@query("filter_date_closed", f"""{ctes('flights')} SELECT {cols(FLIGHT_OUT, DELAYS)} FROM flights
WHERE FL_DATE BETWEEN DATE '{SPAN[0]}' AND DATE '{SPAN[1]}'""")
def _(spark, sf):
    return fl.between_closed(fl.select_flights(fx.flights(spark, sf)), "FL_DATE", *SPAN)


@query("filter_airports", f"""{ctes('flights')} SELECT {cols(FLIGHT_OUT, DELAYS)} FROM flights
WHERE ORIGIN IN {CODES_SQL} AND DEST IN {CODES_SQL}""")
def _(spark, sf):
    return fl.in_scope(fl.select_flights(fx.flights(spark, sf)))


@query("semi_in_scope", f"""{ctes('flights')} SELECT {cols(FLIGHT_OUT, DELAYS)} FROM flights
WHERE EXISTS (SELECT 1 FROM (SELECT unnest({CODES_SQL.replace('(', '[').replace(')', ']')}) AS code) a WHERE a.code = ORIGIN)
AND EXISTS (SELECT 1 FROM (SELECT unnest({CODES_SQL.replace('(', '[').replace(')', ']')}) AS code) a WHERE a.code = DEST)""")
def _(spark, sf):
    return fl.semi_in_scope(fl.select_flights(fx.flights(spark, sf)), airports.airport_dim(spark)).select(*FLIGHT_OUT)


@query("filter_airport_id", f"""{ctes('flights')} SELECT {cols(FLIGHT_OUT, DELAYS)} FROM flights
WHERE ORIGIN_AIRPORT_ID = 12478""")
def _(spark, sf):
    return fl.at_origin(fl.select_flights(fx.flights(spark, sf)), airports.AIRPORT_IDS["JFK"])


@query("filter_not_null", f"""{ctes('flights')} SELECT {cols(FLIGHT_OUT, DELAYS)} FROM flights
WHERE DEP_DELAY IS NOT NULL AND ARR_DELAY IS NOT NULL""")
def _(spark, sf):
    return fl.require(fl.select_flights(fx.flights(spark, sf)), "DEP_DELAY", "ARR_DELAY")


BRONZE_OUT = [*FLIGHT_OUT, "hour", "sched_dep_hour", "sched_arr_hour"]


@query("clean_flights", f"{ctes('clean')} SELECT {cols(BRONZE_OUT, DELAYS | {'hour'})} FROM clean")
def _(spark, sf):
    return bronze(spark, sf)


@query("sched_ts_dep", f"{ctes('flights')} SELECT FLIGHT_KEY, CRS_DEP_TIME, {hour_ts('CRS_DEP_TIME')} AS sched_dep_hour FROM flights")
def _(spark, sf):
    return fx.flights(spark, sf).select(
        "FLIGHT_KEY", "CRS_DEP_TIME", times.scheduled_hour("CRS_DEP_TIME").alias("sched_dep_hour"))


@query("sched_ts_arr", f"{ctes('flights')} SELECT FLIGHT_KEY, CRS_ARR_TIME, {hour_ts('CRS_ARR_TIME')} AS sched_arr_hour FROM flights")
def _(spark, sf):
    return fx.flights(spark, sf).select(
        "FLIGHT_KEY", "CRS_ARR_TIME", times.scheduled_hour("CRS_ARR_TIME").alias("sched_arr_hour"))


@query("sched_ts_arr_rollover", f"""{ctes('flights')} SELECT FLIGHT_KEY, CRS_DEP_TIME, CRS_ARR_TIME,
{hour_ts('CRS_ARR_TIME')} + CASE WHEN CRS_ARR_TIME < CRS_DEP_TIME AND CRS_DEP_TIME < '24' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
AS sched_arr_hour FROM flights""")
def _(spark, sf):
    return fl.with_schedule(fx.flights(spark, sf), rollover=True).select(
        "FLIGHT_KEY", "CRS_DEP_TIME", "CRS_ARR_TIME", "sched_arr_hour")


@query("round_hour", f"{ctes('flights')} SELECT FLIGHT_KEY, {r('round(DEP_TIME, 2)', 'hour')}, CAST(floor(DEP_TIME/100) AS INT) AS dep_hour FROM flights")
def _(spark, sf):
    return fx.flights(spark, sf).select(
        "FLIGHT_KEY", fl.dep_clock().alias("hour"), times.departure_hour_of_day(F.col("DEP_TIME")).alias("dep_hour"))


@query("hhmm_format", f"""{ctes('flights')} SELECT FLIGHT_KEY,
regexp_replace(lpad(CAST(CAST(DEP_TIME AS INT) AS VARCHAR),4,'0'), '([0-9]{{2}})([0-9]{{2}})', '\\1:\\2') AS dep_clock FROM flights""")
def _(spark, sf):
    return fx.flights(spark, sf).select("FLIGHT_KEY", times.clock_text(F.col("DEP_TIME")).alias("dep_clock"))


@query("compose_ts", f"""{ctes('flights')} SELECT FLIGHT_KEY,
CAST(FL_DATE AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(floor(DEP_TIME/100) AS INT) + INTERVAL 1 MINUTE * CAST(DEP_TIME % 100 AS INT) AS dep_ts
FROM flights""")
def _(spark, sf):
    clock = times.clock_text(F.col("DEP_TIME"))
    return fx.flights(spark, sf).select("FLIGHT_KEY", times.day_and_clock(F.col("FL_DATE"), clock).alias("dep_ts"))


# --- reports ---------------------------------------------------------------

def _part(col, i):
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE split_part({col},',',{i}) END"


def _num(col, i):
    return f"CAST(split_part({col},',',{i}) AS DOUBLE)"


@query("parse_tmp", f"{ctes('reports')} SELECT TMP, {r(_num('TMP',1)+'*9/50+32','temp_f')}, {_part('TMP',2)} AS temp_qual FROM reports")
def _(spark, sf):
    return fx.reports(spark, sf).withColumns(wf.temperature()).select("TMP", *wf.temperature())


@query("parse_wnd", f"""{ctes('reports')} SELECT WND, {_part('WND',1)} AS wnd_deg, {_part('WND',2)} AS wnd_1, {_part('WND',3)} AS wnd_2,
{r(_num('WND',4)+'/10','wnd_mps')}, {_part('WND',5)} AS wnd_4 FROM reports""")
def _(spark, sf):
    return fx.reports(spark, sf).withColumns(wf.wind()).select("WND", *wf.wind())


@query("parse_vis", f"""{ctes('reports')} SELECT VIS, {_part('VIS',1)} AS vis_m, {_part('VIS',2)} AS vis_1, {_part('VIS',3)} AS vis_2,
{_part('VIS',4)} AS vis_3 FROM reports""")
def _(spark, sf):
    return fx.reports(spark, sf).withColumns(wf.visibility()).select("VIS", *wf.visibility())


@query("parse_dew", f"{ctes('reports')} SELECT DEW, {r(_num('DEW',1)+'*9/50+32','dew_pt_f')}, {_part('DEW',2)} AS dew_1 FROM reports")
def _(spark, sf):
    return fx.reports(spark, sf).withColumns(wf.dew_point()).select("DEW", *wf.dew_point())


@query("parse_slp", f"{ctes('reports')} SELECT SLP, {r(_num('SLP',1)+'/10','slp_hpa')}, {_part('SLP',2)} AS slp_1 FROM reports")
def _(spark, sf):
    return fx.reports(spark, sf).withColumns(wf.pressure()).select("SLP", *wf.pressure())


@query("parse_precip", f"""{ctes('reports')} SELECT AA1, {_part('AA1',1)} AS precip_hr_dur, {r(_num('AA1',2)+'/10','precip_mm_intvl')},
{_part('AA1',3)} AS precip_cond, {_part('AA1',4)} AS precip_qual,
{r(_num('AA1',2)+'/10/nullif('+_num('AA1',1)+',0)','precip_mm')} FROM reports""")
def _(spark, sf):
    return fx.reports(spark, sf).withColumns(wf.precipitation()).select("AA1", *wf.precipitation())


@query("trunc_hour", f"""{ctes('reports')} SELECT "DATE", date_trunc('hour', "DATE") AS "time" FROM reports""")
def _(spark, sf):
    return fx.reports(spark, sf).select("DATE", wf.report_hour().alias("time"))


@query("station_code", f"{ctes('reports')} SELECT CALL_SIGN, substr(CALL_SIGN,-4,3) AS station FROM reports")
def _(spark, sf):
    return fx.reports(spark, sf).select("CALL_SIGN", wf.station_code().alias("station"))


REPORT_OUT = [*wx.REPORT_COLUMNS, "REPORT_TYPE"]
ZEROS = {"LATITUDE", "LONGITUDE", "ELEVATION"}


@query("filter_weather_quality", f"{ctes('good')} SELECT {cols(REPORT_OUT, ZEROS)} FROM good")
def _(spark, sf):
    return wx.good_reports(fx.reports(spark, sf)).select(*REPORT_OUT)


@query("filter_hidden_col", f"{ctes('reports')} SELECT {cols(wx.REPORT_COLUMNS, ZEROS)} FROM reports WHERE REPORT_TYPE = 'FM-15'")
def _(spark, sf):
    return wx.select_reports(fx.reports(spark, sf).where(F.col("REPORT_TYPE") == "FM-15"))


HOURLY_OUT = ["time", "call_sign", *wx.MEASURES]


@query("weather_hourly", f"{ctes('hourly')} SELECT {cols(HOURLY_OUT, set(wx.MEASURES))} FROM hourly")
def _(spark, sf):
    return hourly(spark, sf)


@query("weather_hourly_null_sentinels", f"""{ctes('measured')} SELECT "time", call_sign, {r('avg(temp_f)','avg_temp_f')},
{r('sum(precip_mm)','tot_precip_mm')}, {r("avg(CASE WHEN wnd_raw <> '9999' THEN wnd_mps END)",'avg_wnd_mps')},
{r("avg(CASE WHEN vis_raw <> '999999' THEN vis_m END)",'avg_vis_m')}, {r('avg(slp_hpa)','avg_slp_hpa')},
{r('avg(dew_pt_f)','avg_dewpt_f')} FROM measured GROUP BY 1, 2""")
def _(spark, sf):
    return wx.hourly_weather(fx.reports(spark, sf), null_sentinels=True)


# --- silver ----------------------------------------------------------------

KEYED = ["FLIGHT_KEY", *SILVER_COLS]

for direction in ("dep", "arr"):
    @query(f"join_{direction}_weather", f"{ctes(direction)} SELECT {cols(KEYED)} FROM {direction}")
    def _(spark, sf, direction=direction):
        return silver(spark, sf, direction)

    @query(f"join_{direction}_weather_shuffled", f"{ctes(direction)} SELECT {cols(KEYED)} FROM {direction}")
    def _(spark, sf, direction=direction):
        join = {"dep": sv.silver_dep, "arr": sv.silver_arr}[direction]
        joined = join(bronze(spark, sf), sv.hourly_table(hourly(spark, sf)), limit=0)
        return sv.to_silver(joined, with_key=True)

    @query(f"join_{direction}_weather_bucketed", f"{ctes(direction)} SELECT {cols(KEYED)} FROM {direction}")
    def _(spark, sf, direction=direction):
        """Both sides in buckets, hours with more than 20 flights dealt over several."""
        keys = {"dep": ("sched_dep_hour", "ORIGIN"), "arr": ("sched_arr_hour", "DEST")}[direction]
        sides = sv.bucketed_sides(bronze(spark, sf), sv.scope_hours(hourly(spark, sf)), *keys, direction, buckets=8, most=20)
        return sv.to_silver(sv.attach_bucketed(*sides, *keys), with_key=True)

    @query(f"project_silver_{direction}", f"{ctes(direction)} SELECT {cols(SILVER_COLS)} FROM {direction}")
    def _(spark, sf, direction=direction):
        return silver(spark, sf, direction, with_key=False)


@query("avg_delay_temp_by_origin", f"""{ctes('dep')} SELECT ORIGIN_AIRPORT_ID, {r('avg(DEP_DELAY)','avg_dep_delay')},
{r('avg(avg_temp_f)','avg_temp_f')}, CAST(count(*) AS BIGINT) AS flights FROM dep GROUP BY 1""")
def flagship(spark, sf):
    return silver(spark, sf, "dep").groupBy("ORIGIN_AIRPORT_ID").agg(
        F.avg("DEP_DELAY").alias("avg_dep_delay"), F.avg("avg_temp_f").alias("avg_temp_f"),
        F.count(F.lit(1)).alias("flights"))
