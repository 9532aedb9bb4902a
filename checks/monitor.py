"""Queries of forecasting, monitoring, data validation and the registry."""

from pyspark.sql import functions as F

from checks.etl import KEYED, bronze, hourly, silver
from checks.explore import ORDER_SQL, histogram_sql, kind_of, stats_sql
from checks.registry import query
from checks.sql import MEASURE_COLS, NUMERIC_COLS, SILVER_COLS, cols, ctes, r
from checks import fixtures as fx
from skylag.operators import flights as fl
from skylag.operators import model as md
from skylag.operators import monitor as mon
from skylag.operators import profile as pf
from skylag.operators import quantiles as qt
from skylag.operators import relations
from skylag.operators import silver as sv
from skylag.operators import validate as vl
from skylag.operators.distributions import group_quantiles
from skylag.operators.weather import settled
from skylag.params import Params
from skylag.plans import forecast as fc
from skylag.session import new_path, stage
from skylag.sources import registry as rg

P = Params("JFK", "1996-01-01", "1999-12-31", "2001-08-01")
SERVE_SQL = "FL_DATE BETWEEN DATE '1999-12-31' AND DATE '2001-08-01'"
TRAIN_SQL = "FL_DATE BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"
JFK = "ORIGIN_AIRPORT_ID = 12478"

for d in ("dep", "arr"):
    @query(f"forecast_window_{d}", f"{ctes(d)} SELECT {cols(KEYED)} FROM {d} WHERE {JFK} AND {SERVE_SQL}")
    def _(spark, sf, d=d):
        return fc.forecast_input(silver(spark, sf, d), P)

    @query(f"training_window_{d}", f"{ctes(d)} SELECT {cols(KEYED)} FROM {d} WHERE {JFK} AND {TRAIN_SQL}")
    def _(spark, sf, d=d):
        return fc.training_input(silver(spark, sf, d), P)

    label, other = ("ARR_DELAY", "DEP_DELAY") if d == "arr" else ("DEP_DELAY", "ARR_DELAY")
    names = [c for c in SILVER_COLS if c not in ("FL_DATE", label)]

    @query(f"feature_frame_{d}", f"{ctes(d)} SELECT FLIGHT_KEY, {cols(names)} FROM {d}")
    def _(spark, sf, d=d, label=label):
        return md.feature_frame(silver(spark, sf, d), label, keep=["FLIGHT_KEY"])

    @query(f"feature_frame_int_{d}", f"{ctes(d)} SELECT FLIGHT_KEY, " + ", ".join(
        f'CAST(trunc("{c}") AS INT) AS "{c}"' for c in names) + f" FROM {d}")
    def _(spark, sf, d=d, label=label):
        return md.feature_frame(silver(spark, sf, d), label, cast_int=True, keep=["FLIGHT_KEY"])


@query("forecast_window_exclusive", f"{ctes('dep')} SELECT {cols(KEYED)} FROM dep WHERE {JFK} AND {SERVE_SQL} AND FL_DATE > DATE '1999-12-31'")
def _(spark, sf):
    return fc.forecast_input(silver(spark, sf, "dep"), P, inclusive_start=False)

# --- fixed predictor over both stages --------------------------------------------

PROD, STAGING = "DEP_DELAY * 0.9 + 1", "DEP_DELAY * 0.95"
SCORED_SQL = f"""scored AS (
SELECT *, {STAGING} AS yhat, 'staging' AS stage, ARR_DELAY - ({STAGING}) AS residual FROM dep
UNION ALL SELECT *, {PROD} AS yhat, 'prod' AS stage, ARR_DELAY - ({PROD}) AS residual FROM dep)"""
SCORED = f"{ctes('dep')}, {SCORED_SQL}"


def predicted(df, stage_name):
    expr = F.col("DEP_DELAY") * 0.95 if stage_name == mon.STAGING else F.col("DEP_DELAY") * 0.9 + 1
    return df.withColumn("yhat", expr)


def stacked(spark, sf):
    delay = F.col("DEP_DELAY")
    return mon.residuals_by_stage(
        silver(spark, sf, "dep"), "ARR_DELAY", {mon.STAGING: delay * 0.95, mon.PROD: delay * 0.9 + 1})


@query("eval_rmse", f"{SCORED} SELECT {r('sqrt(avg(pow(ARR_DELAY-yhat,2)))','rmse')} FROM scored WHERE stage='prod'")
def _(spark, sf):
    return md.rmse(predicted(silver(spark, sf, "dep"), mon.PROD), "ARR_DELAY")


@query("eval_evs_r2", f"""{SCORED} SELECT stage, {r('sqrt(avg(pow(ARR_DELAY-yhat,2)))','rmse')}, {r('1-var_pop(ARR_DELAY-yhat)/var_pop(ARR_DELAY)','explained_variance')},
{r('1-sum(pow(ARR_DELAY-yhat,2))/(var_pop(ARR_DELAY)*count(ARR_DELAY))','r2')}, CAST(count(*) AS BIGINT) AS n
FROM scored WHERE ARR_DELAY IS NOT NULL AND yhat IS NOT NULL GROUP BY stage""")
def _(spark, sf):
    return md.metrics(stacked(spark, sf), "ARR_DELAY", by=["stage"])


@query("align_residual", f"{SCORED} SELECT FLIGHT_KEY, {r('ARR_DELAY','ARR_DELAY')}, {r('yhat')}, {r('residual')} FROM scored WHERE stage='prod'")
def _(spark, sf):
    return mon.residuals(predicted(silver(spark, sf, "dep"), mon.PROD), "ARR_DELAY", mon.PROD).select(
        "FLIGHT_KEY", "ARR_DELAY", "yhat", "residual")


@query("residual_table", f"{SCORED} SELECT {cols(KEYED)}, {r('yhat')}, stage, {r('residual')} FROM scored")
def _(spark, sf):
    return stacked(spark, sf)


@query("union_stages", f"{SCORED} SELECT stage, CAST(count(*) AS BIGINT) AS n FROM scored GROUP BY 1")
def _(spark, sf):
    rows = stage(silver(spark, sf, "dep"), "silver")
    parts = [mon.residuals(predicted(rows, s), "ARR_DELAY", s) for s in (mon.STAGING, mon.PROD)]
    return mon.stack_stages(*parts).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@query("residual_density", f"""{SCORED} SELECT stage, {r('avg(CASE WHEN abs(residual)<=15 THEN 1.0 ELSE 0.0 END)','density')} FROM scored WHERE residual IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return mon.density_near_zero(stacked(spark, sf))


@query("promotion_decision", f"""{SCORED}, s AS (SELECT avg(CASE WHEN abs(residual)<=15 THEN 1.0 ELSE 0.0 END) FILTER (WHERE stage='staging') AS staging,
avg(CASE WHEN abs(residual)<=15 THEN 1.0 ELSE 0.0 END) FILTER (WHERE stage='prod') AS prod FROM scored WHERE residual IS NOT NULL)
SELECT {r('staging')}, {r('prod')}, CASE WHEN staging > prod THEN 'promote' ELSE 'retrain' END AS decision FROM s""")
def _(spark, sf):
    return mon.promotion_decision(stacked(spark, sf))


@query("ols_residual_by_stage", f"""{SCORED} SELECT stage, {r('regr_slope(residual,yhat)','slope')}, {r('regr_intercept(residual,yhat)','intercept')},
{r('regr_r2(residual,yhat)','r2')}, CAST(regr_count(residual,yhat) AS BIGINT) AS n FROM scored GROUP BY stage""")
def _(spark, sf):
    return relations.ols(stacked(spark, sf), "yhat", "residual", "stage")


QUARTS = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}


@query("residual_violin", f"{SCORED} SELECT stage, CAST(count(residual) AS BIGINT) AS n, " + ", ".join(
    r(f"quantile_cont(residual, {p})", n) for n, p in QUARTS.items()) + " FROM scored WHERE residual IS NOT NULL GROUP BY stage")
def _(spark, sf):
    return group_quantiles(stacked(spark, sf), "stage", "residual", QUARTS)


@query("residual_histogram", f"{SCORED} " + " UNION ALL ".join(
    histogram_sql("scored", "residual", f"stage = '{name}'", f"'{name}' AS stage") for name in ("staging", "prod")))
def _(spark, sf):
    rows = stage(stacked(spark, sf).select("stage", "residual"), "residuals")
    return qt.histograms(rows, ["residual"], by=["stage"])


def fill_expr(c):
    back = f'last_value("{c}" IGNORE NULLS) OVER ({ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'
    ahead = f'first_value("{c}" IGNORE NULLS) OVER ({ORDER_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)'
    return f'coalesce({back}, {ahead}) AS "{c}"'


FILLED = f"""{ctes('dep')}, f AS (SELECT FLIGHT_KEY, ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, FL_DATE, {', '.join(fill_expr(c) for c in NUMERIC_COLS if not c.endswith('AIRPORT_ID'))}
FROM dep WHERE {JFK} AND {SERVE_SQL})"""


@query("forecast_timeline", f"""{FILLED} SELECT {cols(KEYED)}, {r(STAGING,'yhat')}, 'Staging' AS model FROM f
UNION ALL SELECT {cols(KEYED)}, {r(PROD,'yhat')}, 'Production' AS model FROM f""")
def _(spark, sf):
    ready = fc.filled(fc.forecast_input(silver(spark, sf, "dep"), P))
    delay = F.col("DEP_DELAY")
    return fc.timeline(mon.by_stage(ready, {"Staging": delay * 0.95, "Production": delay * 0.9 + 1}, "model"))

# --- the airport's next hours -------------------------------------------------------

TIMES_SQL = """timed AS (SELECT *, CASE WHEN a < d THEN a + INTERVAL 1 DAY ELSE a END AS sched_arr, d AS sched_dep FROM (SELECT *,
CASE WHEN substr(CRS_DEP_TIME,1,2) < '24' THEN CAST(FL_DATE AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(substr(CRS_DEP_TIME,1,2) AS INT) + INTERVAL 1 MINUTE * CAST(substr(CRS_DEP_TIME,3,2) AS INT) END AS d,
CASE WHEN substr(CRS_ARR_TIME,1,2) < '24' THEN CAST(FL_DATE AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(substr(CRS_ARR_TIME,1,2) AS INT) + INTERVAL 1 MINUTE * CAST(substr(CRS_ARR_TIME,3,2) AS INT) END AS a
FROM flights))"""
MARK = "1997-07-10 12:00:00"

for name, hours in (("next_24h", 24), ("next_30_days", 720)):
    @query(name, f"""{ctes('flights')}, {TIMES_SQL} SELECT FLIGHT_KEY, ORIGIN, DEST, sched_dep, sched_arr,
CASE WHEN ORIGIN = 'JFK' AND sched_dep >= TIMESTAMP '{MARK}' AND sched_dep < TIMESTAMP '{MARK}' + INTERVAL {hours} HOUR THEN 'departure' ELSE 'arrival' END AS direction
FROM timed WHERE (ORIGIN = 'JFK' AND sched_dep >= TIMESTAMP '{MARK}' AND sched_dep < TIMESTAMP '{MARK}' + INTERVAL {hours} HOUR)
OR (DEST = 'JFK' AND sched_arr >= TIMESTAMP '{MARK}' AND sched_arr < TIMESTAMP '{MARK}' + INTERVAL {hours} HOUR)""")
    def _(spark, sf, hours=hours):
        return fc.next_hours(fx.flights(spark, sf), "JFK", MARK, hours).select(
            "FLIGHT_KEY", "ORIGIN", "DEST", "sched_dep", "sched_arr", "direction")


@query("inbound_in_flight", f"""{ctes('flights')}, {TIMES_SQL} SELECT FLIGHT_KEY, ORIGIN, DEST, sched_dep, sched_arr,
{r("date_diff('minute', sched_dep, sched_arr) + ARR_DELAY - DEP_DELAY",'duration_min')} FROM timed
WHERE DEST = 'JFK' AND sched_dep + INTERVAL 1 MINUTE * CAST(DEP_DELAY AS INT) < TIMESTAMP '{MARK}'
AND sched_arr + INTERVAL 1 MINUTE * CAST(coalesce(ARR_DELAY, 0) AS INT) >= TIMESTAMP '{MARK}'""")
def _(spark, sf):
    return fc.in_flight(fx.flights(spark, sf), "JFK", MARK).select(
        "FLIGHT_KEY", "ORIGIN", "DEST", "sched_dep", "sched_arr", "duration_min")


# A mark at noon of the first day of every month at every airport that flights reach.
MARKS_SQL = "marks AS (SELECT DISTINCT DEST AS airport, date_trunc('month', FL_DATE) + INTERVAL 12 HOUR AS mark FROM flights)"


def marks_of(flights):
    return flights.select(F.col("DEST").alias("airport"), (F.trunc("FL_DATE", "month").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOUR")).alias("mark")).distinct()


@query("next_24h_marks", f"""{ctes('flights')}, {TIMES_SQL}, {MARKS_SQL} SELECT airport, mark, FLIGHT_KEY, sched_dep, sched_arr,
CASE WHEN ORIGIN = airport AND sched_dep >= mark AND sched_dep < mark + INTERVAL 24 HOUR THEN 'departure' ELSE 'arrival' END AS direction
FROM timed JOIN marks ON (ORIGIN = airport AND sched_dep >= mark AND sched_dep < mark + INTERVAL 24 HOUR)
OR (DEST = airport AND sched_arr >= mark AND sched_arr < mark + INTERVAL 24 HOUR)""")
def _(spark, sf):
    flights = fx.flights(spark, sf)
    return fc.next_hours_at(flights, marks_of(flights)).select("airport", "mark", "FLIGHT_KEY", "sched_dep", "sched_arr", "direction")


@query("in_flight_marks", f"""{ctes('flights')}, {TIMES_SQL}, {MARKS_SQL} SELECT airport, mark, FLIGHT_KEY, sched_dep, sched_arr,
{r("date_diff('minute', sched_dep, sched_arr) + ARR_DELAY - DEP_DELAY",'duration_min')} FROM timed JOIN marks ON DEST = airport
WHERE sched_dep + INTERVAL 1 MINUTE * CAST(DEP_DELAY AS INT) < mark AND sched_arr + INTERVAL 1 MINUTE * CAST(coalesce(ARR_DELAY, 0) AS INT) >= mark""")
def _(spark, sf):
    flights = fx.flights(spark, sf)
    return fc.in_flight_at(flights, marks_of(flights)).select("airport", "mark", "FLIGHT_KEY", "sched_dep", "sched_arr", "duration_min")


# Every flight at one airport on one of ten days round the mark, delays up to hours both ways.
CROWD_SQL = """crowd AS (SELECT * REPLACE (DATE '1997-07-05' + CAST(FLIGHT_KEY % 10 AS INT) AS FL_DATE, 'JFK' AS DEST,
CAST(FLIGHT_KEY * 7 % 400 - 100 AS DOUBLE) AS DEP_DELAY, CASE WHEN FLIGHT_KEY % 5 > 0 THEN CAST(FLIGHT_KEY * 11 % 3000 - 120 AS DOUBLE) END AS ARR_DELAY) FROM flights)"""
CROWD_MARK = "1997-07-10 23:50:00"


def crowd(spark, sf):
    key = F.col("FLIGHT_KEY")
    return fx.flights(spark, sf).withColumns({
        "FL_DATE": F.date_add(F.lit("1997-07-05").cast("date"), (key % 10).cast("int")), "DEST": F.lit("JFK"),
        "DEP_DELAY": (key * 7 % 400 - 100).cast("double"), "ARR_DELAY": F.when(key % 5 > 0, (key * 11 % 3000 - 120).cast("double"))})


@query("inbound_near_midnight", f"""{ctes('flights')}, {CROWD_SQL}, {TIMES_SQL.replace('FROM flights', 'FROM crowd')} SELECT FLIGHT_KEY, sched_dep, sched_arr,
{r("date_diff('minute', sched_dep, sched_arr) + ARR_DELAY - DEP_DELAY",'duration_min')} FROM timed
WHERE sched_dep + INTERVAL 1 MINUTE * CAST(DEP_DELAY AS INT) < TIMESTAMP '{CROWD_MARK}'
AND sched_arr + INTERVAL 1 MINUTE * CAST(coalesce(ARR_DELAY, 0) AS INT) >= TIMESTAMP '{CROWD_MARK}'""")
def _(spark, sf):
    """Flights of the next day that left early, and flights that are days late."""
    return fc.in_flight(crowd(spark, sf), "JFK", CROWD_MARK).select("FLIGHT_KEY", "sched_dep", "sched_arr", "duration_min")

@query("in_flight_marks_crowd", f"""{ctes('flights')}, {CROWD_SQL}, {TIMES_SQL.replace('FROM flights', 'FROM crowd')},
marks AS (SELECT TIMESTAMP '1997-07-01 00:00:00' + INTERVAL 1 HOUR * CAST(h AS INT) AS mark FROM range(480) t(h)) SELECT mark, CAST(count(*) AS BIGINT) AS flights
FROM timed JOIN marks ON sched_dep + INTERVAL 1 MINUTE * CAST(DEP_DELAY AS INT) < mark AND sched_arr + INTERVAL 1 MINUTE * CAST(coalesce(ARR_DELAY, 0) AS INT) >= mark GROUP BY 1""")
def _(spark, sf):
    """Every hour of twenty days at one airport, with flights that are days late."""
    marks = spark.range(480).select(F.lit("JFK").alias("airport"), (
        F.lit("1997-07-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("mark"))
    return fc.in_flight_at(crowd(spark, sf), marks).groupBy("mark").agg(F.count(F.lit(1)).alias("flights"))

# --- data validation -------------------------------------------------------------------

STATS = ["n", "missing", "distinct_values", "zeros", "mean", "std", "min", "q25", "median", "q75", "max", "top_value", "type"]


def compare_sql(left, right, lname, rname):
    sides = []
    for table in (left, right):
        sides.append(" UNION ALL ".join(f"SELECT * FROM ({stats_sql(table, c, kind_of(c))})" for c in NUMERIC_COLS))
    out = ", ".join([f'l."{c}" AS "{lname}_{c}"' for c in STATS] + [f'rr."{c}" AS "{rname}_{c}"' for c in STATS])
    return f"SELECT l.feature AS feature, {out} FROM ({sides[0]}) l FULL JOIN ({sides[1]}) rr ON l.feature = rr.feature"


def settled_silver(spark, sf, d="dep"):
    return settled(silver(spark, sf, d), MEASURE_COLS)


@query("train_eval_compare", f"""{ctes('dep6')}, tr AS (SELECT * FROM dep6 WHERE FLIGHT_KEY % 1000 < 700),
ev AS (SELECT * FROM dep6 WHERE FLIGHT_KEY % 1000 >= 700 AND FLIGHT_KEY % 1000 < 850) {compare_sql('ev','tr','eval','train')}""")
def _(spark, sf):
    from skylag.operators.split import TRAIN_EVAL_SERVE, modulus_split

    parts = modulus_split(stage(settled_silver(spark, sf), "silver"), "FLIGHT_KEY", TRAIN_EVAL_SERVE)
    stats = {p: pf.numeric_stats(parts.where(F.col("part") == p), NUMERIC_COLS) for p in ("eval", "train")}
    return vl.compare_stats(stats["eval"], stats["train"], ("eval", "train"))


@query("train_serve_compare", f"""{ctes('dep6')}, tr AS (SELECT * FROM dep6 WHERE {TRAIN_SQL}), sv AS (SELECT * FROM dep6 WHERE {SERVE_SQL})
{compare_sql('sv','tr','serve','train')}""")
def _(spark, sf):
    rows = stage(settled_silver(spark, sf), "silver")
    serve = fl.between_closed(rows, "FL_DATE", P.training_end, P.inference_date)
    train = fl.between_closed(rows, "FL_DATE", P.training_start, P.training_end)
    return vl.compare_stats(
        pf.numeric_stats(serve, NUMERIC_COLS), pf.numeric_stats(train, NUMERIC_COLS), ("serve", "train"))


SCHEMA_COLS = ["FL_DATE", "CRS_DEP_TIME", "DEP_DELAY", "ARR_DELAY", "ORIGIN", "DEST", "YEAR", "OP_UNIQUE_CARRIER"]


def schema_sql(table, columns):
    parts = []
    for c in columns:
        kind = "BYTES" if c in ("FL_DATE", "CRS_DEP_TIME", "ORIGIN", "DEST", "OP_UNIQUE_CARRIER") else kind_of(c)
        size = f"CAST(count(DISTINCT {c}) AS BIGINT)" if kind == "BYTES" else "CAST(NULL AS BIGINT)"
        parts.append(f"""SELECT '{c}' AS feature, '{kind}' AS "type", CASE WHEN count(*) = count({c}) THEN 'required' ELSE 'optional' END AS presence,
{r(f'count({c})*1.0/count(*)','min_fraction')}, {size} AS n_values FROM {table}""")
    return " UNION ALL ".join(parts)


@query("infer_schema", f"{ctes('clean')} {schema_sql('clean', SCHEMA_COLS)}")
def _(spark, sf):
    return vl.infer_schema(bronze(spark, sf).select(*SCHEMA_COLS))


@query("schema_domains", f"{ctes('clean')} " + " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS feature, CAST({c} AS VARCHAR) AS \"value\" FROM clean WHERE {c} IS NOT NULL"
    for c in ("FL_DATE", "CRS_DEP_TIME", "ORIGIN", "DEST", "OP_UNIQUE_CARRIER")))
def _(spark, sf):
    return vl.domains(bronze(spark, sf).select(*SCHEMA_COLS))


@query("validate_many_values", f"""{ctes('flights')}, late AS (SELECT CAST(FL_DATE AS VARCHAR) AS d FROM flights WHERE "YEAR" >= 1997),
known AS (SELECT DISTINCT CAST(FL_DATE AS VARCHAR) AS d FROM flights WHERE "YEAR" <= 1997)
SELECT 'FL_DATE' AS feature, 'out_of_domain' AS anomaly, concat(count(DISTINCT CASE WHEN d NOT IN (SELECT d FROM known) THEN d END), ' values') AS detail,
{r("count(*) FILTER (WHERE d NOT IN (SELECT d FROM known))*1.0/count(*)", 'share')} FROM late""")
def _(spark, sf):
    """Hundreds of known dates, and later ones that are not."""
    days = fx.flights(spark, sf).select(F.col("FL_DATE").cast("string").alias("FL_DATE"), "YEAR")
    known = days.where("YEAR <= 1997").select("FL_DATE")
    return vl.validate(days.where("YEAR >= 1997").select("FL_DATE"), vl.infer_schema(known), vl.domains(known))


@query("validate_stats", f"""{ctes('clean')}, served AS (SELECT * FROM flights),
o AS (SELECT ORIGIN AS x FROM served), e AS (SELECT DEST AS x FROM served), n AS (SELECT count(*) AS n FROM served)
SELECT 'ORIGIN' AS feature, 'out_of_domain' AS anomaly, concat(count(DISTINCT x), ' values') AS detail, {r('count(*)*1.0/(SELECT n FROM n)','share')}
FROM o WHERE x NOT IN (SELECT ORIGIN FROM clean)
UNION ALL SELECT 'DEST', 'out_of_domain', concat(count(DISTINCT x), ' values'), {r('count(*)*1.0/(SELECT n FROM n)','share')}
FROM e WHERE x NOT IN (SELECT DEST FROM clean)
UNION ALL SELECT 'CRS_DEP_TIME', 'presence_dropped', 'missing values', {r("count(*) FILTER (WHERE CRS_DEP_TIME >= '24')*1.0/count(*)",'share')} FROM served
UNION ALL SELECT 'YEAR', 'type_changed', 'INT to BYTES', 1.0
UNION ALL SELECT 'OP_UNIQUE_CARRIER', 'column_missing', 'BYTES', 1.0
UNION ALL SELECT 'QUARTER', 'column_new', 'INT', 1.0""")
def _(spark, sf):
    seen = bronze(spark, sf).select(*[c for c in SCHEMA_COLS if c != "FL_DATE"])
    served = fx.flights(spark, sf).select(
        F.when(F.col("CRS_DEP_TIME") < "24", F.col("CRS_DEP_TIME")).alias("CRS_DEP_TIME"), "DEP_DELAY", "ARR_DELAY",
        "ORIGIN", "DEST", F.col("YEAR").cast("string").alias("YEAR"), "QUARTER")
    return vl.validate(served, vl.infer_schema(seen), vl.domains(seen))


def jsd_sql(a, b, feature, bins=10):
    v = f'CAST("{feature}" AS DOUBLE)'
    return f"""SELECT '{feature}' AS feature, {r('0.5*sum(CASE WHEN p>0 THEN p*log2(p/((p+q)/2)) ELSE 0 END)+0.5*sum(CASE WHEN q>0 THEN q*log2(q/((p+q)/2)) ELSE 0 END)','jsd')} FROM (
SELECT least(floor((v-lo)/((hi-lo)/{bins})),{bins - 1}) AS bin, count(*) FILTER (WHERE s='a')*1.0/max(na) AS p, count(*) FILTER (WHERE s='b')*1.0/max(nb) AS q
FROM (SELECT *, min(v) OVER () AS lo, max(v) OVER () AS hi, count(*) FILTER (WHERE s='a') OVER () AS na, count(*) FILTER (WHERE s='b') OVER () AS nb
 FROM (SELECT 'a' AS s, {v} AS v FROM {a} UNION ALL SELECT 'b', {v} FROM {b}) WHERE v IS NOT NULL) GROUP BY 1)"""


SPANS = f"{ctes('dep6')}, tr AS (SELECT * FROM dep6 WHERE {TRAIN_SQL}), sv AS (SELECT * FROM dep6 WHERE {SERVE_SQL})"


def spans(spark, sf, airport=False):
    rows = stage(settled_silver(spark, sf), "silver")
    if airport:
        return fc.training_input(rows, P), fc.forecast_input(rows, P)
    return (fl.between_closed(rows, "FL_DATE", P.training_start, P.training_end),
            fl.between_closed(rows, "FL_DATE", P.training_end, P.inference_date))


@query("jsd_numeric", f"{SPANS} {' UNION ALL '.join(jsd_sql('tr', 'sv', c) for c in NUMERIC_COLS)}")
def _(spark, sf):
    return vl.jsd(*spans(spark, sf), NUMERIC_COLS)


@query("skew_check", f"""{ctes('dep6')}, tr AS (SELECT * FROM dep6 WHERE {JFK} AND {TRAIN_SQL}), sv AS (SELECT * FROM dep6 WHERE {JFK} AND {SERVE_SQL})
SELECT feature, 'skew' AS "check", jsd, CAST(0 AS DOUBLE) + 1e-9 - 1e-9 AS threshold, jsd > 0 AS anomaly FROM ({' UNION ALL '.join(jsd_sql('tr', 'sv', c) for c in vl.WATCHED)})""")
def _(spark, sf):
    return vl.skew_check(*spans(spark, sf, airport=True))


ONE_DAY = """one AS (SELECT * FROM dep6 WHERE FL_DATE = (SELECT max(FL_DATE) FROM dep6))"""


@query("skew_check_one_day", f"""{ctes('dep6')}, {ONE_DAY}, tr AS (SELECT * FROM dep6)
SELECT feature, 'skew' AS "check", jsd, CAST(0 AS DOUBLE) AS threshold, jsd > 0 AS anomaly FROM ({' UNION ALL '.join(jsd_sql('tr', 'one', c) for c in vl.WATCHED)})""")
def _(spark, sf):
    """Serving data of a single day, where the day of the week is constant."""
    rows = stage(settled_silver(spark, sf), "silver")
    last = rows.agg(F.max("FL_DATE")).first()[0]
    return vl.skew_check(rows, rows.where(F.col("FL_DATE") == F.lit(last)))


@query("drift_check", f"""{ctes('dep6')}, tr AS (SELECT * FROM dep6 WHERE FL_DATE BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'),
sv AS (SELECT * FROM dep6 WHERE FL_DATE BETWEEN DATE '1997-01-01' AND DATE '1997-12-31')
SELECT feature, 'drift' AS "check", jsd, CAST(0 AS DOUBLE) AS threshold, jsd > 0 AS anomaly FROM ({' UNION ALL '.join(jsd_sql('tr', 'sv', c) for c in vl.WATCHED)})""")
def _(spark, sf):
    rows = stage(settled_silver(spark, sf), "silver")
    return vl.drift_check(
        fl.between_closed(rows, "FL_DATE", "1998-01-01", "1998-12-31"),
        fl.between_closed(rows, "FL_DATE", "1997-01-01", "1997-12-31"))

def drift_sql(table, feature, span='"YEAR"', bins=10):
    v = f'CAST("{feature}" AS DOUBLE)'
    return f"""SELECT span, previous, '{feature}' AS feature, {r('0.5*sum(CASE WHEN p>0 THEN p*log2(p/((p+q)/2)) ELSE 0 END)+0.5*sum(CASE WHEN q>0 THEN q*log2(q/((p+q)/2)) ELSE 0 END)','jsd')} FROM (
WITH v AS (SELECT {span} AS span, {v} AS v FROM {table} WHERE {v} IS NOT NULL), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
b AS (SELECT span, least(floor((v-lo)/((hi-lo)/{bins})),{bins - 1}) AS bin, count(*) AS n FROM v, e GROUP BY 1, 2),
s AS (SELECT span, bin, n*1.0/sum(n) OVER (PARTITION BY span) AS share FROM b),
o AS (SELECT span, lag(span) OVER (ORDER BY span) AS previous FROM (SELECT DISTINCT span FROM s))
SELECT o.span, o.previous, coalesce(x.share, 0) AS p, coalesce(y.share, 0) AS q FROM o CROSS JOIN (SELECT DISTINCT bin FROM s) k
LEFT JOIN s x ON x.span = o.span AND x.bin = k.bin LEFT JOIN s y ON y.span = o.previous AND y.bin = k.bin WHERE o.previous IS NOT NULL) GROUP BY 1, 2"""


@query("drift_by_span", f"""{ctes('dep6')} SELECT span, previous, feature, jsd, CAST(0 AS DOUBLE) AS threshold, jsd > 0 AS anomaly
FROM ({' UNION ALL '.join(drift_sql('dep6', c) for c in vl.WATCHED)})""")
def _(spark, sf):
    rows = stage(settled_silver(spark, sf).select("YEAR", *vl.WATCHED), "silver")
    return vl.drift_by_span(rows, "YEAR")

# --- registry: versions and transitions derived from the event table --------------------

NAME = "concat('model_', CAST(user_id % 20 AS VARCHAR))"
STAGE_SQL = "CASE event_type WHEN 'click' THEN 'Staging' WHEN 'signup' THEN 'Staging' WHEN 'purchase' THEN 'Production' WHEN 'error' THEN 'Archived' ELSE 'None' END"
TRANS_SQL = f"WITH t AS (SELECT {NAME} AS name, CAST(1 + event_id % 5 AS INT) AS version, {STAGE_SQL} AS stage, ts FROM events)"
CUR_SQL = "cur AS (SELECT name, version, stage, ts FROM (SELECT *, row_number() OVER (PARTITION BY name, version ORDER BY ts DESC, stage DESC) AS k FROM t) WHERE k = 1)"


def model_name():
    return F.concat(F.lit("model_"), (F.col("user_id") % 20).cast("string"))


def transitions(spark, sf):
    kind = F.col("event_type")
    return fx.read(spark, sf, "events").select(
        model_name().alias("name"), (1 + F.col("event_id") % 5).cast("int").alias("version"),
        F.when(kind.isin("click", "signup"), rg.STAGING).when(kind == "purchase", rg.PRODUCTION)
        .when(kind == "error", rg.ARCHIVED).otherwise(rg.NONE).alias("stage"), "ts")


def runs_of(spark, sf, kind):
    return fx.read(spark, sf, "events").where(F.col("event_type") == kind).select(
        model_name().alias("name"), F.concat(F.lit("run_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("run_id"), "ts")


RUN_SQL = f"SELECT {NAME} AS name, concat('run_', lpad(CAST(event_id AS VARCHAR), 12, '0')) AS run_id, ts FROM events WHERE event_type"


@query("register_version", f"""WITH old AS ({RUN_SQL} = 'signup'), new AS ({RUN_SQL} = 'purchase')
SELECT new.name, CAST(coalesce(l, 0) + row_number() OVER (PARTITION BY new.name ORDER BY ts, run_id) AS INT) AS version, run_id, ts
FROM new LEFT JOIN (SELECT name, count(*) AS l FROM old GROUP BY 1) o ON o.name = new.name""")
def _(spark, sf):
    versions = rg.register_versions(
        spark.createDataFrame([], rg.VERSION_SCHEMA), runs_of(spark, sf, "signup"))
    return rg.register_versions(versions, runs_of(spark, sf, "purchase"))


@query("current_stages", f"{TRANS_SQL}, {CUR_SQL} SELECT * FROM cur")
def _(spark, sf):
    return rg.current_stages(transitions(spark, sf))


for st in (rg.STAGING, rg.PRODUCTION):
    @query(f"stage_lookup_{st.lower()}", f"""{TRANS_SQL}, {CUR_SQL} SELECT name, version FROM
(SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts DESC, version DESC) AS k FROM cur WHERE stage = '{st}') WHERE k = 1""")
    def _(spark, sf, st=st):
        return rg.version_in_stage(transitions(spark, sf), st)


@query("promote", f"""{TRANS_SQL}, {CUR_SQL}, pick AS (SELECT name, version, stage FROM
(SELECT *, row_number() OVER (PARTITION BY name, stage ORDER BY ts DESC, version DESC) AS k FROM cur WHERE stage IN ('Staging','Production')) WHERE k = 1),
pair AS (SELECT s.name, s.version AS new_v, p.version AS old_v FROM pick s JOIN pick p ON s.name = p.name AND s.stage = 'Staging' AND p.stage = 'Production')
SELECT cur.name, cur.version, CASE WHEN cur.version = new_v THEN 'Production' WHEN cur.version = old_v THEN 'Archived' ELSE stage END AS stage
FROM cur LEFT JOIN pair ON pair.name = cur.name""")
def _(spark, sf):
    path = new_path(spark, "transitions")
    transitions(spark, sf).write.parquet(path)
    rg.promote(spark, path, "2030-01-01 00:00:00", asked=True)
    return rg.current_stages(spark.read.parquet(path)).drop("ts")


@query("run_log", f"""{SCORED} SELECT concat('origin_', CAST(ORIGIN_AIRPORT_ID AS VARCHAR), '_', stage) AS run_id, 'metric' AS kind, 'n' AS key,
CAST(count(*) AS VARCHAR) AS value FROM scored WHERE ARR_DELAY IS NOT NULL AND yhat IS NOT NULL GROUP BY ORIGIN_AIRPORT_ID, stage""")
def _(spark, sf):
    path = new_path(spark, "runs")
    sizes = md.metrics(stacked(spark, sf), "ARR_DELAY", by=["ORIGIN_AIRPORT_ID", "stage"])
    rg.log_rows(sizes.select(
        F.concat_ws("_", F.lit("origin"), F.col("ORIGIN_AIRPORT_ID").cast("string"), "stage").alias("run_id"),
        F.lit("metric").alias("kind"), F.lit("n").alias("key"), F.col("n").cast("string").alias("value")), path)
    return rg.read_runs(spark, path).drop("ts")


@query("dataset_version", f"""{ctes('dep')} SELECT CAST(count(*) AS BIGINT) AS n_rows, min(FL_DATE) AS min_date, max(FL_DATE) AS max_date FROM dep""")
def _(spark, sf):
    return rg.dataset_fingerprint(silver(spark, sf, "dep")).drop("content_hash")


@query("dataset_fingerprint")
def _(spark, sf):
    return rg.dataset_fingerprint(bronze(spark, sf))


@query("stats_compare", f"""{ctes('dep6', 'arr6')} {compare_sql('dep6','arr6','dep','arr')}""")
def _(spark, sf):
    hours = sv.hourly_table(hourly(spark, sf))
    both = {d: pf.numeric_stats(settled(silver(spark, sf, d, hours=hours), MEASURE_COLS), NUMERIC_COLS) for d in ("dep", "arr")}
    return vl.compare_stats(both["dep"], both["arr"], ("dep", "arr"))
