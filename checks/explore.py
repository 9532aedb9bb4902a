"""Queries of the exploration: grouped summaries, distributions, relations, statistics."""

from pyspark.sql import functions as F

from checks.etl import DELAYS, KEYED, bronze, hourly, silver, silver_table
from checks.registry import query
from checks.sql import MEASURE_COLS, NUMERIC_COLS, SILVER_COLS, SILVER_DOUBLES, cols, ctes, r
from checks import fixtures as fx
from skylag.functions import airports, status
from skylag.operators import distributions as ds
from skylag.operators import explore as ex
from skylag.operators import flights as fl
from skylag.operators import nulls, ordered, relations
from skylag.operators import profile as pf
from skylag.operators import quantiles as qt
from skylag.operators import split as sp
from skylag.operators.weather import settled
from skylag.session import stage
from skylag.sources import tables as tb

# --- grouped delays over bronze flights -------------------------------------

for name, key in (("delay_by_dow", "DAY_OF_WEEK"), ("delay_by_origin", "ORIGIN"), ("delay_by_dest", "DEST")):
    @query(name, f"{ctes('clean')} SELECT {key}, {r('avg(ARR_DELAY)','avg_arr_delay')}, {r('avg(DEP_DELAY)','avg_dep_delay')} FROM clean GROUP BY {key}")
    def _(spark, sf, key=key):
        return ex.avg_delay_by(bronze(spark, sf), key).orderBy(key)

    @query(f"sort_within_{name}", f"{ctes('clean')} SELECT {key}, {r('avg(ARR_DELAY)','avg_arr_delay')}, {r('avg(DEP_DELAY)','avg_dep_delay')} FROM clean GROUP BY {key}")
    def _(spark, sf, key=key):
        return ex.avg_delay_by(bronze(spark, sf), key).sortWithinPartitions(key)


@query("max_delay", f"{ctes('clean')} SELECT {r('max(DEP_DELAY)','max_dep_delay')} FROM clean")
def _(spark, sf):
    return ex.max_of(bronze(spark, sf), "DEP_DELAY", "max_dep_delay")


for side, col in (("origins", "ORIGIN_AIRPORT_ID"), ("dests", "DEST_AIRPORT_ID")):
    @query(f"carrier_{side}")
    def _(spark, sf, col=col, side=side):
        return ex.approx_airports(bronze(spark, sf), col, side)

    @query(f"carrier_{side}_exact", f"{ctes('clean')} SELECT OP_UNIQUE_CARRIER, CAST(count(DISTINCT {col}) AS BIGINT) AS {side} FROM clean GROUP BY 1")
    def _(spark, sf, col=col, side=side):
        return ex.exact_airports(bronze(spark, sf), col, side)

# --- hourly weather ----------------------------------------------------------

for name, col in (("temp", "avg_temp_f"), ("precip", "tot_precip_mm"), ("wind", "avg_wnd_mps")):
    for kind, agg, fn in (("", "sum", ex.monthly_mean_of_sums), ("_mean", "avg", ex.monthly_mean_of_means)):
        @query(f"monthly_{name}{kind}", f"""{ctes('hourly')} SELECT m AS "month", {r('avg(v)','value')} FROM
(SELECT CAST(month("time") AS INT) AS m, year("time") AS y, {agg}({col}) AS v FROM hourly GROUP BY 1, 2) GROUP BY 1""")
        def _(spark, sf, col=col, fn=fn):
            return fn(hourly(spark, sf), col, "value")


@query("month_year", f"""{ctes('reports')} SELECT "DATE", CAST(month("DATE") AS INT) AS "month", CAST(year("DATE") AS INT) AS "year" FROM reports""")
def _(spark, sf):
    return fx.reports(spark, sf).select("DATE", F.month("DATE").alias("month"), F.year("DATE").alias("year"))


def stats_sql(table, column, kind):
    """Numeric statistics of one column."""
    v = f'CAST("{column}" AS DOUBLE)'
    return f"""SELECT '{column}' AS feature, CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count({v}) AS BIGINT) AS missing,
CAST(count(DISTINCT {v}) AS BIGINT) AS distinct_values, CAST(count(*) FILTER (WHERE {v} = 0) AS BIGINT) AS zeros,
{r(f'avg({v})','mean')}, {r(f'stddev_samp({v})','std')}, {r(f'min({v})','min')}, {r(f'quantile_cont({v}, 0.25)','q25')},
{r(f'quantile_cont({v}, 0.5)','median')}, {r(f'quantile_cont({v}, 0.75)','q75')}, {r(f'max({v})','max')},
(SELECT {r('x', 'x')} FROM (SELECT {v} AS x, count(*) AS c FROM {table} WHERE {v} IS NOT NULL GROUP BY 1) ORDER BY c DESC, x LIMIT 1) AS top_value,
'{kind}' AS "type" FROM {table}"""


def text_sql(table, column):
    v = f'CAST("{column}" AS VARCHAR)'
    top = f"(SELECT {v} AS x, count(*) AS c FROM {table} WHERE {v} IS NOT NULL GROUP BY 1)"
    return f"""SELECT '{column}' AS feature, CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count({v}) AS BIGINT) AS missing,
CAST(count(DISTINCT {v}) AS BIGINT) AS distinct_values, {r(f'avg(length({v}))','avg_length')},
(SELECT x FROM {top} ORDER BY c DESC, x LIMIT 1) AS top_text, CAST((SELECT max(c) FROM {top}) AS BIGINT) AS top_n, 'BYTES' AS "type" FROM {table}"""


def kind_of(c):
    return "FLOAT" if c in SILVER_DOUBLES | {"DEP_TIME"} else "INT"


def histogram_sql(table, column, where="TRUE", by="", buckets=10):
    """Equal-width and quantile histogram of one column; ``by`` is a list of more output columns."""
    v, extra = f'CAST("{column}" AS DOUBLE)', f"{by}, " if by else ""
    t = f"(SELECT {v} AS v FROM {table} WHERE {where} AND {v} IS NOT NULL)"
    ends = f"(SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS a, CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS z FROM {t})"
    cuts = ", ".join(str(i / buckets) for i in range(buckets + 1))
    return f"""SELECT {extra}'{column}' AS feature, 'STANDARD' AS kind, CAST(i AS INT) AS bucket, {r(f'a+i*((z-a)/{buckets})','lo')}, {r(f'a+(i+1)*((z-a)/{buckets})','hi')},
CAST(coalesce(k, 0) AS DOUBLE) AS n FROM range({buckets}) g(i) CROSS JOIN {ends} e LEFT JOIN
(SELECT least(floor((v-a)/((z-a)/{buckets})), {buckets - 1}) AS b, count(*) AS k FROM {t}, {ends} GROUP BY 1) c ON b = i WHERE a IS NOT NULL
UNION ALL SELECT {extra}'{column}' AS feature, 'QUANTILES' AS kind, CAST(i AS INT) AS bucket, {r('q[i+1]','lo')}, {r('q[i+2]','hi')}, {r(f'n/{buckets}.0','n')}
FROM (SELECT quantile_cont(v, [{cuts}]) AS q, count(*) AS n FROM {t}), range({buckets}) g(i) WHERE n > 0"""


def summary_sql(table, columns):
    return " UNION ALL ".join(
        f"""SELECT feature, n - missing AS "count", mean, std AS stddev, "min", q25, median, q75, "max" FROM ({stats_sql(table, c, kind_of(c))})"""
        for c in columns)


@query("summary_stats", f"{ctes('hourly')} {summary_sql('hourly', MEASURE_COLS)}")
def _(spark, sf):
    return pf.summary(hourly(spark, sf), MEASURE_COLS)


@query("column_subset", f"{ctes('hourly')} SELECT {cols(MEASURE_COLS)} FROM hourly")
def _(spark, sf):
    return hourly(spark, sf).select(*MEASURE_COLS)


@query("weather_feature_stats", f"{ctes('hourly6')} {' UNION ALL '.join(stats_sql('hourly6', c, 'FLOAT') for c in MEASURE_COLS)}")
def _(spark, sf):
    return pf.numeric_stats(settled(hourly(spark, sf), MEASURE_COLS), MEASURE_COLS)

# --- silver, both directions ---------------------------------------------------

DEST_CODE = "CASE {c} " + " ".join(f"WHEN {i} THEN '{a}'" for a, i in airports.AIRPORT_IDS.items()) + " ELSE CAST({c} AS VARCHAR) END"

for d in ("dep", "arr"):
    base = ctes(d)

    @query(f"id_to_code_{d}", f"""{base} SELECT FLIGHT_KEY, {DEST_CODE.format(c='ORIGIN_AIRPORT_ID')} AS ORIGIN_AIRPORT_ID,
{DEST_CODE.format(c='DEST_AIRPORT_ID')} AS DEST_AIRPORT_ID FROM {d}""")
    def _(spark, sf, d=d):
        return airports.id_to_code(silver(spark, sf, d), ["ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID"]).select(
            "FLIGHT_KEY", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID")

    for side in ("origin", "dest"):
        col = f"{side.upper()}_AIRPORT_ID"

        @query(f"avg_dep_delay_by_{side}_{d}", f"""{base} SELECT {DEST_CODE.format(c=col)} AS {col}, {r('avg(DEP_DELAY)','avg_dep_delay')} FROM {d} GROUP BY 1""")
        def _(spark, sf, d=d, col=col):
            return ex.avg_by(airports.id_to_code(silver(spark, sf, d), [col]), col, "DEP_DELAY", "avg_dep_delay")

        @query(f"flights_per_{side}_{d}", f"""{base} SELECT {DEST_CODE.format(c=col)} AS {col}, CAST(count(*) AS BIGINT) AS flights FROM {d} GROUP BY 1""")
        def _(spark, sf, d=d, col=col):
            return ex.count_by(airports.id_to_code(silver(spark, sf, d), [col]), col)

        val = "DEP_DELAY" if side == "origin" else "ARR_DELAY"

        @query(f"box_{side}_{d}", f"""{base}, k AS (SELECT {DEST_CODE.format(c=col)} AS {col}, {val} AS v FROM {d} WHERE {val} IS NOT NULL),
q AS (SELECT {col}, quantile_cont(v,0.25) AS q1, quantile_cont(v,0.5) AS median, quantile_cont(v,0.75) AS q3 FROM k GROUP BY 1)
SELECT {col}, {r('q1')}, {r('median')}, {r('q3')},
{r('min(v) FILTER (WHERE v BETWEEN q1-1.5*(q3-q1) AND q3+1.5*(q3-q1))','whisker_lo')},
{r('max(v) FILTER (WHERE v BETWEEN q1-1.5*(q3-q1) AND q3+1.5*(q3-q1))','whisker_hi')},
CAST(count(*) FILTER (WHERE NOT (v BETWEEN q1-1.5*(q3-q1) AND q3+1.5*(q3-q1))) AS BIGINT) AS outliers
FROM k JOIN q USING ({col}) GROUP BY {col}, q1, median, q3""")
        def _(spark, sf, d=d, col=col, val=val):
            return ds.box_stats(airports.id_to_code(silver(spark, sf, d), [col]), col, val)

    for name, key, val in (("mean_temp_by_month", "MONTH", "avg_temp_f"), ("mean_dew_by_month", "MONTH", "avg_dewpt_f"),
                           ("mean_temp_by_hour", "hour", "avg_temp_f")):
        k_out = r('"hour"', "hour") if key == "hour" else '"MONTH"'

        @query(f"{name}_{d}", f"""{base} SELECT {k_out}, {r(f'avg({val})','mean_value')} FROM {d}
WHERE "{key}" IS NOT NULL GROUP BY "{key}" """)
        def _(spark, sf, d=d, key=key, val=val):
            return ex.avg_by(fl.require(silver(spark, sf, d), key), key, val, "mean_value")

    for name, key in (("dow", "DAY_OF_WEEK"), ("dom", "DAY_OF_MONTH")):
        for val in ("DEP_DELAY", "ARR_DELAY"):
            @query(f"sum_{val.lower()}_by_{name}_{d}", f"""{base} SELECT {key}, {r(f'coalesce(sum({val}),0)','total_delay')} FROM {d} GROUP BY 1""")
            def _(spark, sf, d=d, key=key, val=val):
                return ex.sum_by(silver(spark, sf, d), key, val, "total_delay")

    for val in ("ARR_DELAY", "DEP_DELAY"):
        short = val[:3].lower()

        @query(f"status_counts_{short}_{d}", f"""{base} SELECT s AS status, CAST(count(*) AS BIGINT) AS flights,
CASE s WHEN 0 THEN 'On-time' WHEN 1 THEN 'Slight delay' ELSE 'High delay' END AS label FROM
(SELECT CASE WHEN {val}>=60 THEN 2 WHEN {val}>=15 THEN 1 WHEN {val}<=15 THEN 0 END AS s FROM {d} WHERE {val} IS NOT NULL) GROUP BY 1""")
        def _(spark, sf, d=d, val=val):
            return ex.status_counts(silver(spark, sf, d), val)

        @query(f"hist_{short}_{d}", f"""{base}, x AS (SELECT min({val}) AS a, (max({val})-min({val}))/50 AS w FROM {d}),
c AS (SELECT CAST(least(floor(({val}-a)/w),49) AS INT) AS b, count(*) AS n FROM {d}, x WHERE {val} IS NOT NULL GROUP BY 1)
SELECT CAST(i AS INT) AS bin, {r('a+i*w','lo')}, {r('a+(i+1)*w','hi')}, CAST(coalesce(n,0) AS BIGINT) AS flights
FROM range(50) t(i) CROSS JOIN x LEFT JOIN c ON b = i""")
        def _(spark, sf, d=d, val=val):
            return ds.histogram(silver_table(spark, sf, d, val), val)

        @query(f"density_{short}_{d}", f"""{base}, x AS (SELECT min({val}) AS a, max({val}) AS z, count({val}) AS n,
stddev_samp({val}) * pow(count({val}), -0.2) AS h FROM {d}),
c AS (SELECT least(floor(({val}-a)/((z-a)/50)),49) AS b, count(*) AS k FROM {d}, x WHERE {val} IS NOT NULL GROUP BY 1)
SELECT {r('a + i*(z-a)/100','x')}, {r("sum(k*exp(-0.5*pow((a + i*(z-a)/100 - (a+(b+0.5)*(z-a)/50))/h,2)))/sqrt(2*pi())/(n*h)",'density')}
FROM c CROSS JOIN x CROSS JOIN range(101) t(i) GROUP BY i, a, z, n, h""")
        def _(spark, sf, d=d, val=val):
            return ds.binned_kde(silver_table(spark, sf, d, val), val)

        @query(f"month_delay_density_{short}_{d}", f"""{base}, u AS (SELECT CAST("MONTH" AS DOUBLE) AS x, {val} AS y FROM {d} WHERE {val} IS NOT NULL),
b AS (SELECT min(x) AS ax, (max(x)-min(x))/12 AS wx, min(y) AS ay, (max(y)-min(y))/25 AS wy FROM u)
SELECT CAST(least(floor((x-ax)/wx),11) AS INT) AS x_bin, CAST(least(floor((y-ay)/wy),24) AS INT) AS y_bin, CAST(count(*) AS BIGINT) AS flights
FROM u, b GROUP BY 1, 2""")
        def _(spark, sf, d=d, val=val):
            return ds.hist2d(silver_table(spark, sf, d, "MONTH", val), "MONTH", val, 12, 25)

    for x, y in (("ARR_DELAY", "DEP_DELAY"), ("ARR_DELAY", "tot_precip_mm"), ("DEP_DELAY", "tot_precip_mm")):
        @query(f"pair_density_{x[:3].lower()}_{y[:3].lower()}_{d}", f"""{ctes(d + '6')}, u AS (SELECT {x} AS x, {y} AS y FROM {d}6 WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
b AS (SELECT min(x) AS ax, (max(x)-min(x))/20 AS wx, min(y) AS ay, (max(y)-min(y))/20 AS wy FROM u)
SELECT CAST(least(floor((x-ax)/wx),19) AS INT) AS x_bin, CAST(least(floor((y-ay)/wy),19) AS INT) AS y_bin, CAST(count(*) AS BIGINT) AS flights
FROM u, b GROUP BY 1, 2""")
        def _(spark, sf, d=d, x=x, y=y):
            return ds.hist2d(silver_table(spark, sf, d, x, *([y] if y in DELAYS else [F.round(F.col(y) + 1e-9, 6).alias(y)])), x, y, 20, 20)

    @query(f"corr_matrix_{d}", f"{base} " + " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, {r(f'corr("{a}","{b}")','corr')} FROM {d}"""
        for a in NUMERIC_COLS for b in NUMERIC_COLS))
    def _(spark, sf, d=d):
        return relations.corr_long(silver(spark, sf, d), NUMERIC_COLS)

    @query(f"ols_temp_vis_{d}", f"""{base} SELECT {r('regr_slope(avg_vis_m, avg_temp_f)','slope')}, {r('regr_intercept(avg_vis_m, avg_temp_f)','intercept')},
{r('regr_r2(avg_vis_m, avg_temp_f)','r2')}, CAST(regr_count(avg_vis_m, avg_temp_f) AS BIGINT) AS n FROM {d}""")
    def _(spark, sf, d=d):
        return relations.ols(silver(spark, sf, d), "avg_temp_f", "avg_vis_m")

    @query(f"null_census_{d}", f"{base} SELECT " + ", ".join(
        f'CAST(count(*) - count("{c}") AS BIGINT) AS "{c}"' for c in SILVER_COLS) + f" FROM {d}")
    def _(spark, sf, d=d):
        return nulls.null_counts(silver(spark, sf, d, with_key=False))

    @query(f"feature_stats_{d}", f"{ctes(d + '6')} {' UNION ALL '.join(stats_sql(d + '6', c, kind_of(c)) for c in NUMERIC_COLS)}")
    def _(spark, sf, d=d):
        return pf.numeric_stats(settled(silver(spark, sf, d), MEASURE_COLS), NUMERIC_COLS)

    @query(f"feature_histograms_{d}", f"{ctes(d + '6')} {' UNION ALL '.join(histogram_sql(d + '6', c) for c in NUMERIC_COLS)}")
    def _(spark, sf, d=d):
        rows = stage(settled(silver(spark, sf, d), MEASURE_COLS).select(*NUMERIC_COLS), "silver")
        return qt.histograms(rows, NUMERIC_COLS)

    @query(f"dropna_any_{d}", f"{base} SELECT {cols(KEYED)} FROM {d} WHERE " + " AND ".join(f'"{c}" IS NOT NULL' for c in SILVER_COLS))
    def _(spark, sf, d=d):
        return silver(spark, sf, d).na.drop()

    @query(f"row_counts_{d}", f"{base} SELECT '{d}' AS name, CAST(count(*) AS BIGINT) AS n FROM {d} UNION ALL "
           f"SELECT '{d} with delays', CAST(count(*) AS BIGINT) FROM {d} WHERE DEP_DELAY IS NOT NULL AND ARR_DELAY IS NOT NULL")
    def _(spark, sf, d=d):
        both = F.col("DEP_DELAY").isNotNull() & F.col("ARR_DELAY").isNotNull()
        counted = silver(spark, sf, d).agg(
            F.count(F.lit(1)).alias("rows"), F.count(F.when(both, 1)).alias("labelled"))
        return counted.select(F.inline(F.array(
            F.struct(F.lit(d).alias("name"), F.col("rows").alias("n")),
            F.struct(F.lit(f"{d} with delays").alias("name"), F.col("labelled").alias("n")))))

# --- rows, nulls, columns ---------------------------------------------------------


@query("dropna_all", f"{ctes('arr')} SELECT {cols(SILVER_COLS)} FROM arr")
def _(spark, sf):
    return silver(spark, sf, "arr", with_key=False).na.drop("all")


@query("drop_columns", f"{ctes('dep')} SELECT {cols([c for c in KEYED if c != 'FL_DATE'])} FROM dep")
def _(spark, sf):
    return silver(spark, sf, "dep").drop("FL_DATE")


@query("drop_null_columns", f"{ctes('dep')} SELECT {cols(KEYED)} FROM dep")
def _(spark, sf):
    return nulls.drop_null_columns(silver(spark, sf, "dep").withColumn("EMPTY", F.lit(None).cast("double")))


@query("null_flag", f"{ctes('clean')} SELECT FLIGHT_KEY, CASE WHEN DEP_DELAY IS NULL THEN 1 ELSE 0 END AS dep_missing, CASE WHEN ARR_DELAY IS NULL THEN 1 ELSE 0 END AS arr_missing FROM clean")
def _(spark, sf):
    return bronze(spark, sf).select(
        "FLIGHT_KEY", *[F.col(f"{x.upper()}_DELAY").isNull().cast("int").alias(f"{x}_missing") for x in ("dep", "arr")])


@query("tag_literal", f"{ctes('dep')} SELECT {cols(KEYED)}, 'Staging' AS model FROM dep")
def _(spark, sf):
    return nulls.tag(silver(spark, sf, "dep"), "model", "Staging")


@query("cast_to_string", f"{ctes('clean')} SELECT FLIGHT_KEY, CAST(ORIGIN_AIRPORT_ID AS VARCHAR) AS origin_id FROM clean")
def _(spark, sf):
    return bronze(spark, sf).select("FLIGHT_KEY", F.col("ORIGIN_AIRPORT_ID").cast("string").alias("origin_id"))


@query("code_to_id", f"""{ctes('flights')} SELECT FLIGHT_KEY, DEST, CASE DEST {' '.join(f"WHEN '{a}' THEN {i}" for a, i in airports.AIRPORT_IDS.items())} ELSE 99999 END AS airport_id FROM flights""")
def _(spark, sf):
    return airports.code_to_id(fx.flights(spark, sf).select("FLIGHT_KEY", "DEST"), "DEST", "airport_id")


@query("delay_status", f"{ctes('clean')} SELECT FLIGHT_KEY, CASE WHEN ARR_DELAY>=60 THEN 2 WHEN ARR_DELAY>=15 THEN 1 WHEN ARR_DELAY<=15 THEN 0 END AS status FROM clean")
def _(spark, sf):
    return bronze(spark, sf).select("FLIGHT_KEY", status.delay_status(F.col("ARR_DELAY")).alias("status"))


@query("next_day", f"{ctes('clean')} SELECT FLIGHT_KEY, CAST(FL_DATE + INTERVAL 1 DAY AS DATE) AS inference_date FROM clean")
def _(spark, sf):
    return bronze(spark, sf).select("FLIGHT_KEY", F.date_add("FL_DATE", 1).alias("inference_date"))

# --- fills, positions, limits ---------------------------------------------------

FILL = ["DEP_DELAY", "ARR_DELAY", "hour", *MEASURE_COLS]
ORDER_SQL = 'PARTITION BY ORIGIN_AIRPORT_ID ORDER BY FL_DATE NULLS LAST, "hour" NULLS LAST, FLIGHT_KEY'


def time_order():
    return [F.asc_nulls_last("FL_DATE"), F.asc_nulls_last("hour"), F.asc_nulls_last("FLIGHT_KEY")]


def fill_sql(both, d="dep"):
    out = []
    for c in KEYED:
        if c not in FILL:
            out.append(f'"{c}"')
            continue
        back = f'last_value("{c}" IGNORE NULLS) OVER ({ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'
        ahead = f'first_value("{c}" IGNORE NULLS) OVER ({ORDER_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)'
        out.append(r(f"coalesce({back}, {ahead})" if both else back, c))
    return f"{ctes(d)} SELECT {', '.join(out)} FROM {d}"


@query("ffill", fill_sql(False))
def _(spark, sf):
    return ordered.ffill(silver(spark, sf, "dep"), FILL, time_order(), ["ORIGIN_AIRPORT_ID"])


@query("ffill_bfill", fill_sql(True))
def _(spark, sf):
    return ordered.fill_both(silver(spark, sf, "dep"), FILL, time_order(), ["ORIGIN_AIRPORT_ID"])


@query("row_index", f"""{ctes('dep')} SELECT FLIGHT_KEY, row_number() OVER (ORDER BY FL_DATE NULLS LAST, "hour" NULLS LAST, FLIGHT_KEY) - 1 AS "index" FROM dep""")
def _(spark, sf):
    return ordered.row_index(silver(spark, sf, "dep").select("FLIGHT_KEY", "FL_DATE", "hour"), time_order()).select("FLIGHT_KEY", "index")


@query("row_index_by_origin", f"""{ctes('dep')} SELECT FLIGHT_KEY, row_number() OVER ({ORDER_SQL}) - 1 AS "index" FROM dep""")
def _(spark, sf):
    cut = silver(spark, sf, "dep").select("FLIGHT_KEY", "ORIGIN_AIRPORT_ID", "FL_DATE", "hour")
    return ordered.row_index(cut, time_order(), ["ORIGIN_AIRPORT_ID"]).select("FLIGHT_KEY", "index")


@query("sort_global", f"""{ctes('hourly')} SELECT CAST(month("time") AS INT) AS "month", CAST(count(*) AS BIGINT) AS hours FROM hourly GROUP BY 1 ORDER BY 1""")
def _(spark, sf):
    return hourly(spark, sf).groupBy(F.month("time").alias("month")).agg(F.count(F.lit(1)).alias("hours")).orderBy("month")


@query("head_n", f"""{ctes('dep')} SELECT {cols(KEYED)} FROM dep ORDER BY FL_DATE, "hour" NULLS LAST, FLIGHT_KEY LIMIT 5""")
def _(spark, sf):
    return silver(spark, sf, "dep").orderBy(*time_order()).limit(5)


@query("scan_preview", f"""{ctes('flights')} SELECT {cols(["FLIGHT_KEY", *fl.FLIGHT_COLUMNS], DELAYS)} FROM flights ORDER BY FLIGHT_KEY LIMIT 10""")
def _(spark, sf):
    return tb.preview(fl.select_flights(fx.flights(spark, sf)), order=["FLIGHT_KEY"])


@query("scan_preview_not_null", f"""{ctes('reports')} SELECT {cols(["DATE","CALL_SIGN","REPORT_TYPE","TMP","WND","VIS","DEW","SLP","AA1"], set())} FROM reports
WHERE "DATE" IS NOT NULL AND AA1 IS NOT NULL ORDER BY "DATE", CALL_SIGN, REPORT_TYPE, TMP, WND, VIS, DEW, SLP, AA1 LIMIT 10""")
def _(spark, sf):
    keep = ["DATE", "CALL_SIGN", "REPORT_TYPE", "TMP", "WND", "VIS", "DEW", "SLP", "AA1"]
    return tb.preview(fx.reports(spark, sf).select(*keep), not_null=["DATE", "AA1"], order=keep)

# --- splits and unions -------------------------------------------------------------


def split_sql(cuts):
    whens = " ".join(f"WHEN FLIGHT_KEY % 1000 < {edge} THEN '{name}'" for name, edge in cuts[:-1])
    return f"{ctes('dep')} SELECT FLIGHT_KEY, CASE {whens} ELSE '{cuts[-1][0]}' END AS part FROM dep"


for name, weights, cuts in (
    ("split_hash", sp.TRAIN_TEST, [("train", 700), ("test", 0)]),
    ("split_train_eval_serve", sp.TRAIN_EVAL_SERVE, [("train", 700), ("eval", 850), ("serve", 0)]),
    ("split_75_25", sp.BASELINE, [("train", 750), ("test", 0)]),
):
    @query(name, split_sql(cuts))
    def _(spark, sf, weights=weights):
        return sp.modulus_split(silver(spark, sf, "dep"), "FLIGHT_KEY", weights).select("FLIGHT_KEY", "part")


@query("split_hashed_keys")
def _(spark, sf):
    return sp.hash_split(silver(spark, sf, "dep"), ["FLIGHT_KEY"], sp.TRAIN_TEST).select("FLIGHT_KEY", "part")


@query("split_random")
def _(spark, sf):
    parts = silver_table(spark, sf, "dep", "FLIGHT_KEY").randomSplit([0.7, 0.3], seed=0)
    return parts[0].select("FLIGHT_KEY", F.lit("train").alias("part")).unionByName(
        parts[1].select("FLIGHT_KEY", F.lit("test").alias("part")))

# --- profile of the flight table ----------------------------------------------------

PROFILE_NUM = ["ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "DEP_DELAY", "ARR_DELAY", "DAY_OF_WEEK", "MONTH", "YEAR",
               "QUARTER", "DAY_OF_MONTH", "DEP_TIME"]
PROFILE_TEXT = ["FL_DATE", "CRS_ARR_TIME", "CRS_DEP_TIME", "ORIGIN_CITY_NAME", "DEST_CITY_NAME", "ORIGIN", "DEST",
                "OP_UNIQUE_CARRIER"]


@query("profile_table", f"{ctes('clean')} " + " UNION ALL ".join(
    [f"SELECT *, NULL::DOUBLE AS avg_length, NULL::VARCHAR AS top_text, NULL::BIGINT AS top_n FROM ({stats_sql('clean', c, kind_of(c))})" for c in PROFILE_NUM]
    + [f"""SELECT feature, n, missing, distinct_values, NULL::BIGINT AS zeros, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS "min",
NULL::DOUBLE AS q25, NULL::DOUBLE AS median, NULL::DOUBLE AS q75, NULL::DOUBLE AS "max", NULL::DOUBLE AS top_value, "type", avg_length, top_text, top_n
FROM ({text_sql('clean', c)})""" for c in PROFILE_TEXT]))
def _(spark, sf):
    return pf.profile(bronze(spark, sf).select(*fl.FLIGHT_COLUMNS))


@query("profile_top_values", f"{ctes('clean')} " + " UNION ALL ".join(
    f"""(SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS text, CAST(count(*) AS BIGINT) AS n,
CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS INT) AS place FROM clean GROUP BY 2 ORDER BY place LIMIT 5)"""
    for c in PROFILE_TEXT))
def _(spark, sf):
    return pf.top_values(bronze(spark, sf), PROFILE_TEXT)


@query("sort_by_agg", f"{ctes('clean')} SELECT OP_UNIQUE_CARRIER, CAST(count(*) AS BIGINT) AS flights FROM clean GROUP BY 1 ORDER BY flights")
def _(spark, sf):
    return ex.count_by(bronze(spark, sf), "OP_UNIQUE_CARRIER").sort("flights")
