"""Model queries; boosted trees have no SQL twin and are checked by rows."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.etl import KEYED, silver
from checks.monitor import FILLED, P, TRAIN_SQL
from checks.registry import query
from checks.sql import cols, ctes, r
from skylag.operators import model as md
from skylag.operators import split as sp
from skylag.operators.flights import between_closed
from skylag.operators.weather import MEASURES, settled
from skylag.plans import forecast as fc
from skylag.plans import monitor as pm
from skylag.plans import train as tr
from skylag.session import new_path, stage
from skylag.sources import registry as rg

LABEL = {"dep": "DEP_DELAY", "arr": "ARR_DELAY"}
#: A member of the searched grid, for fits without a search.
MEMBER = {"maxDepth": 2, "maxIter": 10}


def parts(spark, sf, d, kind=sp.TRAIN_TEST, leak_free=False):
    """Training and test frames of one direction's span, from one written table."""
    rows = stage(sp.hash_split(silver(spark, sf, d), ["FLIGHT_KEY"], kind), "silver")
    return [md.training_frame(rows.where(F.col("part") == p), LABEL[d], leak_free) for p in ("train", "test")]


def span(rows):
    """Training rows of all airports."""
    return between_closed(rows, "FL_DATE", P.training_start, P.training_end)


FEATURES = md.feature_names("DEP_DELAY")
COMPLETE = "DEP_DELAY IS NOT NULL AND ARR_DELAY IS NOT NULL AND \"hour\" IS NOT NULL AND tot_precip_mm IS NOT NULL"
TRAIN_KEYS = "FLIGHT_KEY % 1000 < 700"


def keyed_parts(spark, sf):
    """Complete rows with their key, split by it, from one written table."""
    rows = silver(spark, sf, "dep").select("FLIGHT_KEY", "DEP_DELAY", *FEATURES).na.drop()
    both = stage(sp.modulus_split(rows, "FLIGHT_KEY", sp.TRAIN_TEST), "silver")
    return [both.where(F.col("part") == p).drop("part") for p in ("train", "test")]


def places(vector):
    """The values of a vector column as one column each."""
    values = vector_to_array(vector)
    return [F.get(values, i).alias(f"f{i}") for i in range(len(FEATURES))]


@query("assemble_features", f"{ctes('dep')} SELECT FLIGHT_KEY, " + ", ".join(
    r(f'CAST("{c}" AS DOUBLE)', f"f{i}") for i, c in enumerate(FEATURES)) + f" FROM dep WHERE {COMPLETE}")
def _(spark, sf):
    rows = silver(spark, sf, "dep").select("FLIGHT_KEY", "DEP_DELAY", *FEATURES).na.drop()
    return md.assembler(FEATURES).transform(rows).select("FLIGHT_KEY", *places("rawFeatures"))


@query("index_categories", f"{ctes('dep6')}, tr AS (SELECT * FROM dep6 WHERE {COMPLETE} AND {TRAIN_KEYS}), te AS (SELECT * FROM dep6 WHERE {COMPLETE} AND NOT {TRAIN_KEYS}), "
       + ", ".join(f"""cat{i} AS (SELECT v, row_number() OVER (ORDER BY v <> 0, v) - 1 AS k, count(*) OVER () AS total FROM (SELECT DISTINCT "{c}" AS v FROM tr))"""
                   for i, c in enumerate(FEATURES))
       + " SELECT FLIGHT_KEY, " + ", ".join(f"""CAST(CASE WHEN (SELECT count(*) FROM cat{i}) <= 4 THEN coalesce((SELECT k FROM cat{i} WHERE v = te."{c}"),
(SELECT max(total) FROM cat{i})) ELSE te."{c}" END AS DOUBLE) AS f{i}""" for i, c in enumerate(FEATURES)) + " FROM te")
def _(spark, sf):
    """Features of at most four values in training become categories, 0 first; a value unseen there gets a number of its own."""
    train, test = (md.assembler(FEATURES).transform(settled(p, MEASURES)) for p in keyed_parts(spark, sf))
    return md.indexer().fit(train).transform(test).select("FLIGHT_KEY", *places("features"))


for d in ("dep", "arr"):
    label = LABEL[d]

    @query(f"gbt_fit_{d}")
    def _(spark, sf, label=label, d=d):
        train, test = parts(spark, sf, d)
        return md.metrics(md.score(md.train_gbt(train, label, **MEMBER), test), label)

    @query(f"linear_baseline_{d}")
    def _(spark, sf, label=label, d=d):
        train, test = parts(spark, sf, d, sp.BASELINE)
        return md.metrics(md.score(md.train_linear(train, label), test), label)

    @query(f"linear_one_feature_{d}", f"""{ctes(d)}, t AS (SELECT {label} AS y, avg_temp_f AS x FROM {d} WHERE {label} IS NOT NULL),
f AS (SELECT regr_slope(y, x) AS m, regr_intercept(y, x) AS c FROM t)
SELECT FLIGHT_KEY, {r('m * avg_temp_f + c', 'yhat')} FROM {d}, f""")
    def _(spark, sf, label=label, d=d):
        rows = stage(silver(spark, sf, d), "silver")
        model = md.train_linear(rows.select(label, "avg_temp_f").na.drop(), label)
        return md.score(model, rows).select("FLIGHT_KEY", "yhat")

    @query(f"model_signature_{d}", f"{ctes(d)}, t AS (SELECT * FROM {d} WHERE DEP_DELAY IS NOT NULL AND ARR_DELAY IS NOT NULL AND \"hour\" IS NOT NULL AND tot_precip_mm IS NOT NULL) "
           + " UNION ALL ".join(f"""SELECT '{c}' AS name, '{'double' if c in ('DEP_DELAY', 'ARR_DELAY', 'hour') or c.startswith(('avg', 'tot')) else 'int'}' AS "type",
'{'label' if c == label else 'feature'}' AS role, CAST(count(*) AS BIGINT) AS n FROM t""" for c in [label, *md.feature_names(label)]))
    def _(spark, sf, label=label, d=d):
        return md.signature(md.training_frame(silver(spark, sf, d), label), label)

    @query(f"training_frame_{d}", f"""{ctes(d)} SELECT {r(f'avg({label})', 'avg_label')}, CAST(count(*) AS BIGINT) AS n FROM {d}
WHERE DEP_DELAY IS NOT NULL AND ARR_DELAY IS NOT NULL AND "hour" IS NOT NULL AND tot_precip_mm IS NOT NULL""")
    def _(spark, sf, label=label, d=d):
        return md.training_frame(silver(spark, sf, d), label).agg(
            F.avg(label).alias("avg_label"), F.count(F.lit(1)).alias("n"))


@query("grid_cv")
def _(spark, sf):
    train, test = parts(spark, sf, "dep")
    model = md.tune(train, "DEP_DELAY")
    return md.metrics(md.score(model, test), "DEP_DELAY")


@query("pipeline_fit")
def _(spark, sf):
    train, test = parts(spark, sf, "arr")
    return md.score(md.tune(train, "ARR_DELAY"), test).select("ARR_DELAY", "yhat")


LINE_SQL = """fit AS (SELECT regr_slope(y, x) AS m, regr_intercept(y, x) AS c FROM (SELECT DEP_DELAY AS y, avg_temp_f AS x FROM dep WHERE {where}))"""


@query("prediction_view", f"""{ctes('dep')}, {LINE_SQL.format(where=f'{COMPLETE} AND {TRAIN_KEYS}')}
SELECT {r('DEP_DELAY', 'DEP_DELAY')}, {r('m * avg_temp_f + c', 'yhat')}, {cols(FEATURES)} FROM dep, fit WHERE {COMPLETE} AND NOT {TRAIN_KEYS}""")
def _(spark, sf):
    train, test = keyed_parts(spark, sf)
    model = md.train_linear(train.select("DEP_DELAY", "avg_temp_f"), "DEP_DELAY")
    return md.prediction_view(md.score(model, test), "DEP_DELAY", FEATURES)


@query("stage_model_forecast", f"""{FILLED}, {' , '.join(f"""{n} AS (SELECT regr_slope(y, x) AS m, regr_intercept(y, x) AS c
FROM (SELECT DEP_DELAY AS y, {x} AS x FROM dep WHERE {TRAIN_SQL} AND DEP_DELAY IS NOT NULL AND {x} IS NOT NULL))""" for n, x in (('st', 'avg_temp_f'), ('pr', 'avg_dewpt_f')))}
SELECT {cols(KEYED)}, {r('m * avg_temp_f + c', 'yhat')}, 'Staging' AS model FROM f, st
UNION ALL SELECT {cols(KEYED)}, {r('m * avg_dewpt_f + c', 'yhat')}, 'Production' AS model FROM f, pr""")
def _(spark, sf):
    """Two versions of a model are registered and put into stages; the forecast finds them by name and stage."""
    base, rows = new_path(spark, "registry"), stage(silver(spark, sf, "dep"), "silver")
    for version, (x, stage_name) in enumerate((("avg_dewpt_f", rg.PRODUCTION), ("avg_temp_f", rg.STAGING)), 1):
        model = md.train_linear(span(rows).select("DEP_DELAY", x).na.drop(), "DEP_DELAY")
        tr.record(spark, base, "line", tr.Trained(model, {}, f"run-{version}", {}, []), P)
        rg.set_stage(spark, base, "line", version, stage_name)
    return fc.forecast_stages(base, "line", fc.forecast_input(rows, P))


@query("leak_free_fit")
def _(spark, sf):
    train, test = parts(spark, sf, "dep", leak_free=True)
    return md.metrics(md.score(md.train_linear(train, "DEP_DELAY"), test), "DEP_DELAY")


@query("model_sink")
def _(spark, sf):
    """A saved and reloaded model gives the same predictions."""
    train, test = parts(spark, sf, "dep")
    model = md.train_linear(train, "DEP_DELAY")
    again = rg.load_model(rg.save_model(model, new_path(spark, "model")))
    both = md.score(again, md.score(model, test, "first").drop("rawFeatures"), "second")
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("first") - F.col("second"))).alias("largest_gap"))


@query("score_batch")
def _(spark, sf):
    train, test = parts(spark, sf, "dep")
    return md.score(md.train_gbt(train, "DEP_DELAY", **MEMBER), test).select("DEP_DELAY", "yhat")


@query("forecast_by_stage")
def _(spark, sf):
    rows = stage(silver(spark, sf, "dep"), "silver")
    train = md.training_frame(span(rows), "DEP_DELAY")
    models = {"Staging": md.train_gbt(train, "DEP_DELAY", **MEMBER), "Production": md.train_linear(train, "DEP_DELAY")}
    return fc.forecast_by_stage(models, fc.forecast_input(rows, P))


@query("forecast_production")
def _(spark, sf):
    rows = stage(silver(spark, sf, "dep"), "silver")
    model = md.train_linear(md.training_frame(span(rows), "DEP_DELAY"), "DEP_DELAY")
    return fc.forecast_by_stage({"Production": model}, fc.forecast_input(rows, P))


@query("residual_trend")
def _(spark, sf):
    rows = stage(silver(spark, sf, "arr"), "silver")
    train = md.training_frame(span(rows), "ARR_DELAY")
    models = {"staging": md.train_gbt(train, "ARR_DELAY", **MEMBER), "prod": md.train_linear(train, "ARR_DELAY")}
    return pm.residual_trend(pm.stage_residuals(rows, P, models))
