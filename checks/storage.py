"""Queries of the stored tables: writes, layouts, catalog, schema validation and migration."""

import datetime as dt

from pyspark.sql import functions as F

from checks.etl import DELAYS, FLIGHT_OUT, HOURLY_OUT, KEYED, bronze, hourly, silver
from checks.registry import query
from checks.sql import cols, ctes, r
from checks import fixtures as fx
from skylag.operators import weather as wx
from skylag.session import new_path, stage
from skylag.sources import layout, schema
from skylag.sources import tables as tb

MEASURES = set(wx.MEASURES)


@query("scan_batch", """SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice + 1e-9, 6) AS o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def _(spark, sf):
    fx.read(spark, sf, "orders").createOrReplaceTempView("raw_orders")
    return tb.read_table(spark, "raw_orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("temp_view", f"{ctes('clean')} SELECT ORIGIN, CAST(count(*) AS BIGINT) AS flights FROM clean GROUP BY 1")
def _(spark, sf):
    bronze(spark, sf).createOrReplaceTempView("air_view")
    return spark.sql("SELECT ORIGIN, count(*) AS flights FROM air_view GROUP BY ORIGIN")


@query("sink_batch_append", f"{ctes('dep')} SELECT {cols(KEYED)} FROM dep")
def _(spark, sf):
    return tb.read_path(spark, tb.written(silver(spark, sf, "dep"), "appended"))


@query("sink_idempotent", f"{ctes('dep')} SELECT {cols(KEYED)} FROM dep WHERE NOT (\"YEAR\" = 1997 AND \"MONTH\" = 3)")
def _(spark, sf):
    """A rerun whose input has a month less leaves nothing of that month."""
    path, rows = new_path(spark, "monthly"), stage(silver(spark, sf, "dep"), "silver")
    for part in (rows, rows.where("NOT (YEAR = 1997 AND MONTH = 3)")):
        tb.save_idempotent(part, path, ["YEAR", "MONTH"])
    return spark.read.parquet(path)


@query("partitioned_layout", f"{ctes('dep')} SELECT {cols(KEYED)} FROM dep WHERE FL_DATE BETWEEN DATE '1997-03-10' AND DATE '1999-02-20'")
def _(spark, sf):
    path = tb.save_by_month(silver(spark, sf, "dep"), new_path(spark, "monthly"))
    return tb.between_months(spark.read.parquet(path), dt.date(1997, 3, 10), dt.date(1999, 2, 20))


@query("zorder_layout", f"{ctes('dep')} SELECT {cols(KEYED)} FROM dep")
def _(spark, sf):
    rows = stage(silver(spark, sf, "dep"), "silver")
    return tb.read_path(spark, tb.written(layout.zorder(rows, ["ORIGIN_AIRPORT_ID", "DEP_DELAY"], files=8), "zordered"))


@query("register_external", f"{ctes('hourly')} SELECT {cols(HOURLY_OUT, MEASURES)} FROM hourly")
def _(spark, sf):
    where = new_path(spark, "db")
    current = spark.catalog.currentDatabase()
    db = tb.ensure_db(spark, "skylag_weather", where)
    table = tb.register(spark, db, "weather_bronze", tb.written(hourly(spark, sf), "hourly"))
    spark.catalog.setCurrentDatabase(current)
    return table


@query("ensure_db", f"{ctes('clean')} SELECT DEST, CAST(count(*) AS BIGINT) AS flights FROM clean GROUP BY 1")
def _(spark, sf):
    current = spark.catalog.currentDatabase()
    db = tb.ensure_db(spark, "skylag_traffic", new_path(spark, "db"))
    tb.register(spark, db, "air_bronze", tb.written(bronze(spark, sf), "bronze"))
    out = spark.sql("SELECT DEST, count(*) AS flights FROM air_bronze GROUP BY DEST")
    spark.catalog.setCurrentDatabase(current)
    return out


@query("cache_reuse", f"{ctes('dep')} SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DEP_DELAY) AS BIGINT) AS n_dep, {r('avg(ARR_DELAY)','avg_arr')} FROM dep")
def _(spark, sf):
    kept = silver(spark, sf, "dep").persist()
    try:
        rows = kept.count()
        out = stage(kept.agg(F.lit(rows).cast("long").alias("n_rows"), F.count("DEP_DELAY").alias("n_dep"),
                             F.avg("ARR_DELAY").alias("avg_arr")), "kept")
    finally:
        kept.unpersist()
    return out


def old_flights(spark, sf):
    """Flights as an earlier layout held them: text delays with words in them, a wide year, no carrier."""
    delay = F.when(F.col("FLIGHT_KEY") % 10 == 3, "late").otherwise(F.col("DEP_DELAY").cast("string"))
    return fx.flights(spark, sf).withColumns(
        {"DEP_DELAY": delay, "YEAR": F.col("YEAR").cast("long"), "SOURCE": F.lit("old"),
         "DAY_OF_WEEK": F.when(F.col("DAY_OF_WEEK") != 7, F.col("DAY_OF_WEEK"))}
    ).drop("OP_UNIQUE_CARRIER")


@query("schema_validate", f"""{ctes('flights')} SELECT 'OP_UNIQUE_CARRIER' AS feature, 'missing' AS issue, 'string' AS expected, NULL AS actual, CAST(count(*) AS BIGINT) AS bad_rows FROM flights
UNION ALL SELECT 'DEP_DELAY', 'mistyped', 'double', 'string', CAST(count(*) FILTER (WHERE FLIGHT_KEY % 10 = 3) AS BIGINT) FROM flights
UNION ALL SELECT 'YEAR', 'mistyped', 'int', 'bigint', 0
UNION ALL SELECT 'DAY_OF_WEEK', 'nulls', 'not null', 'int', CAST(count(*) FILTER (WHERE DAY_OF_WEEK = 7) AS BIGINT) FROM flights
UNION ALL SELECT 'SOURCE', 'extra', NULL, 'string', 0""")
def _(spark, sf):
    return schema.validate_schema(old_flights(spark, sf), schema.FLIGHT_SCHEMA)


_migrated = [c for c in FLIGHT_OUT if c not in ("OP_UNIQUE_CARRIER", "DEP_DELAY", "DAY_OF_WEEK")]


@query("schema_migrate", f"""{ctes('flights')} SELECT {cols(_migrated, DELAYS)}, CAST(NULL AS VARCHAR) AS OP_UNIQUE_CARRIER,
{r('CASE WHEN FLIGHT_KEY % 10 <> 3 THEN DEP_DELAY END', 'DEP_DELAY')}, CASE WHEN DAY_OF_WEEK <> 7 THEN DAY_OF_WEEK END AS DAY_OF_WEEK FROM flights""")
def _(spark, sf):
    return schema.migrate_schema(old_flights(spark, sf), schema.FLIGHT_SCHEMA, allow=["YEAR"])


@query("schema_migrate_rejects", f"""{ctes('flights')} SELECT FLIGHT_KEY, 'DEP_DELAY' AS feature, 'late' AS raw FROM flights WHERE FLIGHT_KEY % 10 = 3
UNION ALL SELECT FLIGHT_KEY, 'YEAR', CAST(4000000000 + "YEAR" AS VARCHAR) FROM flights WHERE FLIGHT_KEY % 10 = 4""")
def _(spark, sf):
    """Words among the delays, and years too wide for the target."""
    wide = F.when(F.col("FLIGHT_KEY") % 10 == 4, F.col("YEAR") + F.lit(4_000_000_000)).otherwise(F.col("YEAR"))
    return schema.rejected_values(old_flights(spark, sf).withColumn("YEAR", wide), schema.FLIGHT_SCHEMA, ["FLIGHT_KEY"])
