"""Bronze flight and report tables derived from the order and line-item tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.functions.airports import AIRPORT_IDS

# Three airports out of scope, appended to the 13 in scope.
OUT_OF_SCOPE = {"MIA": 13303, "PHX": 14107, "MSP": 13487}


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _two_digits(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights_from_orders(orders: DataFrame) -> DataFrame:
    """Flight records; one per order."""
    airports = AIRPORT_IDS | OUT_OF_SCOPE
    codes, ids = list(airports), list(airports.values())
    base = orders.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderdate").cast("date").alias("FL_DATE"),
        F.substring("o_orderpriority", 1, 1).alias("OP_UNIQUE_CARRIER"),
        (F.floor("o_totalprice") % 220).alias("p"),
    )
    k, c, p, day = F.col("k"), F.col("c"), F.col("p"), F.col("FL_DATE")
    origin, dest = (k * 7) % 16, c % 16
    dep_minute = (k * 11) % 60
    return base.select(
        k.alias("FLIGHT_KEY"),
        _pick(ids, origin).alias("ORIGIN_AIRPORT_ID"),
        _pick(codes, origin).alias("ORIGIN"),
        F.concat(_pick(codes, origin), F.lit(" CITY")).alias("ORIGIN_CITY_NAME"),
        _pick(ids, dest).alias("DEST_AIRPORT_ID"),
        _pick(codes, dest).alias("DEST"),
        F.concat(_pick(codes, dest), F.lit(" CITY")).alias("DEST_CITY_NAME"),
        day,
        F.year(day).alias("YEAR"),
        F.quarter(day).alias("QUARTER"),
        F.month(day).alias("MONTH"),
        F.dayofmonth(day).alias("DAY_OF_MONTH"),
        (F.weekday(day) + 1).alias("DAY_OF_WEEK"),
        "OP_UNIQUE_CARRIER",
        F.concat(_two_digits(F.floor(k / 16) % 4 * 8), _two_digits(dep_minute)).alias("CRS_DEP_TIME"),
        F.concat(_two_digits(F.floor(c / 16) % 4 * 8), _two_digits((c * 7) % 60)).alias("CRS_ARR_TIME"),
        F.when(k % 37 != 0, ((k % 24) * 100 + dep_minute).cast("double")).alias("DEP_TIME"),
        F.when(k % 37 != 0, (p - 30).cast("double")).alias("DEP_DELAY"),
        F.when(k % 41 != 0, (p - 40 + c % 25).cast("double")).alias("ARR_DELAY"),
    )


def reports_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Packed weather reports; one per line item."""
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    station = _pick(AIRPORT_IDS, supp % 14)
    tenths = (part * 3) % 500 - 100
    depth = F.when(part % 10 < 8, 0).otherwise(F.col("l_quantity").cast("int"))
    zero = F.lit(0.0)
    return lineitem.select(
        (F.col("l_shipdate") + F.make_dt_interval(
            hours=((order % 3) * 8).cast("int"), mins=(part % 60).cast("int"))).alias("DATE"),
        zero.alias("LATITUDE"),
        zero.alias("LONGITUDE"),
        zero.alias("ELEVATION"),
        F.lit("").alias("CIG"),
        F.when(station.isNull(), "99999").otherwise(F.concat(F.lit("K"), station, F.lit(" "))).alias("CALL_SIGN"),
        F.when(flag == "A", "FM-15").when(flag == "N", "FM-13").otherwise("FM-12").alias("REPORT_TYPE"),
        F.when(line == 7, "+9999,9").otherwise(
            F.concat(F.when(tenths < 0, "-").otherwise("+"), _padded(F.abs(tenths), 4), F.lit(",5"))).alias("TMP"),
        F.when(line == 6, "999,9,9,9999,9").otherwise(
            F.concat(_padded(supp % 360, 3), F.lit(",5,N,"), _padded(part % 180, 4), F.lit(",5"))).alias("WND"),
        F.when(part % 29 == 0, "999999,9,N,9").otherwise(
            F.concat(_padded((part * 13) % 16093, 6), F.lit(",5,N,5"))).alias("VIS"),
        F.concat(F.lit("+"), _padded((part * 2) % 250, 4), F.lit(",5")).alias("DEW"),
        F.concat(_padded(F.lit(9900) + order % 400, 5), F.lit(",5")).alias("SLP"),
        F.when(part % 11 != 0, F.concat(
            _two_digits(order % 4), F.lit(","), _padded(depth, 4), F.lit(",9,5"))).alias("AA1"),
    )


def spread(raw: DataFrame) -> DataFrame:
    """Rows on all cores: each given file is a single row group, which one task would read, parse and add up alone."""
    return raw.repartition(raw.sparkSession.sparkContext.defaultParallelism)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_orders(spread(read(spark, sf_dir, "orders")))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports_from_lineitem(spread(read(spark, sf_dir, "lineitem")))
