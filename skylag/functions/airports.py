"""Airport dimension and code/id translation."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The 13 airports in scope and their ids in the flight table.
AIRPORT_IDS = {
    "ATL": 10397,
    "BOS": 10721,
    "CLT": 11057,
    "ORD": 13930,
    "CVG": 11193,
    "DFW": 11298,
    "DEN": 11292,
    "IAH": 12266,
    "LAX": 12892,
    "JFK": 12478,
    "SFO": 14771,
    "SEA": 14747,
    "DCA": 11278,
}
# Fixed value: id given to a code outside the list.
UNKNOWN_ID = 99999

CODES = list(AIRPORT_IDS)


def airport_dim(spark: SparkSession) -> DataFrame:
    """One row per airport in scope; always 13 rows."""
    return spark.createDataFrame(list(AIRPORT_IDS.items()), "code string, id int")


def _lookup(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def id_of(code: Column) -> Column:
    """Airport id of a code, ``UNKNOWN_ID`` when the code is not in scope."""
    return F.coalesce(F.try_element_at(_lookup(AIRPORT_IDS), code), F.lit(UNKNOWN_ID))


def code_of(airport_id: Column) -> Column:
    """Airport code of an id; an id outside the list stays as text."""
    names = {i: c for c, i in AIRPORT_IDS.items()}
    return F.coalesce(F.try_element_at(_lookup(names), airport_id.cast("int")), airport_id.cast("string"))


def code_to_id(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, id_of(F.col(col)))


def id_to_code(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: code_of(F.col(c)) for c in cols})
