"""Chunked operators: many small chunks must give what one window or numpy gives."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.explore import FILL, time_order
from skylag.operators import distributions as ds
from skylag.operators.ordered import ffill, fill_both, row_index

KEY = ["ORIGIN_AIRPORT_ID"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def gappy(spark):
    """Two groups, one holding most rows and long runs of nulls at its start, end and across chunks."""
    data = []
    for i in range(900):
        group = "hot" if i % 10 else "cold"
        value = float(i) if i % 97 == 50 or (group == "cold" and i % 7 == 0) else None
        data.append((i, group, value, None))
    return spark.createDataFrame(data, "id long, grp string, v double, empty double")


def plain_fill(df, both):
    w = Window.partitionBy("grp").orderBy("id")
    back = F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn("v", F.coalesce(back, ahead) if both else back)


@pytest.mark.parametrize("rows", [50, 333, 10**6])
@pytest.mark.parametrize("both", [False, True])
def test_fill_over_chunks(gappy, rows, both):
    fill = fill_both if both else ffill
    got = fill(gappy, ["v", "empty"], [F.asc("id")], ["grp"], rows)
    assert rows_of(got) == rows_of(plain_fill(gappy, both))


def test_fill_without_groups(gappy):
    one = gappy.withColumn("grp", F.lit("x"))
    assert rows_of(fill_both(one, ["v"], [F.asc("id")], (), 70)) == rows_of(plain_fill(one, True))


def test_fill_twice_changes_nothing(silver_rows):
    once = fill_both(silver_rows, FILL, time_order(), KEY, 200)
    # The order column itself gets filled, so fill again by the unique key only after sorting by it once.
    again = fill_both(once, FILL, [F.asc("FLIGHT_KEY")], KEY, 200)
    assert rows_of(once) == rows_of(again)


@pytest.mark.parametrize("by", [(), ("ORIGIN_AIRPORT_ID",)])
def test_row_index_over_chunks(silver_rows, by):
    cut = silver_rows.select("FLIGHT_KEY", "ORIGIN_AIRPORT_ID", "FL_DATE", "hour")
    many = row_index(cut, time_order(), by, rows=100)
    window = Window.partitionBy(*by).orderBy(*time_order()) if by else Window.partitionBy(F.lit(1)).orderBy(*time_order())
    plain = cut.withColumn("index", (F.row_number().over(window) - 1).cast("long"))
    assert rows_of(many) == rows_of(plain)
