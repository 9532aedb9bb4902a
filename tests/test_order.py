"""Order of results, which the value comparison does not see."""

from checks import QUERIES


def values(spark, sf_dir, name, *cols):
    return [tuple(r[c] for c in cols) for r in QUERIES[name](spark, sf_dir).collect()]


def test_months_are_in_order(spark, sf_dir):
    assert values(spark, sf_dir, "monthly_temp", "month") == [(m,) for m in range(1, 13)]


def test_carriers_by_number_of_airports(spark, sf_dir):
    for name, col in (("carrier_origins", "origins"), ("carrier_dests_exact", "dests"), ("sort_by_agg", "flights")):
        got = values(spark, sf_dir, name, col)
        assert got == sorted(got)


def test_timeline_by_hour(spark, sf_dir):
    got = values(spark, sf_dir, "forecast_timeline", "hour", "model", "FLIGHT_KEY")
    assert got == sorted(got)


def test_groups_in_order(spark, sf_dir):
    for name, key in (("delay_by_dow", "DAY_OF_WEEK"), ("delay_by_origin", "ORIGIN"), ("delay_by_dest", "DEST")):
        got = values(spark, sf_dir, name, key)
        assert got == sorted(got)


def test_approximate_counts_are_near(spark, sf_dir):
    near = dict(values(spark, sf_dir, "carrier_origins", "OP_UNIQUE_CARRIER", "origins"))
    exact = dict(values(spark, sf_dir, "carrier_origins_exact", "OP_UNIQUE_CARRIER", "origins"))
    assert near.keys() == exact.keys() and all(abs(near[k] - exact[k]) <= 1 for k in exact)


def test_entry_and_registration(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 10
