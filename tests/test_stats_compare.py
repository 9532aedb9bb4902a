"""The reports are read and added up once for both directions."""

from checks import QUERIES, fixtures


def test_reports_are_read_once(spark, sf_dir, monkeypatch):
    read, reports = [], fixtures.reports
    monkeypatch.setattr(fixtures, "reports", lambda *a: read.append(a) or reports(*a))
    assert QUERIES["stats_compare"](spark, sf_dir.replace("sf0.01", "sf0.001")).columns
    assert len(read) == 1
