import datetime as dt

import pytest
from pyspark.sql import functions as F

from runledger.functions import ancestors, depth, format_clock, is_under, parent, parse_log_time
from runledger.functions.predicate import as_day, in_date_range


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long'}" for k, v in values.items()))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_log_time_knows_no_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        cases = {
            "02:30:00 10.3.2019": dt.datetime(2019, 3, 10, 2, 30), "9:5:7 1.2.2015": dt.datetime(2015, 2, 1, 9, 5, 7), "junk": None,
            "25:00:00 1.1.2020": None, "1:2:3 31.2.2020": None, "1:2:3 1.1.20200": None, "": None, None: None,
        }
        rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", parse_log_time(F.col("t")).alias("x")).collect()
        assert {r.t: r.x for r in rows} == cases
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clocks_are_shown(spark):
    rows = [(None, None), (0, "0 days 00:00:00"), (16659_666666, "0 days 04:37:39.666666"), (-1, "-1 days 23:59:59.999999"), (90061_000001, "1 days 01:01:01.000001")]
    got = spark.createDataFrame(rows, "us long, want string").select("want", format_clock(F.col("us")).alias("x")).collect()
    assert all(r.x == r.want for r in got)


def test_paths(spark):
    def rows(f):
        return {r.p: r.x for r in spark.createDataFrame([(p,) for p in ("/", "/a", "/a/b", "a", "", None)], "p string").select("p", f(F.col("p")).alias("x")).collect()}

    assert rows(parent) == {"/": None, "/a": "/", "/a/b": "/a", "a": None, "": None, None: None}
    assert rows(depth) == {"/": 0, "/a": 1, "/a/b": 2, "a": None, "": None, None: None}
    assert rows(lambda p: ancestors(p, include_self=True)) == {"/": [], "/a": ["/a"], "/a/b": ["/a", "/a/b"], "a": [], "": [], None: []}
    assert rows(lambda p: is_under(p, "/")) == {"/": False, "/a": True, "/a/b": True, "a": False, "": False, None: None}
    assert rows(lambda p: is_under(p, "/a")) == {"/": False, "/a": False, "/a/b": True, "a": False, "": False, None: None}


def test_bad_dates_fail_before_any_job():
    for bad in ("2024-13-01", "today", "01.02.2024"):
        with pytest.raises(ValueError):
            as_day(bad)
        with pytest.raises(ValueError):
            in_date_range(F.lit(None), bad, "2024-01-01")
