import datetime as dt

import pytest

from covspark.operators.summarise import is_trivial_summary, summarise_zonal_statistics

d = dt.date
SCHEMA = ("id int, zonal_statistics array<struct<covariate:string,date:date,band:double,"
          "spatial_stat:string,value:double>>")


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _el(date, value, band=1.0, stat="mean"):
    return {"covariate": "cov", "date": date, "band": band, "spatial_stat": stat, "value": value}


def _summary(df, stats, nulls="reference"):
    out = summarise_zonal_statistics(df, stats, nulls=nulls)
    return {r["id"]: [x.asDict() for x in r["summary_zonal_statistics"]] for r in out.collect()}


def test_null_policy(spark):
    df = _df(spark, [(1, [_el(d(2020, 1, 1), 1.0), _el(d(2020, 1, 2), None), _el(d(2020, 1, 3), 4.0)])])
    ref = {x["temporal_stat"]: x["value"] for x in _summary(df, ["min", "max", "mean"])[1]}
    assert ref == {"min": None, "max": None, "mean": 2.5}
    skip = {x["temporal_stat"]: x["value"] for x in _summary(df, ["min", "max", "sum", "prod"], "skip")[1]}
    assert skip == {"min": 1.0, "max": 4.0, "sum": 5.0, "prod": 4.0}
    cov = _summary(df, ["mean"])[1][0]
    assert (cov["start_date"], cov["end_date"], cov["n_dates"]) == (d(2020, 1, 1), d(2020, 1, 3), 2)


def test_all_null_gives_one_row(spark):
    df = _df(spark, [(1, [_el(None, None), _el(None, None)]),
                     (2, [_el(None, None), _el(d(2026, 1, 1), 5.0)])])
    s = _summary(df, ["max"])
    assert s[1] == [{"covariate": "cov", "start_date": None, "end_date": None, "n_dates": 0, "band": 1.0,
                     "spatial_stat": "mean", "temporal_stat": "max", "value": None}]
    assert len(s[2]) == 1 and s[2][0]["value"] is None and s[2][0]["n_dates"] == 1


def test_groups_by_band_and_stat(spark):
    df = _df(spark, [(1, [_el(d(2020, 1, 1), 1.0, 1.0), _el(d(2020, 1, 2), 3.0, 1.0),
                          _el(d(2020, 1, 1), 10.0, 2.0), _el(d(2020, 1, 1), 7.0, 1.0, "max")])])
    s = _summary(df, ["mean"])[1]
    assert sorted((x["band"], x["spatial_stat"], x["value"]) for x in s) == \
        [(1.0, "max", 7.0), (1.0, "mean", 2.0), (2.0, "mean", 10.0)]
    assert is_trivial_summary(df).first()["trivial"] is False


def test_requires_nested_column(spark):
    with pytest.raises(ValueError):
        summarise_zonal_statistics(spark.createDataFrame([(1,)], "id int"))
    with pytest.raises(ValueError):
        summarise_zonal_statistics(_df(spark, []), ["median"])
