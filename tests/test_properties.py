"""Randomised checks against plain-Python definitions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from covspark.operators import temporal
from covspark.operators.summarise import summarise_zonal_statistics

SCHEMA = ("id int, zonal_statistics array<struct<covariate:string,date:date,band:double,"
          "spatial_stat:string,value:double>>")
BASE = dt.date(2020, 1, 1)

element = st.tuples(st.one_of(st.none(), st.integers(0, 20)),          # day offset or NULL date
                    st.sampled_from([1.0, 2.0]),                          # band
                    st.one_of(st.none(), st.integers(-5, 5).map(float)))  # value or NULL
rows = st.lists(st.lists(element, min_size=1, max_size=12), min_size=1, max_size=6)


def _expected(elements, stat, nulls):
    out = {}
    for band in sorted({b for _, b, _ in elements}):
        grp = [(dd, v) for dd, b, v in elements if b == band]
        vals = [v for _, v in grp if v is not None]
        dates = {dd for dd, v in grp if v is not None and dd is not None}
        if stat == "mean":
            value = sum(vals) / len(vals) if vals else None
        elif nulls == "reference" and len(vals) < len(grp):
            value = None
        elif not vals:
            value = None
        else:
            value = {"min": min, "max": max, "sum": sum}[stat](vals)
        out[band] = (value, len(dates),
                     BASE + dt.timedelta(days=min(dates)) if dates else None,
                     BASE + dt.timedelta(days=max(dates)) if dates else None)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, stat=st.sampled_from(["min", "max", "mean", "sum"]),
       nulls=st.sampled_from(["reference", "skip"]))
def test_summary_matches_python(spark, data, stat, nulls):
    df = spark.createDataFrame(
        [(i, [{"covariate": "c", "date": None if dd is None else BASE + dt.timedelta(days=dd),
               "band": b, "spatial_stat": "mean", "value": v} for dd, b, v in els])
         for i, els in enumerate(data)], SCHEMA)
    got = {r["id"]: r["summary_zonal_statistics"]
           for r in summarise_zonal_statistics(df, stat, nulls=nulls).collect()}
    for i, els in enumerate(data):
        exp = _expected(els, stat, nulls)
        res = {x["band"]: (x["value"], x["n_dates"], x["start_date"], x["end_date"]) for x in got[i]}
        assert res.keys() == exp.keys()
        for band, (v, n, s, e) in exp.items():
            gv, gn, gs, ge = res[band]
            assert (gn, gs, ge) == (n, s, e)
            assert (gv is None and v is None) or abs(gv - v) < 1e-9


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(st.integers(0, 200), min_size=1, max_size=25), n=st.integers(1, 40))
def test_islands_match_python(spark, days, n):
    df = spark.createDataFrame([(0.0, 0.0, BASE + dt.timedelta(days=x)) for x in days],
                               "latitude double, longitude double, sample_date date")
    got = sorted((r["start_date"], r["end_date"])
                 for r in temporal.window_islands(df, n, "sample_date").collect())
    exp, cur = [], None
    for x in sorted(set(days)):
        if cur is None or x - cur[1] > n:
            cur = [x, x]
            exp.append(cur)
        else:
            cur[1] = x
    assert got == [(BASE + dt.timedelta(days=a), BASE + dt.timedelta(days=b)) for a, b in exp]
