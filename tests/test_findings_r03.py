"""Findings of round 3: what is multiplied isn't shuffled, documents are packed, results stay whole."""

import datetime as dt
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_mod
from covspark.operators import pyramid

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pyramid_shuffles_no_cover(spark):
    plan = plan_of(entry_mod.queries()["zonal_pyramid"](spark, SF))
    assert not re.search(r"Exchange hashpartitioning\([^\n]*(level|tx)#", plan)


def test_pyramid_std_keeps_its_digits(spark):
    day = dt.date(2020, 1, 1)
    near = [(f"c{b}", day, b, 0.5 + k % 5, 0.5 + k // 5, 0.5, v(k)) for b, v in ((1, lambda k: 1e6 + 0.1), (2, lambda k: 1e6 + 0.001 * (k % 2)))
            for k in range(20)]
    far = [(f"c{b}", day, b, 0.5, 100.5 + k, 0.5, 7.3) for b in (1, 2) for k in range(20)]  # moves the usual value of the date
    cells = spark.createDataFrame([("c", *r[1:]) for r in near + far],
                                  "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double")
    points = spark.createDataFrame([(2.0, 2.0, "c", day)], "latitude double, longitude double, covariate_id string, item_date date")
    got = {r.band: r for r in pyramid.zonal_from_pyramid(points, pyramid.build_pyramid(cells), cells, 3e6, ["std", "count"], cell_deg=1.0).collect()}
    assert got[1]["count"] == got[2]["count"] == 20
    assert got[1]["std"] == 0.0 and got[2]["std"] == pytest.approx(0.0005, rel=1e-2)


@pytest.mark.parametrize("name, folder", [("json_items", "items"), ("json_collections", "collections")])
def test_json_documents_are_packed_and_its_own_only(spark, name, folder):
    from covspark.session import ensure_checkpoint_dir
    base = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(base.glob("stac-*"))
    assert entry_mod.queries()[name](spark, SF).count() > 0
    files = [p for d in set(base.glob("stac-*")) - before for p in d.rglob("part-*")]
    assert files and {p.parent.name for p in files} == {folder} and {p.suffix for p in files} == {".gz"}


def test_a_task_sorts_for_one_side_of_the_windows(spark):
    from covspark.plans.window_summary import window_parts
    day = dt.date(2020, 1, 1)
    flat = spark.createDataFrame([(0.0, 0.0, 1, "mean", day, 1.0)], "lat double, lon double, band int, spatial_stat string, item_date date, value double")
    asked = spark.createDataFrame([(0.0, 0.0, 1, "mean", 18270)], "lat double, lon double, band int, spatial_stat string, d int")
    out = window_parts(flat, asked, 365, ["band", "spatial_stat"], ["lat", "lon"])
    steps = re.findall(r"\b(Window|Exchange)\b", plan_of(out))
    assert steps.count("Window") == 2 and all(b == "Exchange" for a, b in zip(steps, steps[1:]) if a == "Window")
    assert [(r.n, r.sum) for r in out.collect()] == [(1, 1.0)]


def test_a_groups_rows_are_picked_once(spark):
    from covspark.operators.summarise import summarise_zonal_statistics
    rows = [("sst", dt.date(2020, 1, k), b, v) for b in (1.0, 2.0) for k, v in ((1, 2.0), (2, None), (3, 4.0 * b))]
    df = spark.createDataFrame([(1, rows), (2, rows[:3])], "k int, zonal_statistics array<struct<covariate:string,date:date,band:double,value:double>>")
    out = summarise_zonal_statistics(df, "mean")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"filter\(zonal_statistics#", plan)) == 1
    got = {r.k: [(s.band, s.value, s.n_dates) for s in r.summary_zonal_statistics] for r in out.collect()}
    assert got == {1: [(1.0, 3.0, 2), (2.0, 5.0, 2)], 2: [(1.0, 3.0, 2)]} and out.columns == [*df.columns, "summary_zonal_statistics"]


def _slots_case(spark):
    day = dt.date(2020, 1, 1)
    cells = spark.createDataFrame([("sst", day + dt.timedelta(days=i), b, x + 0.5, 0.5, 0.5, float(i + b)) for i in range(12) for b in (1, 2) for x in (0, 9)],
                                  "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double")
    items = cells.select("covariate_id", "item_date").distinct().selectExpr("*", "'i' as item_id")
    places = [(0.2, 0.2), (9.2, 0.2), (-0.0, 0.2), (0.0, 0.2), (50.0, 0.2), (None, 0.2)]
    ev = [(k % 17 if k % 5 else None, *places[k % 6], day + dt.timedelta(days=k % 9) if k % 7 else None) for k in range(24)]
    return cells, items, ev


def test_rows_are_nested_where_they_lie(spark):
    """the rows of a key with one event aren't shuffled again; keys that events share, or none, still meet."""
    from pyspark.sql import functions as F
    from covspark.operators.reshape import nest, unnest
    from covspark.plans.zonal_statistics import zonal_statistics
    cells, items, ev = _slots_case(spark)
    ks = [e[0] for e in ev]
    assert {ks.count(k) for k in ks} > {1, 2}
    se = spark.createDataFrame([(*e, ks.count(e[0])) for e in ev], "k int, latitude double, longitude double, sample_date date, n int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        zs = zonal_statistics(se, items, cells, covariate_id="sst", cadence="daily", n_days=4, radius=10.0, bands=(1, 2), cell_deg=1.0, place="p")
        flat = unnest(zs.select("k", "n", "p", "zonal_statistics"), "zonal_statistics")
        payload, order = [F.col(c) for c in ("date", "band", "value")], [F.col("date").isNull(), -F.unix_date("date"), F.col("band"), F.col("value")]
        again = nest(flat, ["k"], payload, "rows", order, place="p", whole=F.col("n") == 1)
        moved = [x for x in plan_of(again).splitlines() if re.search(r"Exchange hashpartitioning\(k#", x)]
        assert len(moved) == 1  # of the keys that events share
        got = {r.k: r.rows for r in again.collect()}
        assert again.count() == len(got) == len(set(ks))
        assert got == {r.k: r.rows for r in nest(flat, ["k"], payload, "rows", order).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert any(x.date for x in got[None]) and sum(len(x) for x in got.values()) == flat.count()


def test_events_meet_the_lists_of_their_requests_once(spark):
    """no array made for a key or request is shuffled; a covariate with editions on several days that is asked for
    as "once" gives a row per edition with data."""
    from pyspark.sql import functions as F
    from covspark.plans.enrichment import Request, enrich_long
    cells, items, ev = _slots_case(spark)
    se = spark.createDataFrame([(i, *e[1:]) for i, e in enumerate(ev)], "k int, latitude double, longitude double, sample_date date")
    late = F.col("item_date") > dt.date(2020, 1, 4)
    few = [cells.where(test).withColumn("covariate_id", F.lit(c)) for c, test in (("per", late & (F.dayofmonth("item_date") % 3 == 0)),
                                                                               ("two", F.dayofmonth("item_date").isin(2, 3)))]
    cells = cells.unionByName(few[0]).unionByName(few[1])
    items = cells.select("covariate_id", "item_date").distinct().selectExpr("*", "'i' as item_id")
    asked = [Request("sst", "daily", {1: "a", 2: "b"}, n_days=4, radius=10.0, cell_deg=1.0, name="d4"),
             Request("sst", "daily", {2: "b"}, n_days=2, radius=10.0, cell_deg=1.0, stats=["max"], name="d2"),
             Request("per", "periodic", {1: None}, radius=10.0, cell_deg=1.0, name="p"),
             Request("two", "once", {1: None}, radius=10.0, cell_deg=1.0, name="o")]
    out = enrich_long(se, asked, items, cells)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan[:plan.index("collect_list")].splitlines() if "Join " in x and "strategy=broadcast" not in x]
    assert len(joins) == 1, joins  # events and lists; before, slots and lists met first, and events their result
    got = {}
    for r in out.collect():
        got.setdefault((r.k, r.request), []).append([(x.date and x.date.toordinal(), x.band, x.band_name, x.spatial_stat, x.value) for x in r.zonal_statistics])
    there = {}
    for c in cells.select("covariate_id", "item_date", "band", "cy", "value").collect():
        there.setdefault((c.covariate_id, c.cy), []).append((c.item_date, c.band, c.value))
    for i, (_, lat, lon, day) in enumerate(ev):
        for q in asked:
            own = there.get((q.covariate_id, lat // 1 + 0.5), []) if lat is not None else []
            if q.cadence == "daily":
                own = [x for x in own if day and 0 <= (day - x[0]).days < q.n_days]
            elif q.cadence == "periodic":
                newest = max((x[0] for x in own if day and x[0] <= day), default=None)
                own = [x for x in own if x[0] == newest]
            own = [x for x in own if x[1] in q.bands]
            days = sorted({x[0] for x in own}) if q.cadence == "once" else [None]
            want = []
            for d in days or [None]:
                rows = sorted((x for x in own if d is None or x[0] == d), key=lambda x: (-x[0].toordinal(), x[1]))
                want.append([(x[0].toordinal(), float(x[1]), q.bands[x[1]], q.stats[0], x[2]) for x in rows]
                            + [(None, float(b), n, q.stats[0], None) for b, n in q.bands.items() if b not in {x[1] for x in rows}])
            assert sorted(got[i, q.name], key=str) == sorted(want, key=str), (i, q.name, lat, lon, day)
    assert len(got) == len(ev) * len(asked)
