import datetime as dt

import pytest
from pyspark.sql import functions as F

from covspark.operators.reshape import unnest
from covspark.operators.zonal import zonal_aggregate
from covspark.plans.zonal_statistics import zonal_statistics

d = dt.date
CELL_SCHEMA = ("covariate_id string, item_date date, band int, cy double, cx double, "
               "half_deg double, value double")


def _cells(spark, rows):
    return spark.createDataFrame([("c", x, b, cy, cx, 0.5, v) for x, b, cy, cx, v in rows], CELL_SCHEMA)


def _items_of(cells):
    return cells.select("covariate_id", "item_date").distinct().withColumn("item_id", F.lit("i"))


def _events(spark, rows):
    return spark.createDataFrame(rows, "k int, latitude double, longitude double, sample_date date")


def _flat(df):
    return sorted(((r["k"], r["date"], r["band"], r["spatial_stat"], r["value"])
                   for r in unnest(df.select("k", "zonal_statistics"), "zonal_statistics").collect()),
                  key=repr)


def test_statistic_definitions(spark):
    hits = spark.createDataFrame(
        [(1, v, 1.0) for v in (1.0, 2.0, 2.0, 3.0, 3.0, None, 5.0)],
        "g int, value double, cell_area_m2 double")
    stats = ["min", "max", "mean", "count", "sum", "std", "median", "majority", "minority",
             "unique", "range", "nodata", "area", "freq_hist"]
    r = zonal_aggregate(hits, ["g"], stats).first()
    vals = [1, 2, 2, 3, 3, 5]
    mean = sum(vals) / 6
    assert r["min"] == 1 and r["max"] == 5 and r["mean"] == pytest.approx(mean)
    assert r["count"] == 6 and r["sum"] == 16 and r["range"] == 4
    assert r["std"] == pytest.approx((sum((v - mean) ** 2 for v in vals) / 6) ** 0.5)
    assert r["median"] == 2.5
    assert r["majority"] == 2.0      # tie 2 / 3 -> smallest
    assert r["minority"] == 1.0      # tie 1 / 5 -> smallest
    assert r["unique"] == 4 and r["nodata"] == 1 and r["area"] == 6.0
    assert r["freq_hist"] == {1.0: 1, 2.0: 2, 3.0: 2, 5.0: 1}


def test_daily_rows_and_completion(spark):
    cells = _cells(spark, [(d(2020, 1, i), b, 0.5, 0.5, float(i * 10 + b)) for i in range(1, 11) for b in (1, 2)])
    ev = _events(spark, [(1, 0.4, 0.4, d(2020, 1, 10)),    # 5-day window fully covered
                         (2, 0.4, 0.4, d(2019, 1, 1)),     # before coverage
                         (3, 0.4, 0.4, d(2020, 1, 10))])   # identical to 1: kept apart
    zs = zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily", n_days=5,
                          bands=[1, 2], spatial_stats=["mean", "max"], radius=0.0)
    rows = _flat(zs)
    by_k = {k: [r for r in rows if r[0] == k] for k in (1, 2, 3)}
    # invariant: rows = days x bands x stats
    assert len(by_k[1]) == 5 * 2 * 2 and len(by_k[3]) == len(by_k[1])
    # before coverage: one NULL row per band and stat
    assert sorted((r[2], r[3]) for r in by_k[2]) == [(1.0, "max"), (1.0, "mean"), (2.0, "max"), (2.0, "mean")]
    assert all(r[1] is None and r[4] is None for r in by_k[2])
    # nested order: newest date first
    first = zs.where("k = 1").first()["zonal_statistics"][0]
    assert first["date"] == d(2020, 1, 10) and first["band"] == 1.0 and first["spatial_stat"] == "mean"


def test_together_equals_apart(spark):
    day = dt.timedelta(days=1)
    cells = _cells(spark, [(d(2020, 1, 1) + i * day, 1, 0.5, 0.5, float(i)) for i in range(60)])
    items = _items_of(cells)
    evs = [(i, 0.3, 0.3, d(2020, 1, 30) + 7 * i * day) for i in range(5)]   # overlapping windows

    def run(rows):
        zs = zonal_statistics(_events(spark, rows), items, cells, covariate_id="c", cadence="daily",
                              n_days=30, radius=1000.0)
        return _flat(zs)

    together = run(evs)
    apart = sorted((r for e in evs for r in run([e])), key=repr)
    assert together == apart
    assert len([r for r in together if r[0] == 4]) == 30


def test_periodic_and_once(spark):
    cells = _cells(spark, [(d(2000, 1, 1), 1, 0.5, 0.5, 1.0), (d(2005, 1, 1), 1, 0.5, 0.5, 2.0)])
    items = _items_of(cells)
    ev = _events(spark, [(1, 0.5, 0.5, d(2004, 6, 1)), (2, 0.5, 0.5, d(1999, 1, 1)),
                         (3, 0.5, 0.5, d(2005, 1, 1))])
    zs = zonal_statistics(ev, items, cells, covariate_id="c", cadence="periodic", radius=0.0)
    got = {r[0]: (r[1], r[4]) for r in _flat(zs)}
    assert got == {1: (d(2000, 1, 1), 1.0), 2: (None, None), 3: (d(2005, 1, 1), 2.0)}
    one = cells.where("value = 2.0")
    zs = zonal_statistics(ev, _items_of(one), one, covariate_id="c", cadence="once", radius=0.0)
    assert {r[4] for r in _flat(zs)} == {2.0}


def test_empty_input_keeps_schema(spark):
    cells = _cells(spark, [(d(2020, 1, 1), 1, 0.5, 0.5, 1.0)])
    ev = _events(spark, [])
    zs = zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily", n_days=3,
                          radius=0.0)
    assert zs.count() == 0
    assert "zonal_statistics" in zs.columns and "k" in zs.columns


def test_bad_arguments(spark):
    cells = _cells(spark, [(d(2020, 1, 1), 1, 0.5, 0.5, 1.0)])
    ev = _events(spark, [(1, 0.5, 0.5, d(2020, 1, 1))])
    with pytest.raises(ValueError):
        zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily")
    with pytest.raises(ValueError):
        zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="check", n_days=3)
    with pytest.raises(ValueError):
        zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily", n_days=3,
                         spatial_stats=["mean", "mode"])


def test_result_sink_roundtrip(spark, tmp_path):
    from covspark.sources.catalog import write_table
    cells = _cells(spark, [(d(2020, 1, i), 1, 0.5, 0.5, float(i)) for i in range(1, 6)])
    ev = _events(spark, [(1, 0.4, 0.4, d(2020, 1, 5)), (2, 9.0, 9.0, d(2020, 1, 5))])
    zs = zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily", n_days=3,
                          radius=0.0)
    path = str(tmp_path / "zs")
    write_table(zs, path)
    back = spark.read.parquet(path)
    assert _flat(back) == _flat(zs)


def test_empty_window_inside_merged_group_keeps_null_rows(spark):
    cells = _cells(spark, [(d(2020, 1, i), 1, 0.5, 0.5, float(i)) for i in range(1, 6)])
    # gap of 5 days = n_days: both events share one merged group, only A has data
    ev = _events(spark, [(1, 0.4, 0.4, d(2020, 1, 5)), (2, 0.4, 0.4, d(2020, 1, 10))])
    zs = zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily", n_days=5,
                          radius=0.0)
    rows = _flat(zs)
    assert len([r for r in rows if r[0] == 1]) == 5
    assert [r for r in rows if r[0] == 2] == [(2, None, 1.0, "mean", None)]


def test_null_date_and_output_rounding(spark):
    cells = _cells(spark, [(d(2020, 1, i), 1, 0.5, 0.5, float(i)) for i in range(1, 6)])
    ev = _events(spark, [(1, 0.4000004, 0.4, d(2020, 1, 5)), (2, 0.4, 0.4, None)])
    zs = zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily", n_days=2,
                          radius=0.0)
    rows = _flat(zs)
    assert [r for r in rows if r[0] == 2] == [(2, None, 1.0, "mean", None)]
    assert {r["k"]: r["latitude"] for r in zs.collect()}[1] == 0.4000004   # untouched by default
    zs5 = zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily", n_days=2,
                           radius=0.0, output_rounding=5)
    assert {r["k"]: r["latitude"] for r in zs5.collect()}[1] == 0.4


def test_cell_store_gives_same_results(spark, tmp_path):
    from covspark.sources.catalog import write_cell_store
    cells = _cells(spark, [(d(2020, 1, i), b, 0.5 + i, 0.5, float(i * b)) for i in range(1, 8) for b in (1, 2)])
    path = str(tmp_path / "cells")
    write_cell_store(cells, path)
    stored = spark.read.parquet(path)
    ev = _events(spark, [(1, 3.2, 0.4, d(2020, 1, 6)), (2, 6.1, 0.2, d(2020, 1, 7))])

    def run(c):
        return _flat(zonal_statistics(ev, _items_of(c), c, covariate_id="c", cadence="daily", n_days=4,
                                      bands=[1, 2], radius=120000.0))

    assert run(stored) == run(cells)


def test_cell_store_scan_prunes_dates_and_tiles(spark, tmp_path):
    from covspark.sources.catalog import write_cell_store
    cells = _cells(spark, [(d(2020, 1, i), 1, 0.5 + 7 * i, 0.5 + 20 * i, float(i)) for i in range(1, 8)])
    path = str(tmp_path / "cells")
    write_cell_store(cells, path)
    ev = _events(spark, [(1, 21.2, 60.4, d(2020, 1, 6))])
    out = zonal_statistics(ev, _items_of(cells), spark.read.parquet(path), covariate_id="c", cadence="daily", n_days=4)
    assert _flat(out) == [(1, d(2020, 1, 3), 1.0, "mean", 3.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "coarse_tile" in plan.split("PartitionFilters")[1]


@pytest.mark.parametrize("cadence", ["daily", "periodic", "once"])
def test_listed_editions_count_and_stay_apart(spark, cadence):
    """Two listed editions of one date stay apart; a third of that date that no item lists doesn't count."""
    rows = [(d(2020, 1, 1), 1, 0.5, 0.5, v) for v in (1.0, 3.0, 100.0)]
    cells = _cells(spark, rows).withColumn("item_id", F.concat(F.lit("i"), F.col("value").cast("string")))
    items = cells.select("covariate_id", "item_date", "item_id").where("value < 50").distinct()
    ev = _events(spark, [(1, 0.4, 0.4, d(2020, 1, 2))])
    out = _flat(zonal_statistics(ev, items, cells, covariate_id="c", cadence=cadence, n_days=3))
    assert sorted(r[-1] for r in out) == [1.0, 3.0]


def test_hot_site_with_forced_skew_splitting(spark):
    """One site holds most events; AQE is made to split skewed partitions."""
    cells = _cells(spark, [(d(2020, 1, 1) + dt.timedelta(days=i), 1, 0.5, 0.5, float(i)) for i in range(40)])
    hot = [(i, 0.4, 0.4, d(2020, 1, 10) + dt.timedelta(days=i % 25)) for i in range(300)]
    cold = [(1000 + i, 0.4 + i, 0.4, d(2020, 1, 20)) for i in range(5)]
    ev = _events(spark, hot + cold)

    def run():
        return _flat(zonal_statistics(ev, _items_of(cells), cells, covariate_id="c", cadence="daily",
                                      n_days=7, radius=0.0))

    base = run()
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert run() == base
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len([r for r in base if r[0] < 1000]) == 300 * 7


def test_events_meet_their_slot_once(spark):
    """No array is made and shuffled for each event key: the events join the lists of their slot directly, which hold
    the slot before too.  Windows that cross a slot, dates before 1970, two editions a band and absent bands."""
    rows = [("sst", dt.date(1969, 12, 20) + dt.timedelta(days=i), b, 0.5, 0.5, 0.5, float(10 * i + b)) for i in range(40) for b in (1, 2)]
    cells = spark.createDataFrame(rows, "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double")
    items = cells.select("covariate_id", "item_date", F.lit("i").alias("item_id")).distinct()
    ev = [(k, 0.2, 0.2, dt.date(1969, 12, 15) + dt.timedelta(days=k)) for k in range(50)] + [(99, 0.2, 0.2, None), (98, None, 0.2, dt.date(1970, 1, 1))]
    se = spark.createDataFrame(ev, "k int, latitude double, longitude double, sample_date date")
    out = zonal_statistics(se, items, cells, covariate_id="sst", cadence="daily", n_days=7, radius=10.0, bands=(1, 2, 3), spatial_stats=["max", "count"],
                           cell_deg=1.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = plan[:plan.index("collect_list")]
    assert joins.count("Join ") == 1, plan  # events and slot lists; before, keys and slots were joined and grouped again
    for r in out.collect():
        got = [(x.date, x.band, x.spatial_stat, x.value) for x in r.zonal_statistics]
        mine = [x for x in rows if r.sample_date and r.latitude and 0 <= (r.sample_date - x[1]).days < 7]
        want = [(x[1], float(x[2]), s, v) for x in sorted(mine, key=lambda x: (-x[1].toordinal(), x[2])) for s, v in (("max", x[6]), ("count", 1.0))]
        want += [(None, float(b), s, None) for b in (1, 2, 3) if b not in {x[2] for x in mine} for s in ("max", "count")]
        assert got == want, r
