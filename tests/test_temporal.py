import datetime as dt

from pyspark.sql import functions as F

from covspark.operators import temporal

d = dt.date


def _items(spark, rows):
    return spark.createDataFrame([(c, x, i) for c, x, i in rows],
                                 "covariate_id string, item_date date, item_id string")


def test_asof_cases(spark):
    items = _items(spark, [("a", d(2020, 1, 10), "a1"), ("a", d(2020, 3, 1), "a2"),
                           ("a", d(2020, 3, 1), "a2bis"), ("a", d(2018, 6, 1), "a0")])
    req = spark.createDataFrame(
        [(1, "a", d(2018, 1, 1)),   # before the first item
         (2, "a", d(2020, 1, 10)),  # equal date
         (3, "a", d(2020, 5, 5)),   # tie on the as-of date: both kept
         (4, "a", d(2019, 12, 31)),  # previous year's last item
         (5, "b", d(2020, 1, 1)),   # unknown covariate
         (6, "a", None)],
        "k int, covariate_id string, sample_date date")
    out = temporal.asof_items(req, items, "sample_date")
    got = sorted((r["k"], r["item_id"]) for r in out.collect())
    assert got == [(1, None), (2, "a1"), (3, "a2"), (3, "a2bis"), (4, "a0"), (5, None), (6, None)]


def test_lookback_closed_window(spark):
    items = _items(spark, [("a", d(2020, 1, 1), "i1"), ("a", d(2020, 1, 30), "i30"),
                           ("a", d(2020, 1, 31), "i31"), ("a", d(2019, 12, 31), "i0")])
    req = spark.createDataFrame([(1, "a", d(2020, 1, 30)), (2, "a", d(2019, 1, 1))],
                                "k int, covariate_id string, sample_date date")
    out = temporal.lookback_items(req, items, "sample_date", 30)
    got = sorted((r["k"], r["item_id"] or "") for r in out.collect())
    assert got == [(1, "i1"), (1, "i30"), (2, "")]


def test_once_item_after_sample_date(spark):
    items = _items(spark, [("a", d(2025, 1, 1), "only")])
    req = spark.createDataFrame([(1, "a", d(2000, 1, 1))], "k int, covariate_id string, sample_date date")
    assert temporal.attach_once(req, items).first()["item_id"] == "only"


def test_merge_windows_gap_rule(spark):
    se = spark.createDataFrame(
        [(1, 0.0, 0.0, d(2020, 1, 1)), (2, 0.0, 0.0, d(2020, 1, 31)),   # gap 30 = n: merged
         (3, 0.0, 0.0, d(2020, 3, 2)),                                  # gap 31 > n: new group
         (4, 1.0, 0.0, d(2020, 1, 31)), (5, 1.0, 0.0, d(2020, 1, 31))],  # other site, same day twice
        "k int, latitude double, longitude double, sample_date date")
    out = {r["k"]: (r["start_date"], r["end_date"]) for r in temporal.merge_windows(se, 30).collect()}
    assert out[1] == out[2] == (d(2020, 1, 1), d(2020, 1, 31))
    assert out[3] == (d(2020, 3, 2), d(2020, 3, 2))
    assert out[4] == out[5] == (d(2020, 1, 31), d(2020, 1, 31))
    isl = temporal.window_islands(se, 30, "sample_date").where(F.col("latitude") == 0.0)
    assert isl.count() == 2


def test_cadence_thresholds(spark):
    rows = [("one", d(2020, 1, 1), "x")]
    rows += [("two", d(2020, 1, i), f"t{i}") for i in (1, 2)]
    rows += [("fifty", d(2020, 1, 1) + dt.timedelta(days=i), f"f{i}") for i in range(50)]
    rows += [("many", d(2020, 1, 1) + dt.timedelta(days=i), f"m{i}") for i in range(301)]
    got = {r["covariate_id"]: r["cadence"] for r in temporal.cadence(_items(spark, rows)).collect()}
    assert got == {"one": "once", "two": "periodic", "fifty": "check", "many": "daily"}
    assert [temporal.cadence_for_count(n) for n in (1, 49, 50, 300, 301)] == \
        ["once", "periodic", "check", "check", "daily"]


def test_lookback_keeps_identical_requests(spark):
    items = _items(spark, [("a", d(2020, 1, 5), "i5")])
    req = spark.createDataFrame([(1, "a", d(2020, 1, 6)), (1, "a", d(2020, 1, 6)), (2, "a", d(2021, 1, 1)),
                                 (2, "a", d(2021, 1, 1)), (3, "a", None)],
                                "k int, covariate_id string, sample_date date")
    got = sorted((r["k"], r["item_id"] or "") for r in temporal.lookback_items(req, items, "sample_date", 3).collect())
    assert got == [(1, "i5"), (1, "i5"), (2, ""), (2, ""), (3, "")]


def test_items_between(spark):
    items = _items(spark, [("a", d(2020, 1, i), f"i{i}") for i in range(1, 11)])
    assert temporal.items_between(items, "2020-01-03", "2020-01-05").count() == 3
    assert temporal.items_between(items, start="2020-01-09").count() == 2
    assert temporal.items_between(items, end="2020-01-02").count() == 2


def test_lookback_does_not_multiply_requests_by_days(spark):
    """Requests meet lists of items by slot; before, each was repeated for every day of its window."""
    d = dt.date
    req = spark.createDataFrame([(1, "a", d(2020, 3, 1)), (1, "a", d(2020, 3, 1)), (2, "a", d(2019, 1, 1)), (3, "z", d(2020, 3, 1)), (4, None, d(2020, 3, 1)),
                                 (5, "a", None), (6, "a", d(1969, 12, 31))], "k int, covariate_id string, day date")
    dates = [d(2020, 3, 1), d(2020, 2, 29), d(2020, 2, 1), d(2020, 1, 31), d(2020, 3, 2), d(1969, 12, 2), d(1969, 12, 1)]
    items = spark.createDataFrame([("a", x, f"i{k}") for k, x in enumerate(dates)] + [("a", dates[0], "twin"), ("b", dates[0], "other"), (None, dates[0], "none")],
                                  "covariate_id string, item_date date, item_id string")
    out = temporal.lookback_items(req, items, "day", 30)
    assert "sequence(" not in out._jdf.queryExecution().optimizedPlan().toString()
    hit = [(1, "i0"), (1, "i1"), (1, "i2"), (1, "twin")]
    assert sorted((r.k, r.item_id) for r in out.where("item_id is not null").collect()) == sorted([*hit, *hit, (6, "i5")])
    assert sorted(r.k for r in out.where("item_id is null").collect()) == [2, 3, 4, 5]
    inner = temporal.lookback_items(req, items, "day", 30, keep_unmatched=False)
    assert sorted((r.k, r.item_id) for r in inner.collect()) == sorted([*hit, *hit, (6, "i5")])


def test_asof_drops_items_nobody_asks_for_before_the_shuffle(spark):
    d = dt.date
    req = spark.createDataFrame([(1, "a", d(2020, 3, 1)), (2, "a", d(2019, 1, 1)), (3, None, d(2020, 3, 1)), (4, "a", None)], "k int, covariate_id string, day date")
    items = spark.createDataFrame([("a", d(2020, 2, 1), "i"), ("a", d(2020, 2, 1), "j"), ("a", d(2020, 3, 2), "late"), ("b", d(2020, 2, 1), "x")],
                                  "covariate_id string, item_date date, item_id string").distinct()
    out = temporal.asof_items(req, items, "day")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window "):]
    assert "LeftSemi" in below and below.index("LeftSemi") > below.index("Aggregate")  # under the items' own aggregate
    assert sorted(((r.k, r.item_id) for r in out.collect()), key=repr) == sorted([(1, "i"), (1, "j"), (2, None), (3, None), (4, None)], key=repr)


def test_window_sketches_are_not_multiplied_by_days(spark):
    """Requests meet lists of days by slot; before, each was repeated for every day of its window."""
    from covspark.operators.sketches import daily_sketches, window_quantiles
    rows = [(0.5, 0.5, d(1969, 12, 25) + dt.timedelta(days=k), 1, float(k)) for k in range(20)] + [(0.5, 0.5, d(1970, 1, 3), 1, None)]
    hits = spark.createDataFrame(rows, "latitude double, longitude double, item_date date, band int, value double")
    req = spark.createDataFrame([(0.5, 0.5, d(1970, 1, 4)), (0.5, 0.5, d(1969, 12, 25)), (0.5, 0.5, d(1980, 1, 1)), (9.5, 0.5, d(1970, 1, 4)), (0.5, 0.5, None)],
                                "latitude double, longitude double, sample_date date")
    place = ["latitude", "longitude"]
    out = window_quantiles(req, daily_sketches(hits, [*place, "item_date", "band"]), "sample_date", 5, place)
    assert "sequence(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.sample_date, r.n, r.unique, r.q50) for r in out.collect()) == [(d(1969, 12, 25), 1, 1, 0.0), (d(1970, 1, 4), 5, 5, 8.0)]
