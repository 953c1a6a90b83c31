"""Temporal matching of sample events to covariate items.

All joins here are equi-joins: ranges are turned into keys (calendar days,
years) so Catalyst never falls back to a nested-loop or cartesian plan, and
AQE can split a hot key on the big side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Item-count thresholds of the cadence rule.
ONCE_MAX_ITEMS = 1
PERIODIC_MAX_ITEMS = 49
CHECK_MAX_ITEMS = 300
# Largest catalogue-side table broadcast after a count.
BROADCAST_MAX_ROWS = 2_000_000


def cadence_expr(n_items: Column) -> Column:
    """Item count -> once / periodic / check / daily."""
    return (F.when(n_items == ONCE_MAX_ITEMS, F.lit("once"))
            .when((n_items > ONCE_MAX_ITEMS) & (n_items <= PERIODIC_MAX_ITEMS), F.lit("periodic"))
            .when((n_items > PERIODIC_MAX_ITEMS) & (n_items <= CHECK_MAX_ITEMS), F.lit("check"))
            .when(n_items > CHECK_MAX_ITEMS, F.lit("daily")))


def cadence_for_count(n: int) -> str:
    """Driver-side twin of ``cadence_expr`` for one covariate's item count."""
    if n == ONCE_MAX_ITEMS:
        return "once"
    if n <= PERIODIC_MAX_ITEMS:
        return "periodic"
    if n <= CHECK_MAX_ITEMS:
        return "check"
    return "daily"


def cadence(items: DataFrame, key: str = "covariate_id") -> DataFrame:
    """One row per covariate: number of items and cadence (partial + final agg)."""
    return (items.groupBy(key).agg(F.count(F.lit(1)).alias("n_items"))
            .withColumn("cadence", cadence_expr(F.col("n_items"))))


def items_between(items: DataFrame, start=None, end=None) -> DataFrame:
    """Items dated in the closed interval [start, end]; either end may be
    open.  A plain filter: on a date-partitioned item or cell table it prunes
    partitions, on Parquet it is pushed to the scan."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("item_date") >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col("item_date") <= F.lit(end).cast("date"))
    return items.where(cond)


def attach_once(requests: DataFrame, items: DataFrame, key: str = "covariate_id") -> DataFrame:
    """Every request gets the covariate's items whatever its date (cadence once).

    Equi-join on the covariate key; the item side holds one row per
    covariate, so a hot covariate is a skewed left side that AQE splits.
    """
    it = items.select(key, F.col("item_date"), F.col("item_id"))
    return requests.join(it, on=key, how="left")


def asof_pairs(dates: DataFrame, items: DataFrame, date_col: str, key: str = "covariate_id") -> DataFrame:
    """(key, date_col, item_date): for each distinct (key, date) the latest item date on or before it, if any.

    One sorted pass: dates and item dates of a key are merged and the last item date is carried forward.  Both are
    distinct, so a key holds at most two rows a calendar day however many requests or items it has.
    """
    asked = dates.select(key, F.col(date_col).cast("date").alias("_d"), F.lit(None).cast("date").alias("_i"))
    there = items.select(key, F.col("item_date").cast("date").alias("_d"))
    both = asked.unionByName(there.withColumn("_i", F.col("_d"))).where(F.col("_d").isNotNull())
    both = both.groupBy(key, "_d").agg(F.max("_i").alias("_i"), F.max(F.col("_i").isNull()).alias("_asked"))
    w = Window.partitionBy(key).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("item_date", F.last("_i", ignorenulls=True).over(w))
    return carried.where("_asked and item_date is not null").select(key, F.col("_d").alias(date_col), "item_date")


def asof_items(requests: DataFrame, items: DataFrame, date_col: str,
               key: str = "covariate_id") -> DataFrame:
    """Backward as-of left join: the latest item with item_date <= the request date.

    Ties on the item date are all kept; no item on or before the date gives
    NULL item columns.  The edition depends only on (key, date): the distinct
    pairs asked for and the editions (tied item ids as one array) are merged in
    one sorted pass that carries the last edition forward, and the requests are
    shuffled once, to meet their pair.
    """
    it = asked_only(items, requests, key).select(key, F.col("item_date").cast("date").alias("item_date"), "item_id").where(F.col("item_date").isNotNull())
    ties = it.groupBy(key, "item_date").agg(F.collect_list(F.struct("item_id")).alias("_ids"))
    there = ties.select(key, F.col("item_date").alias("_d"), F.col("_ids"), F.lit(False).alias("_asked"))
    asked = requests.select(key, F.col(date_col).cast("date").alias("_d")).where("_d is not null").distinct()
    both = asked.withColumns({"_ids": F.lit(None), "_asked": F.lit(True)}).unionByName(there)
    w = Window.partitionBy(key).orderBy("_d", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    edition = F.when(~F.col("_asked"), F.struct(F.col("_d").alias("item_date"), "_ids"))
    found = both.withColumn("_e", F.last(edition, ignorenulls=True).over(w)).where("_asked and _e is not null")
    found = found.select(key, F.col("_d").alias("_asof_d"), "_e.item_date", "_e._ids")
    r = requests.withColumn("_asof_d", F.col(date_col).cast("date"))
    out = r.join(found, [key, "_asof_d"], "left").drop("_asof_d")
    return out.select("*", F.explode_outer("_ids").alias("_it")).select("*", "_it.item_id").drop("_ids", "_it")


def asked_only(items: DataFrame, requests: DataFrame, key: str = "covariate_id") -> DataFrame:
    """The items of covariates that some request names, by a broadcast semi-join (which runs before the items are
    shuffled) when these are counted few, by a filter when it is one (a join on a literal would be a nested loop); else all items."""
    named = requests.select(key).distinct()
    n, one = named.limit(BROADCAST_MAX_ROWS + 1).agg(F.count("*"), F.max(key)).first()
    if n > BROADCAST_MAX_ROWS:
        return items
    if n == 1:
        return items.where(F.col(key) == F.lit(one))
    return items.join(F.broadcast(named), key, "left_semi")


def spread(df: DataFrame, *cols) -> DataFrame:
    """Hash ``df`` over ``spark.sql.shuffle.partitions`` partitions on
    ``cols`` (default: all columns).

    Used right before an explode that multiplies rows: AQE sizes partitions
    from the small pre-explode data and would otherwise coalesce it into a
    handful of tasks that then do all the exploded work.  An explicit
    partition count is not coalesced.  The inputs are distinct keys, so even
    a hot location spreads over its dates; hashing (unlike round-robin) gives
    the same partitions when a lost task is recomputed.  The hash is an
    expression, not the bare key columns, so the planner cannot drop the
    repartition as redundant after an aggregate on the same keys.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(*[F.col(c) for c in (cols or df.columns)]))


def window_days(date: Column, n_days: int) -> Column:
    """ARRAY<DATE> of the closed lookback window [date-(n_days-1), date]."""
    return F.sequence(F.date_sub(date, n_days - 1), date)


def lookback_items(requests: DataFrame, items: DataFrame, date_col: str, n_days: int,
                   key: str = "covariate_id", keep_unmatched: bool = True) -> DataFrame:
    """Left range join: every item with item_date in [date-(n_days-1), date].

    The calendar is cut into slots of ``n_days`` days: a window ends in one and
    begins there or in the one before.  Each item is listed in its own slot and
    in the next, so a request meets one list, by an equi-join on (covariate,
    slot), and picks its days there; requests are never multiplied before that.
    A list holds the items of 2 x ``n_days`` days of a covariate; a covariate
    asked for very often is a skewed key, which AQE splits.  Requests with no
    item in the window keep one row with NULL item columns (``keep_unmatched``),
    identical requests all kept.
    """
    if n_days is None or n_days < 1:
        raise ValueError("n_days must be a positive number of days")
    cols = requests.columns
    slot = lambda day: F.floor(F.unix_date(day) / F.lit(n_days)).cast("long")
    day = F.col("item_date").cast("date")
    it = asked_only(items, requests, key).where(F.col("item_date") == day)
    own = slot(day)
    it = it.select(F.col(key).alias("_k"), "item_date", "item_id", F.explode(F.array(own, own + 1)).alias("_s"))
    # the key as one struct: the join then shuffles both sides, and AQE can split a hot key
    lists = it.groupBy(F.struct("_k", "_s").alias("_at")).agg(F.collect_list(F.struct("item_date", "item_id")).alias("_its")).select("_at.*", "_its")
    d = F.col(date_col).cast("date")
    asked = requests.withColumn("_slot", slot(d))
    out = asked.join(lists, (F.col(key) == F.col("_k")) & (F.col("_slot") == F.col("_s")), "left" if keep_unmatched else "inner")
    its = F.filter("_its", lambda i: i["item_date"].between(F.date_sub(d, n_days - 1), d))
    out = out.select(*cols, (F.explode_outer if keep_unmatched else F.explode)(its).alias("_it"))
    found = [F.col("_it.item_date").alias("item_date"), F.col("_it.item_id").alias("item_id")]
    if keep_unmatched:
        return out.select(*cols, *found)
    return out.select(key, found[0], *[c for c in cols if c != key], found[1])


def _islands_of(days: DataFrame, n_days, loc: list[str], d: str) -> DataFrame:
    """Group number per distinct (location, date): a new group at the first
    date and wherever the gap to the previous date exceeds ``n_days``."""
    w = Window.partitionBy(*loc).orderBy(d)
    gap = F.datediff(F.col(d), F.lag(d).over(w))
    days = days.withColumn("_start", F.coalesce(gap > n_days, F.lit(True)).cast("int"))
    return days.withColumn("_grp", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def window_islands(df: DataFrame, n_days, date_col: str,
                   loc_cols=("latitude", "longitude")) -> DataFrame:
    """Merged lookback windows per location: (location, start_date, end_date),
    one row per island.  Islands are disjoint and never adjacent, so
    exploding ``[start_date-(n_days-1), end_date]`` yields each needed
    (location, day) exactly once.  ``n_days`` may be a column among ``loc_cols``.

    The window runs over distinct (location, date) pairs: a location holds
    at most one row per calendar day however many samples it has.
    """
    loc = list(loc_cols)
    days = (df.select(*loc, F.col(date_col).cast("date").alias("_d"))
            .where(F.col("_d").isNotNull()).distinct())
    g = _islands_of(days, n_days, loc, "_d")
    return g.groupBy(*loc, "_grp").agg(F.min("_d").alias("start_date"),
                                       F.max("_d").alias("end_date")).drop("_grp")


def merge_windows(se: DataFrame, n_days: int, date_col: str = "sample_date",
                  loc_cols=("latitude", "longitude")) -> DataFrame:
    """Gaps and islands: merge lookback windows of one location.

    Samples are ordered by date within a location; a new group starts at the
    first sample and wherever the gap to the previous sample exceeds
    ``n_days``.  Adds ``start_date`` / ``end_date`` (group bounds) to every row.

    The window runs over distinct (location, date) pairs, so a location with
    millions of samples still holds at most one row per calendar day; the
    bounds are joined back on (location, date).
    """
    loc = list(loc_cols)
    d = F.col(date_col).cast("date")
    days = se.select(*loc, d.alias("_d")).where(F.col("_d").isNotNull()).distinct()
    days = _islands_of(days, n_days, loc, "_d")
    g = Window.partitionBy(*loc, "_grp")
    days = (days.withColumn("start_date", F.min("_d").over(g))
            .withColumn("end_date", F.max("_d").over(g))
            .drop("_start", "_grp"))
    out = se.withColumn("_d", d).join(days, on=[*loc, "_d"], how="left").drop("_d")
    return out


def relevant_only(arr: Column, date: Column, n_days: int) -> Column:
    """Keep nested rows dated inside the event's own window, or undated."""
    lo = F.date_sub(date, n_days - 1)
    return F.filter(arr, lambda x: x["date"].isNull() | ((x["date"] >= lo) & (x["date"] <= date)))


def first_item(items: DataFrame, key: str = "covariate_id") -> DataFrame:
    """One item per covariate, the latest dated (ties broken by item id).

    The catalogue serves its newest item first; we fix that order.  Uses a
    max over a struct (partial aggregation) instead of a window, so a
    covariate with many items never lands whole in one task.
    """
    best = F.max(F.struct(F.col("item_date"), F.col("item_id"))).alias("_b")
    return (items.groupBy(key).agg(best)
            .select(key, F.col("_b.item_date").alias("item_date"), F.col("_b.item_id").alias("item_id")))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row, with their count (request-key check)."""
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))
