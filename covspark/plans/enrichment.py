"""The zonal core: a table of requests joined to events, one spatial join and one aggregate for all of them.

A request names a covariate's raster (covariate, dataset, bands), a disc (radius), statistics and a cadence.  Plan,
all lazy, of the same size for any number of requests::

    events --distinct--> keys (lat, lon, date) --x requests (an exploded number, joined to the request table)
    keys + items --match by cadence--> slots of each key; (source, lat, lon, item) needed
    needed --tiles of the source's own level, join with the cells on (slot, tile), date and distance test--> hits
           --one aggregate--> statistics per (source, lat, lon, item, band)
           --nested per slot, with the slot before, newest first--> joined to the events' (or keys') slots, cut to the window

A source is what requests can share: covariate, dataset, radius and cadence; its bands, statistics and window are the
union of theirs, so two requests for one raster cost one pass.  A slot is a stretch of ``n_days`` calendar days of a
location (daily) or one edition (once, periodic).  A key's lookback window ends in its slot and begins there or in the
slot before, so each edition is listed in its own slot and in the next, and a key meets one array: the events of one
request are joined to it directly, and no array made for a single key is ever shuffled.

Matching:

* daily - overlapping windows of a location are merged (``temporal.window_islands``); a merged window is one row per slot
  it touches, with its first and last day, and never one per day;
* periodic - the latest edition on or before the date, found for the distinct (covariate, date) pairs;
* once - the covariate's only edition, whatever the date, also for events without one.

Editions are items: where the cells name their item (``item_id``), only cells of listed items count, and editions of
one date stay apart.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covspark import session
from covspark.functions import geo
from covspark.operators import temporal
from covspark.operators.spatial import (COARSE_TILE_DEG, TILES_PER_DISC, Z_ASK_LEVEL, Z_LEVEL, cell_half_sizes, cell_tiles, coarse_tile_id,
                                        default_tile_col, disc_tiles, estimated_bytes, sized, z_tiles)
from covspark.operators.zonal import check_stats, zonal_aggregate

# Stands for a missing date in keys, so that joins need no null-safe comparison.
_NO_DATE = "0001-01-01"
_KEY = ["_lat", "_lon", "_day"]


@dataclass
class Request:
    """One resolved request; ``bands`` maps band numbers to labels (None: bands without names)."""
    covariate_id: str
    cadence: str
    bands: dict
    title: str | None = None
    stats: list = field(default_factory=lambda: ["mean"])
    radius: float = 100.0
    n_days: int | None = None
    dataset: str | None = None
    cell_deg: float = 0.0
    name: str | None = None

    def __post_init__(self):
        self.stats = check_stats(self.stats)
        self.title = self.title if self.title is not None else self.covariate_id
        if self.cadence not in ("once", "periodic", "daily"):
            raise ValueError(f"cadence {self.cadence!r} needs an explicit once/periodic/daily choice")
        if self.cadence == "daily" and not self.n_days:
            raise ValueError("a daily covariate needs `n_days`, the length of its window")
        if not self.bands:
            raise ValueError("bands must not be empty")
        if self.radius < 0:
            raise ValueError("radius must be >= 0")

    @property
    def source(self):
        return (self.covariate_id, self.dataset, float(self.radius), self.cadence)


def event_key(se: DataFrame, date_col: str, round_digits: int = 5) -> DataFrame:
    """``se`` with the request key (_lat, _lon, _day); a missing date is a fixed one."""
    return (se.withColumn("_lat", F.bround(F.col("latitude").cast("double"), round_digits))
            .withColumn("_lon", F.bround(F.col("longitude").cast("double"), round_digits))
            .withColumn("_day", F.coalesce(F.col(date_col).cast("date"), F.lit(_NO_DATE).cast("date"))))


_TYPES = {"req": "int", "src": "int", "request": "string", "title": "string", "n_days": "int", "cadence": "string", "span": "int",
          "bands": "array<struct<band:int,name:string>>", "stats": "array<string>", "covariate_id": "string", "dataset": "string",
          "radius": "double", "band_set": "array<int>", "cell_deg": "double"}


def _tables(requests: list[Request]) -> tuple[list[dict], list[dict]]:
    """The rows of the request table and of the source table: as many as the caller has written down."""
    sources: dict[tuple, list[Request]] = {}
    for r in requests:
        sources.setdefault(r.source, []).append(r)
    src = [dict(src=k, covariate_id=cid, dataset=ds, radius=radius, cadence=cad, span=max(int(r.n_days or 1) for r in own) if cad == "daily" else 1,
                band_set=sorted({int(b) for r in own for b in r.bands}), cell_deg=max(float(r.cell_deg or 0.0) for r in own))
           for k, ((cid, ds, radius, cad), own) in enumerate(sources.items())]
    of = {key: row for key, row in zip(sources, src)}
    req = [dict(req=k, src=of[r.source]["src"], covariate_id=r.covariate_id, cadence=r.cadence, span=of[r.source]["span"], n_days=int(r.n_days or 1),
                request=str(r.name if r.name is not None else k), title=r.title, bands=[(int(b), n) for b, n in r.bands.items()], stats=list(r.stats))
           for k, r in enumerate(requests)]
    return req, src


def _literal(value, kind: str) -> Column:
    if isinstance(value, list):
        one = lambda v: F.struct(F.lit(v[0]), F.lit(v[1])) if isinstance(v, tuple) else F.lit(v)
        return F.array(*[one(v) for v in value]).cast(kind)
    return F.lit(value).cast(kind)


def _local(spark, rows: list[dict], names: list[str]) -> DataFrame:
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} {_TYPES[n]}" for n in names))


def _attach(df: DataFrame, rows: list[dict], key: str, names: list[str]) -> DataFrame:
    """``df`` with columns of a request or source table, by ``key``: literals of its only row, else a broadcast join
    (one row per request the caller has written down)."""
    if len(rows) == 1:
        return df.withColumns({n: _literal(rows[0][n], _TYPES[n]) for n in names})
    return df.join(F.broadcast(_local(df.sparkSession, rows, [key, *names])), key)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _tiles(df: DataFrame, cells: DataFrame, src: list[dict], tile_deg: float | None) -> DataFrame:
    """``df`` (src) with its source's radius, largest cell and tile size.  Cell sizes that aren't given come from one
    aggregate over the size columns, a row per covariate, inside the plan."""
    df = _attach(df, src, "src", ["covariate_id", "radius", "cell_deg"])
    if not all(r["cell_deg"] for r in src):
        half_h, half_w = cell_half_sizes(cells)
        largest = (2.0 * F.max(F.greatest(half_h, half_w))).alias("_size")
        if len(src) == 1:
            df = df.withColumn("_size", cells.agg(largest).scalar())
        else:
            df = df.join(F.broadcast(cells.groupBy("covariate_id").agg(largest)), "covariate_id", "left")  # one row per covariate asked for
        df = df.withColumn("cell_deg", F.when(F.col("cell_deg") > 0, F.col("cell_deg")).otherwise(F.coalesce("_size", F.lit(0.0)))).drop("_size")
    own = default_tile_col(F.col("radius"), F.col("cell_deg"))
    if tile_deg is not None:
        own = geo.tile_size_col(F.greatest(F.lit(float(tile_deg)), F.col("cell_deg")))
    return df.withColumn("tile_deg", own)


def _all_stats(requests: list[Request]) -> list[str]:
    """The statistics of a date and band, in the order they are first asked for."""
    return list(dict.fromkeys(s for r in requests for s in r.stats))


@dataclass
class Matched:
    """``slots``: req, src, key, [first, last] days of the window, its last slot; ``wide``: statistics per src, location, edition,
    slot, band; ``dates``: the editions' dates of each covariate."""
    slots: DataFrame
    wide: DataFrame
    req: list
    src: list
    stats: list
    modes: set
    by_item: bool
    dates: DataFrame


def matched(se: DataFrame, requests: list[Request], items: DataFrame, cells: DataFrame, *, date_col: str = "sample_date",
            round_digits: int = 5, tile_deg: float | None = None, approx_stats: bool = False) -> Matched:
    """The match, the spatial join and the aggregate of all requests."""
    req, src = _tables(requests)
    modes = {r.cadence for r in requests}
    ids = sorted({r.covariate_id for r in requests})
    by_item = "item_id" in cells.columns
    edition = ["item_date", *(["item_id"] if by_item else [])]
    stats = _all_stats(requests)

    keys = event_key(se, date_col, round_digits).select(*_KEY).distinct()
    listed = items.where(F.col("covariate_id").isin(ids)).select(
        "covariate_id", F.col("item_date").cast("date").alias("item_date"), *edition[1:]).where("item_date is not null")
    # at most one row per calendar day of a covariate asked for
    dates = listed.select("covariate_id", "item_date").distinct()
    n = len(requests)
    # a request number is exploded, not joined: the request table then joins on it
    asked = keys.select(*_KEY, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("req")) if n > 1 else keys.withColumn("req", F.lit(0))
    asked = _attach(asked, req, "req", ["src", "covariate_id", "cadence", "n_days", "span"])

    # -- matching: slots of each key; days [lo, hi] of a slot needed at each location
    slots, wanted = [], []
    slot = lambda day: F.floor(day / F.col("span")).cast("long")
    if "daily" in modes:
        daily = asked.where((F.col("cadence") == "daily") & (F.col("_day") != F.lit(_NO_DATE).cast("date")))
        last, first = F.unix_date("_day"), F.unix_date("_day") - F.col("n_days") + 1
        slots.append(daily.select("req", "src", *_KEY, first.alias("first"), last.alias("last"), slot(last).alias("slot")))
        isl = temporal.window_islands(daily, F.col("span"), "_day", ["src", "span", "_lat", "_lon"])
        isl = isl.select("src", "span", "_lat", "_lon", (F.unix_date("start_date") - F.col("span") + 1).alias("lo"), F.unix_date("end_date").alias("hi"))
        wanted.append(isl.select("src", "_lat", "_lon", "lo", "hi", F.explode(F.sequence(slot(F.col("lo")), slot(F.col("hi")))).alias("slot")))
    for mode in sorted(modes - {"daily"}):
        some = asked.where(F.col("cadence") == mode)
        # periodic: the edition depends only on (covariate, date); few pairs, bounded by calendar days
        if mode == "once" and n == 1:
            hit = some.withColumn("item_date", _only_date(dates)).where("item_date is not null")
        elif mode == "once":
            hit = some.join(F.broadcast(dates), "covariate_id")
        else:
            hit = some.join(F.broadcast(temporal.asof_pairs(some.select("covariate_id", "_day"), dates, "_day", "covariate_id")), ["covariate_id", "_day"])
        day, none = F.unix_date("item_date"), F.lit(None).cast("int")
        slots.append(hit.select("req", "src", *_KEY, none.alias("first"), none.alias("last"), day.cast("long").alias("slot")))
        wanted.append(hit.select("src", "_lat", "_lon", day.alias("lo"), day.alias("hi"), day.cast("long").alias("slot")).distinct())
    slots, wanted = _union(slots), _union(wanted)

    # -- cells: only what some request needs, tiled at their sources' own level
    c = cells.where(F.col("covariate_id").isin(ids) & F.col("band").isin(sorted({int(b) for r in requests for b in r.bands})))
    c = _needed_editions(c, asked, dates, requests, modes)
    if by_item:
        c = c.join(listed.distinct(), ["covariate_id", *edition], "left_semi")
    sizes = cells.where(F.col("covariate_id").isin(ids))
    if {"coarse_tile", "zkey"} & set(c.columns):
        c = _needed_places(c, _tiles(wanted.select("src", "_lat", "_lon").distinct(), sizes, src, tile_deg))
    half_h, half_w = cell_half_sizes(c)
    own_set = F.col("dataset").alias("_ds") if "dataset" in cells.columns else F.lit(None).cast("string").alias("_ds")
    c = c.select("covariate_id", *edition, own_set, "band", "cx", "cy", half_h.alias("_hh"), half_w.alias("_hw"), "value")
    if len(src) == 1:
        c = _attach(c.drop("covariate_id"), src, "src", ["src", "dataset", "span", "band_set"])
    else:  # a cell once per source of its covariate
        c = c.join(F.broadcast(_local(c.sparkSession, src, ["src", "covariate_id", "dataset", "span", "band_set"])), "covariate_id").drop("covariate_id")
    c = c.where(F.array_contains("band_set", F.col("band").cast("int")) & (
        F.col("dataset").isNull() | F.col("_ds").isNull() | (F.col("_ds") == F.col("dataset"))))
    c = _tiles(c.withColumn("slot", slot(F.unix_date("item_date"))), sizes, src, tile_deg)
    p = _tiles(wanted.where("_lat is not null and _lon is not null"), sizes, src, tile_deg)
    # the side with fewer estimated bytes is repeated per tile; a key needs two slots at most
    few, many = 2 * len(requests) * estimated_bytes(keys), estimated_bytes(cells)
    tile_of = lambda x, y: (geo.tile_x(F.col(x), F.col("tile_deg")).alias("tx"), geo.tile_y(F.col(y), F.col("tile_deg")).alias("ty"))
    of_cell = ["src", *edition, "slot", "band", "cx", "cy", "_hh", "_hw", "value"]
    of_point = ["src", "_lat", "_lon", "slot", "lo", "hi", "radius"]
    if few <= many:
        c = c.select(*of_cell, *tile_of("cx", "cy"))
        p = sized(disc_tiles(p, "_lat", "_lon", F.col("radius"), F.col("cell_deg"), F.col("tile_deg")).select(*of_point, "tx", "ty"), few * TILES_PER_DISC)
    else:
        c = sized(cell_tiles(c, F.col("radius"), F.col("tile_deg")).select(*of_cell, "tx", "ty"), many * TILES_PER_DISC)
        p = p.select(*of_point, *tile_of("_lon", "_lat"))
    cell = (F.col("_lat"), F.col("_lon"), F.col("cy"), F.col("cx"), F.col("_hh"), F.col("_hw"))
    radii = {float(r.radius) for r in requests}
    inside, near = geo.cell_contains(*cell), geo.cell_distance_m(*cell) <= F.col("radius")
    touch = inside if radii == {0.0} else near if 0.0 not in radii else F.when(F.col("radius") == 0, inside).otherwise(near)
    hits = c.join(p, ["src", "slot", "tx", "ty"]).where(F.unix_date("item_date").between(F.col("lo"), F.col("hi"))).where(touch)
    hits = hits.withColumn("cell_area_m2", geo.cell_area_m2(F.col("cy"), F.col("_hh"), F.col("_hw")))

    group = ["src", "_lat", "_lon", *edition, "slot", "band"]
    return Matched(slots, zonal_aggregate(hits, group, stats, approx_stats), req, src, stats, modes, by_item, dates)


def _only_date(dates: DataFrame) -> Column:
    """The date of a covariate with one edition (NULL without any)."""
    return dates.agg(F.max("item_date")).scalar()


def _at(src, lat: str, lon: str, slot) -> Column:
    """A slot of a location as one text, NULL without any of its parts.  Lists are dealt by it where they are made, and what
    meets them comes there: a key of doubles is shuffled again for each grouping and join."""
    place = [F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)) for c in (lat, lon)]  # one zero
    return F.concat(*[F.concat(x.cast("string"), F.lit("/")) for x in (src, *place)], slot.cast("string"))


def _slot_lists(m: Matched, by_edition: bool = True) -> DataFrame:
    """(at, src, rows): the statistics of each slot (``_at``) and, daily, of the slot before it, newest first; a row holds ``o``
    (minus the day), [item_id], band and one field per statistic.  ``by_edition`` False: a covariate with one edition has one
    list a location, whatever the date."""
    daily = [r["src"] for r in m.src if r["cadence"] == "daily"]
    own = F.col("slot")
    slots = F.when(F.col("src").isin(daily), F.array(own, own + 1)).otherwise(F.array(own))
    wide = m.wide.withColumn("slot", F.explode(slots)) if daily else m.wide
    names = ["o", *(["item_id"] if m.by_item else []), "band"]
    rows = F.collect_list(F.struct((-F.unix_date("item_date")).alias("o"), *names[1:], *[F.col(x) for x in m.stats]))
    # fields before the statistics tell rows apart; a map has no order
    rows = _sorted(rows, names) if "freq_hist" in m.stats else F.array_sort(rows)
    once = [] if by_edition else [r["src"] for r in m.src if r["cadence"] == "once"]
    if once:
        wide = wide.withColumn("slot", F.when(F.col("src").isin(once), F.lit(0)).otherwise(F.col("slot")))
    return wide.groupBy(_at(F.col("src"), "_lat", "_lon", F.col("slot")).alias("at")).agg(F.first("src").alias("src"), rows.alias("rows"))


def _in_window(e: Column) -> Column:
    return F.col("first").isNull() | e["o"].between(-F.col("last"), -F.col("first"))


def event_results(se: DataFrame, request: Request, items: DataFrame, cells: DataFrame, output_col: str, *, date_col: str = "sample_date",
                  round_digits: int = 5, named: bool = False, place: str | None = None, **options) -> DataFrame:
    """``se`` with the nested result of one request, newest first, completed by an undated row for every band x statistic
    without data.  The elements are made once a slot, and the events meet their slot's: an event only picks its days.
    ``place`` names a column to add: the slot of the event's location, by which the rows are dealt."""
    m = matched(se, [request], items, cells, date_col=date_col, round_digits=round_digits, **options)
    hist = "freq_hist" in m.stats
    none, title = F.lit(None), F.lit(request.title)
    names = {float(b): label for b, label in request.bands.items()}

    def element(date, band, label, stat, value, h):
        out = [title.alias("covariate"), date.cast("date").alias("date"), band.cast("double").alias("band")]
        out += [label.cast("string").alias("band_name")] if named else []
        out += [F.lit(stat).alias("spatial_stat"), value.cast("double").alias("value")]
        return F.struct(*out, *([h.cast("map<double,bigint>").alias("hist")] if hist else []))

    def of_row(x):
        label = none
        for b, name in names.items():
            label = F.when(x["band"].cast("double") == b, F.lit(name)).otherwise(label)
        els = [element(F.date_from_unix_date(-x["o"]), x["band"], label, s, none if s == "freq_hist" else x[s], x[s] if s == "freq_hist" else none)
               for s in m.stats]
        return F.struct(x["o"].alias("o"), x["band"].cast("double").alias("band"), F.array(*els).alias("els"))

    lists = _slot_lists(m).select("at", F.transform("rows", of_row).alias("_rows"))
    ev = event_key(se, date_col, round_digits)
    dated = F.col("_day") != F.lit(_NO_DATE).cast("date")
    if request.cadence == "daily":
        day, span = F.when(dated, F.unix_date("_day")), m.req[0]["span"]
        ev = ev.withColumns({"first": day - (int(request.n_days) - 1), "last": day, "slot": F.floor(day / F.lit(span)).cast("long")})
    elif request.cadence == "once":
        ev = ev.withColumn("slot", F.unix_date(_only_date(m.dates)).cast("long"))
    else:
        pairs = temporal.asof_pairs(ev.select(F.lit(request.covariate_id).alias("covariate_id"), "_day").distinct(), m.dates, "_day", "covariate_id")
        # at most one row per calendar day
        pairs = pairs.select("_day", F.unix_date("item_date").cast("long").alias("slot"))
        ev = ev.join(F.broadcast(pairs), "_day", "left")
    own = ["first", "last"] if request.cadence == "daily" else []
    ev = ev.select(*[F.col(f"`{c}`").alias(f"_own_{k}") for k, c in enumerate(se.columns)],
                   _at(F.lit(m.src[0]["src"]), "_lat", "_lon", F.col("slot")).alias("_of"), *own)
    out = ev.join(lists, F.col("_of") == F.col("at"), "left")
    rows = F.filter("_rows", _in_window) if own else F.col("_rows")
    out = out.withColumn("_in", F.coalesce(rows, F.array()))
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(name).cast("string").alias("name")) for b, name in names.items()])
    absent = F.filter(bands, lambda b: ~F.exists("_in", lambda e: e["band"] == b["band"]))
    fill = F.transform(absent, lambda b: F.array(*[element(none, b["band"], b["name"], s, none, none) for s in m.stats]))
    nested = F.flatten(F.concat(F.transform("_in", lambda e: e["els"]), fill))
    added = [F.col("_of").alias(place)] if place is not None else []
    return out.select(*[F.col(f"_own_{k}").alias(c) for k, c in enumerate(se.columns)], nested.alias(output_col), *added)


def keyed_results(se: DataFrame, requests: list[Request], items: DataFrame, cells: DataFrame, **options) -> DataFrame:
    """(req, _lat, _lon, _day, _zs): for each request and event key with data, its rows (``_slot_lists``), newest first."""
    m = matched(se, requests, items, cells, **options)
    slots = m.slots.withColumn("at", _at(F.col("src"), "_lat", "_lon", F.col("slot")))
    out = slots.join(_slot_lists(m).drop("src"), "at").select("req", *_KEY, "first", "last", "rows")
    rows = F.filter("rows", _in_window) if "daily" in m.modes else F.col("rows")
    if len(requests) > 1:
        # requests take their own bands of what their source has
        out = _attach(out, m.req, "req", ["bands"])
        rows = F.filter(rows, lambda e: F.exists("bands", lambda b: b["band"] == e["band"].cast("int")))
    return out.select("req", *_KEY, rows.alias("_zs")).where(F.size("_zs") > 0)


def unfolded(rows: Column, stats: list[str], hist: bool) -> Column:
    """Rows of ``keyed_results`` as elements: ARRAY<STRUCT<date, band, spatial_stat, value[, hist]>>."""
    return F.flatten(F.transform(rows, lambda x: F.array(*[_element(F.date_from_unix_date(-x["o"]), x["band"], s, x, hist) for s in stats])))


def _sorted(rows: Column, names: list[str]) -> Column:
    """An array of structs in ascending order of ``names`` (other fields may be maps, which have no order)."""
    def compare(a, b):
        out = F.lit(0)
        for x in reversed(names):
            out = F.when(a[x] < b[x], F.lit(-1)).when(a[x] > b[x], F.lit(1)).otherwise(out)
        return out
    return F.array_sort(rows, compare)


def _element(date: Column, band: Column, stat: str, wide: Column, hist: bool) -> Column:
    value = F.lit(None) if stat == "freq_hist" else wide[stat]
    out = [date.alias("date"), band.cast("double").alias("band"), F.lit(stat).alias("spatial_stat"), value.cast("double").alias("value")]
    if hist:
        out.append((wide[stat] if stat == "freq_hist" else F.lit(None)).cast("map<double,bigint>").alias("hist"))
    return F.struct(*out)


def _needed_editions(cells: DataFrame, asked: DataFrame, dates: DataFrame, requests, modes) -> DataFrame:
    """The cells of the dates that some request needs: a semi-join right on the scan (calendar days x covariates
    asked for at most, so broadcast), where dynamic partition pruning skips the folders of other dates."""
    at = asked.select("covariate_id", "cadence", "n_days", "_day").distinct()
    parts = []
    if "daily" in modes:
        days = at.where("cadence = 'daily'").select("covariate_id", F.explode(F.sequence(
            F.date_sub("_day", F.col("n_days") - 1), F.col("_day"))).alias("item_date"))
        parts.append(days.distinct())
    if "periodic" in modes:
        parts.append(temporal.asof_pairs(at.where("cadence = 'periodic'").select("covariate_id", "_day"), dates, "_day", "covariate_id")
                     .select("covariate_id", "item_date"))
    if "once" in modes:
        parts.append(dates.where(F.col("covariate_id").isin(sorted({r.covariate_id for r in requests if r.cadence == "once"}))))
    needed = dates.join(F.broadcast(_union(parts).distinct()), ["covariate_id", "item_date"], "left_semi")
    on = ["covariate_id", "item_date"]
    if "item_month" in cells.columns:  # a store's folders
        needed, on = needed.withColumn("item_month", F.trunc("item_date", "month")), [*on, "item_month"]
    return cells.join(F.broadcast(needed), on, "left_semi")


def _needed_places(cells: DataFrame, points: DataFrame) -> DataFrame:
    """Of a cell store, the cells in tiles that some disc touches, before any shuffle: coarse tiles (at most 648), whose
    folders dynamic partition pruning skips, and tiles of the Z-order key (at most 2**15); so both are broadcast."""
    if "coarse_tile" in cells.columns:
        near = disc_tiles(points, "_lat", "_lon", F.col("radius"), F.col("cell_deg"), geo.tile_size(COARSE_TILE_DEG))
        near = near.select(coarse_tile_id(F.col("ty"), F.col("tx")).alias("coarse_tile")).distinct()
        cells = cells.join(F.broadcast(near), on="coarse_tile", how="left_semi").drop("coarse_tile")
    if "zkey" in cells.columns:
        near = z_tiles(points, "_lat", "_lon", F.col("radius"), F.col("cell_deg"))
        shift = 2 * (Z_LEVEL - Z_ASK_LEVEL)
        cells = cells.withColumn("z_tile", F.shiftright("zkey", shift)).join(F.broadcast(near), on="z_tile", how="left_semi")
    return cells


def completed(rows: Column, title: Column, bands: Column, stats: Column, named: bool, hist: bool) -> Column:
    """The nested result of one event: ``rows`` with the covariate's title and the band labels, and an undated row
    of NULL for every band x statistic without data.  ``bands`` ARRAY<STRUCT<band, name>>, ``stats`` ARRAY<STRING>."""
    def make(date, band, label, stat, value, h):
        out = [title.alias("covariate"), date.cast("date").alias("date"), band.cast("double").alias("band")]
        out += [label.alias("band_name")] if named else []
        out += [stat.alias("spatial_stat"), value.cast("double").alias("value")]
        return F.struct(*out, *([h.cast("map<double,bigint>").alias("hist")] if hist else []))

    none = F.lit(None)
    label = lambda e: F.get(F.filter(bands, lambda b: b["band"].cast("double") == e["band"]), 0)["name"]
    have = F.transform(rows, lambda e: make(e["date"], e["band"], label(e) if named else none, e["spatial_stat"], e["value"], e["hist"] if hist else none))
    present = lambda b, s: F.coalesce(F.exists(rows, lambda e: (e["band"] == b["band"].cast("double")) & (e["spatial_stat"] == s)), F.lit(False))
    fill = F.flatten(F.transform(bands, lambda b: F.transform(F.filter(stats, lambda s: ~present(b, s)), lambda s: make(
        none, b["band"], b["name"].cast("string"), s, none, none))))
    return F.when(rows.isNull(), fill).otherwise(F.concat(have, fill))


def domain(r: Request):
    """Literal bands and stats columns of one request."""
    bands = F.array(*[F.struct(F.lit(int(b)).alias("band"), F.lit(n).cast("string").alias("name")) for b, n in r.bands.items()])
    return bands, F.array(*[F.lit(s) for s in r.stats])


def enrich_long(se: DataFrame, requests: list[Request], items: DataFrame, cells: DataFrame, *, date_col: str = "sample_date",
                output_col: str = "zonal_statistics", materialize: bool = False) -> DataFrame:
    """One row per event and request: the event's columns, ``request`` (its name or number) and the nested result.
    The plan doesn't grow with the requests.  The elements of every request are made once a slot, where its list lies; the
    events meet their slot's lists directly, once per source, and only pick their days, so no array made for a key or request
    is shuffled and none is made per event.  ``materialize`` writes the lists to the shared folder before."""
    hist = any("freq_hist" in r.stats for r in requests)
    m = matched(se, requests, items, cells, date_col=date_col)
    lists = _slot_lists(m, by_edition=False)
    if materialize:
        lists = session.materialize(lists, "enrich")
    asked = _asked(se.sparkSession, m, hist)
    every = _all_stats(requests)

    def made(r):
        own = F.filter("rows", lambda x: F.exists(r["bands"], lambda b: b["band"] == x["band"].cast("int")))
        label = lambda x: F.get(F.filter(r["bands"], lambda b: b["band"] == x["band"].cast("int")), 0)["name"]

        def of_row(x):
            els = F.array(*[F.struct(r["title"].alias("covariate"), F.date_from_unix_date(-x["o"]).alias("date"), x["band"].cast("double").alias("band"),
                                     label(x).alias("band_name"), F.lit(s).alias("spatial_stat"),
                                     (F.lit(None) if s == "freq_hist" else x[s]).cast("double").alias("value"),
                                     *([(x[s] if s == "freq_hist" else F.lit(None)).cast("map<double,bigint>").alias("hist")] if hist else [])) for s in every])
            return F.filter(els, lambda e: F.array_contains(r["stats"], e["spatial_stat"])) if len({tuple(r.stats) for r in requests}) > 1 else els
        return F.flatten(F.transform(own, of_row))

    once = [r["src"] for r in m.src if r["cadence"] == "once"]
    editions = F.when(F.col("src").isin(once), F.array_distinct(F.transform("rows", lambda x: F.date_from_unix_date(-x["o"])))) if once else F.lit(None)
    lists = lists.join(F.broadcast(asked), "src").select("at", F.transform("asked", made).alias("_made"), editions.alias("_editions"))
    ev = event_key(se, date_col)
    own = [F.col(f"`{c}`").alias(f"_own_{k}") for k, c in enumerate(se.columns)]
    # an event once per source, at its slot of it
    out = ev.select(*own, *_KEY, F.explode(F.sequence(F.lit(0), F.lit(len(m.src) - 1))).alias("src"))
    out = _attach(out, m.src, "src", ["covariate_id", "cadence", "span"])
    dated = F.col("_day") != F.lit(_NO_DATE).cast("date")
    last = F.when((F.col("cadence") == "daily") & dated, F.unix_date("_day"))
    slot = F.when(F.col("cadence") == "once", F.lit(0).cast("long")).otherwise(F.floor(last / F.col("span")).cast("long"))
    if "periodic" in m.modes:
        ids = sorted({r["covariate_id"] for r in m.src if r["cadence"] == "periodic"})
        days = ev.select(F.explode(F.array(*[F.lit(x) for x in ids])).alias("covariate_id"), "_day").distinct()
        pairs = temporal.asof_pairs(days, m.dates, "_day", "covariate_id").withColumnRenamed("item_date", "_edition")
        out = out.join(F.broadcast(pairs), ["covariate_id", "_day"], "left")  # calendar days x periodic covariates at most
        slot = F.when(F.col("cadence") == "periodic", F.unix_date("_edition").cast("long")).otherwise(slot)
    out = out.select(*[f"_own_{k}" for k in range(len(own))], "src", F.date_from_unix_date(last).alias("_last"), _at(F.col("src"), "_lat", "_lon", slot).alias("_of"))
    out = out.join(lists, F.col("_of") == F.col("at"), "left").drop("_of", "at").join(F.broadcast(asked), "src")
    # the requests of a source take their own days of what was made for them
    of_request = F.transform("asked", lambda r, k: F.struct(r["request"].alias("request"), r["n_days"].alias("_n"), r["fill"].alias("_fill"), F.get("_made", k).alias("_els")))
    out = out.select(*[f"_own_{k}" for k in range(len(own))], "src", "_last", "_editions", F.inline(of_request))
    out = out.withColumn("_first", F.date_sub("_last", F.col("_n") - 1))
    out = out.withColumn("_els", F.when(F.col("_last").isNull(), F.col("_els")).otherwise(F.filter("_els", lambda e: e["date"].between(F.col("_first"), F.col("_last")))))
    if once:  # a row per edition with data
        of_edition = F.transform("_editions", lambda d: F.filter("_els", lambda e: e["date"] == d))
        out = out.withColumn("_els", F.explode_outer(F.when(F.col("src").isin(once), of_edition).otherwise(F.array("_els"))))
    out = out.withColumn("_els", F.coalesce("_els", F.array()))
    absent = F.filter("_fill", lambda b: ~F.exists("_els", lambda e: e["band"] == b["band"]))
    nested = F.concat("_els", F.flatten(F.transform(absent, lambda b: b["els"])))
    return out.select(*[F.col(f"_own_{k}").alias(c) for k, c in enumerate(se.columns)], "request", nested.alias(output_col))


def _asked(spark, m: Matched, hist: bool) -> DataFrame:
    """(src, asked): the requests of each source, as many as the caller has written down, with the undated rows of each band."""
    element = "struct<covariate:string,date:date,band:double,band_name:string,spatial_stat:string,value:double" + (",hist:map<double,bigint>>" if hist else ">")
    of: dict[int, list] = {}
    for r in m.req:
        fill = [(float(b), [(r["title"], None, float(b), n, s, None, *([None] if hist else [])) for s in r["stats"]]) for b, n in r["bands"]]
        of.setdefault(r["src"], []).append((r["request"], r["title"], r["n_days"], r["bands"], r["stats"], fill))
    return spark.createDataFrame(list(of.items()), f"src int, asked array<struct<request:string,title:string,n_days:int,bands:{_TYPES['bands']},"
                                                   f"stats:array<string>,fill:array<struct<band:double,els:array<{element}>>>>>")


def enrich_wide(se: DataFrame, requests: list[Request], items: DataFrame, cells: DataFrame, *, date_col: str = "sample_date",
                prefix: str = "zonal_statistics_", materialize: bool = False) -> DataFrame:
    """``se`` with one nested column per request; the events are joined once.  ``materialize`` writes the results
    of the event keys to the shared folder before (the lineage is cut, the final plan small)."""
    found = keyed_results(se, requests, items, cells, date_col=date_col)
    if materialize:
        found = session.materialize(found, "enrich")
    numbers = list(range(len(requests)))
    wide = found.groupBy(F.struct(*_KEY).alias("k")).pivot("req", numbers).agg(F.first("_zs"))
    wide = wide.select("k.*", *[F.col(str(k)).alias(f"_zs_{k}") for k in numbers])
    out = event_key(se, date_col).join(wide, _KEY, "left")
    cols = []
    any_hist = any("freq_hist" in r.stats for r in requests)
    every = _all_stats(requests)
    out = out.withColumns({f"_zs_{k}": unfolded(F.col(f"_zs_{k}"), [s for s in every if s in r.stats], any_hist and "freq_hist" in r.stats)
                           for k, r in enumerate(requests)})
    for k, r in enumerate(requests):
        bands, stats = domain(r)
        rows = F.col(f"_zs_{k}")
        cols.append(completed(rows, F.lit(r.title), bands, stats, any(n is not None for n in r.bands.values()), any_hist and "freq_hist" in r.stats)
                    .alias(f"{prefix}{r.name if r.name is not None else k}"))
    return out.select(*[F.col(f"`{c}`") for c in se.columns], *cols)
