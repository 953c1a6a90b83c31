"""Input tables derived from the driver's TPC-H-like parquet tables.

Every builder is a lazy Spark job over the given tables, so its size grows
with the scale factor.  The matching DuckDB text for each table lives in
``FIXTURE_SQL``; oracle queries splice it in as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values shared with the oracle SQL: the anchor date of the synthetic
# catalogue extents and the id of the raster covariate.
CATALOGUE_EPOCH = "1992-01-01"
SST_COVARIATE = "sst"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def f_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample events: one per order, placed on the customer's site."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("event_key"),
        F.concat(F.lit("S"), F.col("o_custkey")).alias("site"),
        (((F.col("o_custkey") * 37) % 160 - 80).cast("double") + 0.25).alias("latitude"),
        (((F.col("o_custkey") * 91) % 340 - 170).cast("double") + 0.25).alias("longitude"),
        F.col("o_orderdate").cast("date").alias("sample_date"),
        F.col("o_orderstatus").alias("tags"),
        F.col("o_totalprice").alias("response"),
    )


def _iso(c: Column) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T00:00:00Z"))


def f_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue collections in STAC shape (nested), one per part."""
    p = table(spark, sf_dir, "part")
    start = F.date_add(F.lit(CATALOGUE_EPOCH).cast("date"), (F.col("p_partkey") % 365).cast("int"))
    end = F.when(F.col("p_size") % 4 != 0,
                 F.date_add(start, (F.col("p_size") * 10).cast("int")))
    providers = F.when(
        F.col("p_size") % 13 == 0,
        F.array().cast("array<struct<name:string,roles:array<string>>>"),
    ).otherwise(F.array(
        F.struct(F.col("p_brand").alias("name"),
                 F.when(F.col("p_size") % 2 == 0, F.array(F.lit("producer"), F.lit("licensor")))
                 .otherwise(F.array(F.lit("producer"))).alias("roles")),
        F.struct(F.concat(F.lit("Host "), F.col("p_partkey") % 4).alias("name"),
                 F.array(F.lit("host"), F.lit("processor")).alias("roles")),
    ))
    keywords = F.when(F.col("p_size") % 11 == 0, F.array().cast("array<string>")) \
        .otherwise(F.array(F.col("p_type"), F.col("p_brand")))
    bbox = F.array(F.array(
        (F.col("p_size") - 180).cast("double"), F.lit(-60.0),
        (180 - F.col("p_size")).cast("double"), F.lit(60.0)))
    return p.select(
        F.concat(F.lit("cov_p"), F.col("p_partkey")).alias("id"),
        F.concat(F.when(F.col("p_size") % 7 == 0, F.lit("GPW ")).otherwise(F.lit("")),
                 F.col("p_name"), F.lit(" "), (F.col("p_partkey") % 50).cast("string")).alias("title"),
        F.concat(F.col("p_type"), F.lit(" layer from "), F.col("p_brand")).alias("description"),
        F.element_at(F.array(F.lit("CC-BY-4.0"), F.lit("CC0-1.0"), F.lit("proprietary")),
                     (F.col("p_size") % 3 + 1).cast("int")).alias("license"),
        F.concat(F.lit("10.5555/part."), F.col("p_partkey")).alias("sci:doi"),
        F.concat(F.col("p_name"), F.lit(", "), F.col("p_brand")).alias("sci:citation"),
        keywords.alias("keywords"),
        providers.alias("providers"),
        F.struct(
            F.struct(bbox.alias("bbox")).alias("spatial"),
            F.struct(F.array(F.array(_iso(start), F.when(end.isNotNull(), _iso(end))))
                     .alias("interval")).alias("temporal"),
        ).alias("extent"),
    )


def f_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated editions of each covariate (four families of cadence)."""
    li = table(spark, sf_dir, "lineitem")
    d = F.col("l_shipdate").cast("date").alias("item_date")
    parts = [
        li.select(F.concat(F.lit("cov_o"), F.col("l_orderkey")).alias("covariate_id"), d),
        li.select(F.concat(F.lit("cov_p"), F.col("l_partkey")).alias("covariate_id"), d),
        li.select(F.concat(F.lit("cov_c"), F.col("l_partkey") % 300).alias("covariate_id"), d),
        li.select(F.concat(F.lit("cov_s"), F.col("l_suppkey")).alias("covariate_id"), d),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.distinct().withColumn(
        "item_id", F.concat_ws("_", F.col("covariate_id"), F.date_format("item_date", "yyyyMMdd")))


def f_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets of the first item of each covariate, with band / column metadata."""
    p = table(spark, sf_dir, "part")
    d = spark.createDataFrame(
        [("data", "image/tiff; application=geotiff", ".tif", 0),
         ("cog", "application/octet-stream", ".TIFF", 1),
         ("parquet", "application/vnd.apache.parquet", ".parquet", 2),
         ("boundaries", None, ".parquet", 3),
         ("thumbnail", "image/png", ".png", 4)],
        "dataset string, mime string, ext string, m int",
    )
    k = (F.col("p_size") % 4).cast("int")
    bands = F.when(k != 0, F.transform(
        F.sequence(F.lit(1), k),
        lambda i: F.struct(F.when(F.col("p_partkey") % 2 == 0,
                                  F.concat(F.col("dataset"), F.lit("_b"), i.cast("string")))
                           .alias("name"))))
    # Parquet datasets of two thirds of the covariates list one or two columns
    n_cols = F.when(F.col("m").isin(2, 3), F.col("p_size") % 3).otherwise(0).cast("int")
    columns = F.when(n_cols != 0, F.transform(
        F.sequence(F.lit(1), n_cols), lambda i: F.struct(F.concat(F.col("dataset"), F.lit("_c"), i.cast("string")).alias("name"))))
    # the datasets m with (partkey + m) % 3 == 0, as an equi-join on m
    m0 = ((3 - F.col("p_partkey") % 3) % 3).cast("int")
    offsets = F.array_compact(F.array(m0, F.when(m0 + 3 < 5, m0 + 3)))
    return (
        p.withColumn("m", F.explode(offsets)).join(F.broadcast(d), on="m")
        .select(
            F.concat(F.lit("cov_p"), F.col("p_partkey")).alias("covariate_id"),
            "dataset", "mime",
            F.concat(F.lit("assets/"), F.col("dataset"), F.lit("_"), F.col("p_partkey"), F.col("ext"))
            .alias("href"),
            bands.alias("bands"),
            columns.alias("columns"),
        )
    )


def f_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster cells of the 'sst' covariate: 1 degree cells, bands 1-7."""
    li = table(spark, sf_dir, "lineitem")
    return (
        li.groupBy(
            F.lit(SST_COVARIATE).alias("covariate_id"),
            F.col("l_shipdate").cast("date").alias("item_date"),
            F.col("l_linenumber").alias("band"),
            (((F.col("l_partkey") * 37) % 160 - 80).cast("double") + 0.5).alias("cy"),
            (((F.col("l_suppkey") * 91) % 340 - 170).cast("double") + 0.5).alias("cx"),
        )
        .agg(F.max(F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))).alias("value"))
        .withColumn("half_deg", F.lit(0.5))
    )


def sst_items(cells: DataFrame) -> DataFrame:
    """Items of the raster covariate: the dates that have cells."""
    return (cells.select("covariate_id", "item_date").distinct()
            .withColumn("item_id", F.concat_ws("_", F.col("covariate_id"),
                                               F.date_format("item_date", "yyyyMMdd"))))


def f_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping diamonds, one per nation, as ring arrays."""
    n = table(spark, sf_dir, "nation")
    x0 = ((F.col("n_nationkey") % 5) * 70 - 175).cast("double")
    y0 = ((F.col("n_nationkey") - F.col("n_nationkey") % 5) / 5 * 32 - 80).cast("double")

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(pt(x0, y0 + 18), pt(x0 + 40, y0), pt(x0 + 80, y0 + 18),
                   pt(x0 + 40, y0 + 36), pt(x0, y0 + 18))
    return n.select(
        F.col("n_nationkey").alias("poly_id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("region"),
        F.array(ring).alias("rings"),
    )


# DuckDB text of the same tables, for the oracle queries.
FIXTURE_SQL = {
    "f_events": """
    select o_orderkey as event_key, concat('S', o_custkey) as site,
      cast((o_custkey*37)%160-80 as double)+0.25 as latitude,
      cast((o_custkey*91)%340-170 as double)+0.25 as longitude,
      cast(o_orderdate as date) as sample_date,
      o_orderstatus as tags, o_totalprice as response
    from orders""",
    "f_items": """
    select covariate_id, item_date,
      covariate_id || '_' || strftime(item_date, '%Y%m%d') as item_id
    from (select distinct covariate_id, item_date from (
      select concat('cov_o', l_orderkey) covariate_id, cast(l_shipdate as date) item_date from lineitem
      union all select concat('cov_p', l_partkey), cast(l_shipdate as date) from lineitem
      union all select concat('cov_c', l_partkey%300), cast(l_shipdate as date) from lineitem
      union all select concat('cov_s', l_suppkey), cast(l_shipdate as date) from lineitem) t) u""",
    "f_cells": """
    select 'sst' as covariate_id, cast(l_shipdate as date) as item_date, l_linenumber as band,
      cast((l_partkey*37)%160-80 as double)+0.5 as cy,
      cast((l_suppkey*91)%340-170 as double)+0.5 as cx, cast(0.5 as double) as half_deg,
      max(case when l_returnflag='R' then null else l_quantity end) as value
    from lineitem group by 1,2,3,4,5""",
    "f_assets": """
    select concat('cov_p', p_partkey) as covariate_id, d.dataset, d.mime,
      concat('assets/', d.dataset, '_', p_partkey, d.ext) as href,
      p_size % 4 as n_bands, p_partkey % 2 = 0 as named, case when d.m in (2, 3) then p_size % 3 else 0 end as n_cols
    from part join (
      select 'data' dataset, 'image/tiff; application=geotiff' mime, '.tif' ext, 0 m
      union all select 'cog', 'application/octet-stream', '.TIFF', 1
      union all select 'parquet', 'application/vnd.apache.parquet', '.parquet', 2
      union all select 'boundaries', null, '.parquet', 3
      union all select 'thumbnail', 'image/png', '.png', 4) d
    on (p_partkey + d.m) % 3 = 0""",
    "f_collections": """
    select concat('cov_p', p_partkey) as id,
      concat(case when p_size%7=0 then 'GPW ' else '' end, p_name, ' ',
             cast(p_partkey%50 as varchar)) as title,
      concat(p_type, ' layer from ', p_brand) as description,
      p_brand, p_type, p_size, p_partkey, p_name
    from part""",
    "f_polygons": """
    select n_nationkey as poly_id, n_name as name, n_regionkey as region,
      cast((n_nationkey%5)*70-175 as double) as x0,
      cast((n_nationkey-n_nationkey%5)/5*32-80 as double) as y0
    from nation""",
}


def with_fixtures(body: str, *names: str) -> str:
    """Prefix an oracle query with the named fixture CTEs."""
    ctes = ",\n".join(f"{n} as ({FIXTURE_SQL[n]})" for n in names)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
