"""Domain tables made from the driver's tables, and the star that most queries start from.

The expressions are one text for Spark and for the SQL oracles; only rounding half to even has another name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import landcover_name
from ..operators import detections as d, spatial as s, verdict as v
from ..schema import CATEGORIES, CLASSES
from ..tables import materialise

#: Of a line item: a detection.
DETECTION = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "latitude": "CAST(20 AS DOUBLE) + CAST(l_suppkey % 10 AS DOUBLE)/100 + CAST(l_orderkey % 9 - 4 AS DOUBLE)/1000",
    "longitude": "CAST(75 AS DOUBLE) + CAST(CASE WHEN l_suppkey % 10 < 1 THEN l_partkey % 2 WHEN l_suppkey % 10 < 4 THEN l_partkey % 40 ELSE l_partkey % 200 END AS DOUBLE)/100",
    "frp": "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_quantity * 2 END",
    "bright_ti4": "300 + l_quantity",
    "bright_ti5": "290 + {RINT}(l_tax * 100)",
    "confidence": "CASE l_returnflag WHEN 'A' THEN 'l' WHEN 'N' THEN 'n' ELSE '85' END",
    "daynight": "CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'D' END",
    "acq_date": "CAST(l_shipdate AS DATE)",
    "acq_time": "CAST(l_partkey % 24 * 100 + l_linenumber AS {TEXT})",
}
CATEGORY = "CASE s_suppkey % 11 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CATEGORIES)) + " END"
#: Of a supplier: a footprint, and a plant.
FOOTPRINT = {
    "key": "s_suppkey",
    "category": CATEGORY,
    "name": "concat('site ', CAST(s_suppkey AS {TEXT}))",
    "latitude": "CAST(20 AS DOUBLE) + CAST(s_suppkey % 13 AS DOUBLE)/50",
    "longitude": "CAST(75 AS DOUBLE) + CAST(s_suppkey * 7 % 211 AS DOUBLE)/100",
    "half": "CAST(s_suppkey % 5 AS DOUBLE)/500",
}
PLANT = {
    "key": "s_suppkey",
    "latitude": "CAST(20 AS DOUBLE) + CAST(s_suppkey * 3 % 17 AS DOUBLE)/70",
    "longitude": "CAST(75 AS DOUBLE) + CAST(s_suppkey * 5 % 197 AS DOUBLE)/90",
    "wri_fuel": "CASE s_nationkey % 4 WHEN 0 THEN 'Coal' WHEN 1 THEN 'Solar' WHEN 2 THEN 'Hydro' ELSE 'Gas' END",
    "wri_capacity_mw": "s_acctbal",
}
#: Land-cover code of a cell; the last has no row.
LANDCOVER_CODE = "CASE (cell_lat * 31 + cell_lon * 17) % 10 WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2 THEN 30 WHEN 3 THEN 40 WHEN 4 THEN 50 WHEN 5 THEN 60 WHEN 6 THEN 80 WHEN 7 THEN 95 WHEN 8 THEN 40 END"
#: The raster: rows, columns, corner, pixel.
ROWS, COLS, X0, Y0, PIXEL = 40, 220, 74.9, 20.2, 0.01
PIXEL_VALUE = "CAST((row * 37 + col * 11) % 101 - 1 AS DOUBLE)"
BOUNDARY = [("area", [[(75.05, 19.9), (76.5, 19.95), (76.9, 20.06), (76.2, 20.2), (75.2, 20.15)]])]
STATES = [
    ("Asha", [[(74.9, 19.9), (75.6, 19.9), (75.6, 20.05), (74.9, 20.05)]]),
    ("Bira", [[(75.5, 19.9), (76.2, 19.9), (76.3, 20.2), (75.4, 20.2)]]),
    ("Chor", [[(76.2, 19.9), (76.8, 19.92), (76.7, 20.2), (76.25, 20.18)]]),
    ("Dhul", [[(74.9, 20.06), (75.3, 20.06), (75.1, 20.2)], [(76.81, 19.95), (76.95, 19.95), (76.95, 20.1)]]),
]
#: In place of a model's second opinion, for queries whose rows must not depend on a fit.
PSEUDO_CLASS = "CASE (cell_lat * 7 + cell_lon * 3 + episode_seq) % 5 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CLASSES)) + " END"
PSEUDO_CONFIDENCE = "CAST((cell_lon * 13 + episode_seq * 7) % 100 AS DOUBLE)/100"
ELEMENT_KINDS = 5


def exprs(table: dict[str, str]) -> list[str]:
    return [f"{e.format(RINT='rint', TEXT='STRING')} AS `{n}`" for n, e in table.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*exprs(DETECTION))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned detections with cells and episodes."""
    return d.with_episodes(d.with_cells(d.clean(raw_detections(spark, sf_dir))))


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "supplier").selectExpr(*exprs(FOOTPRINT))
    return f.select("key", "category", "name", "latitude", "longitude", (F.col("latitude") - F.col("half")).alias("min_lat"), (F.col("longitude") - F.col("half")).alias("min_lon"), (F.col("latitude") + F.col("half")).alias("max_lat"), (F.col("longitude") + F.col("half")).alias("max_lon"))


def plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*exprs(PLANT))


def landcover_rows(spark: SparkSession) -> DataFrame:
    """Land cover of the cells of the area; some cells have a second row, which a keep-first must ignore."""
    cells = spark.range(40 * 220).selectExpr("CAST(1985 + id DIV 220 AS INT) AS cell_lat", "CAST(7490 + id % 220 AS INT) AS cell_lon")
    first = cells.selectExpr("cell_lat", "cell_lon", f"{LANDCOVER_CODE} AS landcover_code", "0 AS ord").where("landcover_code IS NOT NULL")
    return first.unionByName(first.where("cell_lat % 2 = 0").selectExpr("cell_lat", "cell_lon", "80 AS landcover_code", "1 AS ord"))


def with_landcover(sites: DataFrame) -> DataFrame:
    one = s.keep_first(landcover_rows(sites.sparkSession), d.SITE, ["ord"]).drop("ord")
    joined = sites.join(one, d.SITE, "left")
    return joined.withColumn("landcover", F.when(F.col("landcover_code").isNull(), "unknown").otherwise(landcover_name("landcover_code")))


def raster(spark: SparkSession) -> DataFrame:
    return spark.range(ROWS * COLS).selectExpr(f"CAST(id DIV {COLS} AS INT) AS row", f"CAST(id % {COLS} AS INT) AS col").selectExpr("row", "col", f"{PIXEL_VALUE} AS value")


def with_population(sites: DataFrame) -> DataFrame:
    sums = s.box_sums(raster(sites.sparkSession), ROWS, COLS)
    return s.sample_raster(sites, sums, X0, Y0, PIXEL, PIXEL, ROWS, COLS, "pop_9km")


def sites(spark: SparkSession, sf_dir: str, det: DataFrame | None = None) -> DataFrame:
    """Sites with all their context."""
    st = d.site_features(det if det is not None else detections(spark, sf_dir))
    st = s.with_hot(s.nearest_boxes(st, footprints(spark, sf_dir)))
    st = s.nearest_point(st, plants(spark, sf_dir), ["wri_fuel", "wri_capacity_mw"], "d_wri_plant")
    st = with_population(with_landcover(st))
    st = s.flag_inside(st, s.edges_of(spark, BOUNDARY), "in_india")
    return s.first_polygon(st, s.edges_of(spark, STATES), d.SITE)


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes with their sites' context, label and rule."""
    det = detections(spark, sf_dir)
    return starred(d.episode_features(det), sites(spark, sf_dir, det))


def written_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star as a table. Sites and episodes are written before they are joined: in one stage a task would sort its
    share of the detections for both at once, which doesn't fit an executor's memory when there are many."""
    det = detections(spark, sf_dir)
    context = materialise(sites(spark, sf_dir, det), "sites")
    return materialise(starred(materialise(d.episode_features(det), "episodes"), context), "star")


def starred(episodes: DataFrame, context: DataFrame) -> DataFrame:
    e = episodes.join(context.drop("latitude", "longitude"), d.SITE, "left")
    return v.with_rules(e.withColumn("label", v.weak_label()))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star with a verdict against the stand-in for a model."""
    e = star(spark, sf_dir).withColumns({"model_class": F.expr(PSEUDO_CLASS), "model_confidence": F.expr(PSEUDO_CONFIDENCE)})
    return v.with_verdict(e).withColumn("priority", v.map_priority())


