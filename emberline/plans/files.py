"""From files to files: context tables, classified events, the dashboard's data. Used by the command line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import landcover_name
from ..operators import detections as d, model as m, ranking as k, spatial as s, verdict as v
from ..sources import readers, sinks
from ..tables import materialise

INDUSTRY, PLANTS, GROUND, PERSISTENT, CELLS = "industrial_sites.csv", "power_plants.csv", "landcover_at_cells.csv", "persistent_sources.csv", "hotspot_cells.csv"
EVENTS, PRIORITY, SITES, IMPORTANCE, REPORT, MANIFEST = "events.csv", "priority_events.csv", "sites.csv", "feature_importance.csv", "report.md", "manifest.json"


def read(spark: SparkSession, pattern: str) -> DataFrame:
    """Cleaned detections with cells; a measure that no file has is null."""
    det = readers.read_detections(spark, pattern)
    return d.with_cells(det.withColumns({c: F.lit(None).cast("double") for c in ("bright_ti4", "bright_ti5", "frp") if c not in det.columns}))


def episodes(spark: SparkSession, pattern: str) -> DataFrame:
    return d.with_episodes(read(spark, pattern))


def context(spark: SparkSession, out: str, detections: str | None = None, elements: str | None = None, plants: str | None = None, country: str = "IND") -> list[str]:
    """Writes the context tables whose raw files are given; returns their names."""
    made = []
    if elements:
        sinks.write_industry(readers.flatten_elements(readers.read_elements(spark, elements)), f"{out}/{INDUSTRY}")
        made.append(INDUSTRY)
    if plants:
        sinks.write_plants(readers.read_plants(spark, plants, country), f"{out}/{PLANTS}")
        made.append(PLANTS)
    if detections:
        stats = materialise(d.cell_stats(read(spark, detections)), "cell-stats")
        sinks.write_persistent(d.persistent_sources(stats), f"{out}/{PERSISTENT}")
        sinks.write_cells(stats, f"{out}/{CELLS}")
        made += [PERSISTENT, CELLS]
    return made


def sites(spark: SparkSession, det: DataFrame, seeds: str, boundary: str | None = None) -> DataFrame:
    """Sites with the context that the folder ``seeds`` has; what it lacks is infinitely far, unknown or null."""
    have = lambda name: bool(readers.files(spark, f"{seeds}/{name}"))
    st = d.site_features(det)
    kinds = "key string, category string, name string, latitude double, longitude double, min_lat double, min_lon double, max_lat double, max_lon double"
    boxes = readers.read_footprints(spark, f"{seeds}/{INDUSTRY}").withColumnRenamed("osm_id", "key") if have(INDUSTRY) else spark.createDataFrame([], kinds)
    st = s.with_hot(s.nearest_boxes(st, boxes))
    if have(PLANTS):
        points = readers.read_plants(spark, f"{seeds}/{PLANTS}").select("latitude", "longitude", F.col("gppd_idnr").alias("key"), F.col("primary_fuel").alias("wri_fuel"), F.col("capacity_mw").alias("wri_capacity_mw"))
    else:
        points = spark.createDataFrame([], "latitude double, longitude double, key string, wri_fuel string, wri_capacity_mw double")
    st = s.nearest_point(st, points, ["wri_fuel", "wri_capacity_mw"], "d_wri_plant")
    if have(GROUND):
        one = s.keep_first(readers.read_landcover(spark, f"{seeds}/{GROUND}").drop("landcover"), d.SITE, ["landcover_code"])
        st = st.join(one, d.SITE, "left")
    else:
        st = st.withColumn("landcover_code", F.lit(None).cast("smallint"))
    st = st.withColumn("landcover", F.when(F.col("landcover_code").isNull(), "unknown").otherwise(landcover_name("landcover_code")))
    st = st.withColumn("pop_9km", F.lit(None).cast("double"))
    return s.flag_inside(st, readers.read_geojson(spark, boundary) if boundary else None, "in_india")


def classify(spark: SparkSession, detections: str, seeds: str, out: str, boundary: str | None = None, with_model: bool = True) -> dict:
    """Events, priority list, sites, report and manifest from raw detections; returns the manifest. Without enough labels
    to fit a model on, or without one wanted, the rules alone speak."""
    det = materialise(episodes(spark, detections), "episodes")
    st = materialise(sites(spark, det, seeds, boundary), "sites")
    star = d.episode_features(det).join(st.drop("latitude", "longitude"), d.SITE, "left")
    star = materialise(v.with_rules(star.withColumn("label", v.weak_label())), "star")
    fitted = m.fit(m.holdout(star).where("NOT is_test"), m.BURN_FEATURES) if with_model else None
    told = m.score(star, fitted) if fitted else star.withColumns({"model_class": F.lit(None).cast("string"), "model_confidence": F.lit(None).cast("double")})
    judged = materialise(v.with_verdict(told), "judged")
    sinks.write_events(judged, f"{out}/{EVENTS}")
    sinks.write_table(sinks.priority_events(judged), f"{out}/{PRIORITY}")
    sinks.write_sites(st, f"{out}/{SITES}")
    if fitted:
        sinks.write_model(fitted, f"{out}/model")
        sinks.write_importance(m.importance(star), f"{out}/{IMPORTANCE}")
        parts = [("held-out sites", m.site_holdout(star)), ("last days", m.time_holdout(star)), ("leak control", m.leak_control(star))]
        sinks.write_report(spark, f"{out}/{REPORT}", parts)
    return sinks.write_manifest(spark, f"{out}/{MANIFEST}", judged)


def bundle(spark: SparkSession, events: str, script: str, districts: str | None = None, names: str = "st_nm", template: str | None = None, page: str | None = None, marker: str = "<!--DATA-->") -> str:
    """The dashboard's script from written events, and its page if a template is given."""
    e = readers.read_events(spark, events).withColumn("priority", v.map_priority())
    shapes: Sequence[str] = ()
    if districts:
        areas = readers.read_geojson(spark, districts, names)
        e, shapes = s.first_polygon(e, areas, d.EPISODE), [r.name for r in areas.select("place", "name").orderBy("place").collect()]
    else:
        e = e.withColumn("state", F.lit(-1))
    text = sinks.write_bundle(spark, k.bundle(materialise(e.where(v.inside(False)), "bundle"), shapes), script)
    if template and page:
        sinks.inline(spark, template, text, page, marker)
    return text
