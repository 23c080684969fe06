"""The queries of the library and their SQL: one entry for each operator or a few that belong together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import columns as x
from ..operators import detections as d, model as m, ranking as k, spatial as s, verdict as v
from ..schema import CATEGORIES, CLASSES, HOT_CATEGORIES, INCIDENTS, OSM
from ..sources import readers, sinks
from ..tables import materialise, new_path
from . import files, sql as q, surrogate as g

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    run: Run
    spec: str = ""
    sql: str | None = None


QUERIES: dict[str, Query] = {}
KEYS = "cell_lat:i cell_lon:i episode_seq:i"


def shape(df: DataFrame, spec: str) -> DataFrame:
    """Columns by the spec's names and types; doubles are rounded here, once."""
    kinds = {"i": "bigint", "t": "date", "s": "string", "b": "boolean"}
    pick = lambda n, t: x.rounded(F.col(n).cast("double"), 4) if t == "d" else F.col(n).cast(kinds[t])
    return df.select(*[pick(n, t).alias(n) for n, t in (c.split(":") for c in spec.split())])


def query(spec: str = "", body: str | None = None, *needs: str, more: str = "") -> Callable[[Run], Run]:
    def add(fn: Run) -> Run:
        run = (lambda spark, sf_dir: shape(fn(spark, sf_dir), spec)) if spec else fn
        QUERIES[fn.__name__] = Query(run, spec, q.shaped(spec, body, *needs, more=more) if body else None)
        return fn

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked, classified and explained incidents: the analyst's list."""
    return sinks.priority_events(g.judged(spark, sf_dir))


ODD = "CASE l_linenumber % 8 WHEN 0 THEN 'l' WHEN 1 THEN ' N ' WHEN 2 THEN 'H' WHEN 3 THEN '85' WHEN 4 THEN '0' WHEN 5 THEN '' WHEN 6 THEN NULL ELSE 'nominal' END"


@query(
    "l_orderkey:i l_linenumber:i latitude:d confidence:d is_night:b acq_hour:i acq_date:t",
    f"SELECT l_orderkey, l_linenumber, latitude, {q.CONF} AS confidence, coalesce(daynight = 'N', false) AS is_night, floor(CAST(acq_time AS DOUBLE) / 100) AS acq_hour, acq_date FROM odd",
    "raw", more=f"odd AS (SELECT *, lower(trim({ODD})) AS t FROM raw WHERE l_orderkey % 7 <> 3)",
)
def clean_confidence(spark, sf_dir):
    raw = g.raw_detections(spark, sf_dir).withColumn("confidence", F.expr(ODD))
    return d.clean(raw.withColumn("latitude", F.when(F.expr("l_orderkey % 7 = 3"), "n/a").otherwise(F.col("latitude").cast("string"))))


@query(
    "source:s n:i ti4_sum:d ti5_max:d no_track:i",
    "SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'viirs' ELSE 'modis' END AS source, count(*) AS n, sum(bright_ti4) AS ti4_sum, max(bright_ti5) AS ti5_max, sum(CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 1 END) AS no_track FROM raw GROUP BY 1", "raw",
)
def dialect_union(spark, sf_dir):
    raw = g.raw_detections(spark, sf_dir)
    viirs = raw.where("l_orderkey % 2 = 0").withColumns({"source": F.lit("viirs"), "track": F.lit("0.4")})
    modis = raw.where("l_orderkey % 2 = 1").withColumn("source", F.lit("modis")).withColumnsRenamed({"bright_ti4": "brightness", "bright_ti5": "bright_t31"})
    both = d.clean(d.union_dialects(viirs, modis))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("bright_ti4").alias("ti4_sum"), F.max("bright_ti5").alias("ti5_max"), F.count_if(F.col("track").isNull()).alias("no_track"))


@query("cell_lat:i cell_lon:i n:i", "SELECT cell_lat, cell_lon, count(*) AS n FROM det GROUP BY 1, 2", "det")
def grid_cells(spark, sf_dir):
    return d.with_cells(d.clean(g.raw_detections(spark, sf_dir))).groupBy(*d.SITE).agg(F.count(F.lit(1)).alias("n"))


STATS = "nights:i detections:i first_seen:t last_seen:t frp_mean:d frp_max:d frp_std:d latitude:d longitude:d night_ratio:d frp_cv:d"
STATS_SQL = "SELECT cell_lat, cell_lon, site_nights AS nights, site_detections AS detections, site_first AS first_seen, site_last AS last_seen, site_frp_mean AS frp_mean, site_frp_max AS frp_max, site_frp_std AS frp_std, latitude, longitude, site_night_ratio AS night_ratio, site_frp_cv AS frp_cv"


@query(f"cell_lat:i cell_lon:i {STATS} label_hint:s", f"{STATS_SQL}, CASE WHEN site_nights >= 150 THEN 'flare_or_coalseam' ELSE 'persistent_source' END AS label_hint FROM st WHERE site_nights >= 30", "st")
def persistent_sources(spark, sf_dir):
    return d.persistent_sources(d.cell_stats(d.with_cells(d.clean(g.raw_detections(spark, sf_dir)))))


@query("latitude:d longitude:d nights:i detections:i", "SELECT latitude, longitude, site_nights AS nights, site_detections AS detections FROM st", "st")
def hotspot_cells(spark, sf_dir):
    return d.cell_stats(d.with_cells(d.clean(g.raw_detections(spark, sf_dir))))


EPISODE_SQL = 'SELECT cell_lat, cell_lon, episode_seq, min(acq_date) AS "start", max(acq_date) AS "end", count(*) AS n_detections FROM seq GROUP BY 1, 2, 3'


@query(f"{KEYS} start:t end:t n_detections:i", EPISODE_SQL, "seq")
def episodes_gap(spark, sf_dir):
    return g.detections(spark, sf_dir).groupBy(*d.EPISODE).agg(F.min("acq_date").alias("start"), F.max("acq_date").alias("end"), F.count(F.lit(1)).alias("n_detections"))


@query("cell_lat:i cell_lon:i start:t end:t n_detections:i", EPISODE_SQL, "seq")
def episodes_session_window(spark, sf_dir):
    return d.episodes_by_window(d.with_cells(d.clean(g.raw_detections(spark, sf_dir))))


EPISODE_SPEC = f"{KEYS} latitude:d longitude:d start:t end:t n_detections:i n_nights:i frp_max:d frp_mean:d frp_sum:d frp_std:d ti4_max:d ti4_mean:d ti5_mean:d night_ratio:d confidence:d duration_days:i hot_delta:d frp_cv:d month:i"


@query(EPISODE_SPEC, "SELECT * FROM ep", "ep")
def episode_features(spark, sf_dir):
    return d.episode_features(g.detections(spark, sf_dir))


@query(f"{KEYS} frp_trend:d duration_days:i", "SELECT * FROM ep", "ep")
def episode_trend(spark, sf_dir):
    return d.episode_features(g.detections(spark, sf_dir))


@query("cell_lat:i cell_lon:i latitude:d longitude:d site_nights:i site_detections:i site_first:t site_last:t site_frp_mean:d site_frp_max:d site_frp_std:d site_night_ratio:d site_episodes:i site_span_days:i site_duty_cycle:d site_frp_cv:d", "SELECT * FROM st", "st")
def site_features(spark, sf_dir):
    return d.site_features(g.detections(spark, sf_dir))


NEAR_SPEC = "cell_lat:i cell_lon:i " + " ".join(f"d_{c}:d" for c in CATEGORIES) + " name_refinery:s name_mining:s name_industrial_zone:s name_power_plant_thermal:s"
NEAR_SQL = "SELECT cell_lat, cell_lon, " + ", ".join(f"{q.r('d_' + c, 2)} AS d_{c}" for c in CATEGORIES) + ", name_refinery, name_mining, name_industrial_zone, name_power_plant_thermal FROM near"


def plain_sites(spark, sf_dir):
    return d.site_features(g.detections(spark, sf_dir))


def cents(df):
    return df.withColumns({f"d_{c}": x.rounded(f"d_{c}", 2) for c in CATEGORIES})


@query(NEAR_SPEC, NEAR_SQL, "near")
def footprint_nearest_k8(spark, sf_dir):
    return cents(s.nearest_boxes(plain_sites(spark, sf_dir), g.footprints(spark, sf_dir)))


@query(NEAR_SPEC, NEAR_SQL, "near")
def footprint_nearest_buckets(spark, sf_dir):
    return cents(s.nearest_boxes(plain_sites(spark, sf_dir), g.footprints(spark, sf_dir), most=0))


@query("cell_lat:i cell_lon:i d_industrial_hot:d nearest_hot_category:s", f"SELECT cell_lat, cell_lon, {q.r('d_industrial_hot', 2)} AS d_industrial_hot, nearest_hot_category FROM hot", "near")
def nearest_hot_category(spark, sf_dir):
    near = s.nearest_boxes(plain_sites(spark, sf_dir), g.footprints(spark, sf_dir), HOT_CATEGORIES, [])
    return s.with_hot(near).withColumn("d_industrial_hot", x.rounded("d_industrial_hot", 2))


@query("cell_lat:i cell_lon:i d_wri_plant:d wri_fuel:s wri_capacity_mw:d", f"SELECT cell_lat, cell_lon, {q.r('d_wri_plant', 2)} AS d_wri_plant, wri_fuel, wri_capacity_mw FROM plant", "plant")
def nearest_plant(spark, sf_dir):
    out = s.nearest_point(plain_sites(spark, sf_dir), g.plants(spark, sf_dir), ["wri_fuel", "wri_capacity_mw"], "d_wri_plant")
    return out.withColumn("d_wri_plant", x.rounded("d_wri_plant", 2))


@query("cell_lat:i cell_lon:i landcover_code:i landcover:s", "SELECT cell_lat, cell_lon, coalesce(landcover_code, -1) AS landcover_code, landcover FROM lc", "lc")
def landcover_join(spark, sf_dir):
    return g.with_landcover(plain_sites(spark, sf_dir)).na.fill(-1, ["landcover_code"])


@query("cell_lat:i cell_lon:i pop_9km:d", "SELECT * FROM pop", "pop")
def population_sample(spark, sf_dir):
    return g.with_population(plain_sites(spark, sf_dir))


@query("row:i col:i value:d", "SELECT * FROM box", "pop")
def population_box9(spark, sf_dir):
    return s.box_sums(g.raster(spark), g.ROWS, g.COLS)


@query("cell_lat:i cell_lon:i in_india:b", "SELECT st.cell_lat, st.cell_lon, place IS NOT NULL AS in_india FROM st LEFT JOIN area USING (cell_lat, cell_lon)", "area")
def point_in_polygon(spark, sf_dir):
    return s.flag_inside(plain_sites(spark, sf_dir), s.edges_of(spark, g.BOUNDARY), "in_india")


STATE_SQL = "SELECT st.cell_lat, st.cell_lon, coalesce(state, -1) AS state FROM st LEFT JOIN state USING (cell_lat, cell_lon)"


@query("cell_lat:i cell_lon:i state:i", STATE_SQL, "state")
def state_lookup(spark, sf_dir):
    return s.first_polygon(plain_sites(spark, sf_dir), s.edges_of(spark, g.STATES), d.SITE)


@query("cell_lat:i cell_lon:i state:i", STATE_SQL, "state")
def state_lookup_boxes(spark, sf_dir):
    return s.first_polygon(plain_sites(spark, sf_dir), s.edges_of(spark, g.STATES), d.SITE, most=0)


@query(f"{KEYS} label:s", "SELECT * FROM star", "star")
def weak_labels(spark, sf_dir):
    return g.star(spark, sf_dir)


@query(f"{KEYS} rule:i rule_class:s rule_reason:s", "SELECT * FROM star", "star")
def rules_classify(spark, sf_dir):
    return g.star(spark, sf_dir)


@query("value:s n:i", "SELECT rule_class AS value, count(*) AS n FROM star GROUP BY 1", "star")
def value_counts(spark, sf_dir):
    return k.value_counts(g.star(spark, sf_dir), "rule_class")


@query("value:s n:i", "SELECT landcover AS value, count(*) AS n FROM star GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8", "star")
def value_counts_top8(spark, sf_dir):
    return k.value_counts(g.star(spark, sf_dir), "landcover", 8)


@query("place:i value:s n:i", "SELECT place, value, (SELECT count(*) FROM star WHERE rule_class = value) AS n FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(CLASSES)) + ") t(place, value)", "star")
def class_totals(spark, sf_dir):
    return k.fixed_counts(g.star(spark, sf_dir), "rule_class")


@query(f"{KEYS} final_class:s model_class:s model_confidence:d model_agrees:b final_source:s needs_review:b review_reason:s", "SELECT * FROM judged", "judged")
def verdict_review(spark, sf_dir):
    return g.judged(spark, sf_dir)


@query("review:i false_alarms:i unmapped:i agree_share:d labelled_share:d", "SELECT sum(CASE WHEN needs_review THEN 1 ELSE 0 END) AS review, sum(CASE WHEN review_reason LIKE 'near%' THEN 1 ELSE 0 END) AS false_alarms, sum(CASE WHEN review_reason LIKE 'burns%' THEN 1 ELSE 0 END) AS unmapped, avg(CASE WHEN model_agrees THEN 1.0 ELSE 0.0 END) AS agree_share, avg(CASE WHEN label IS NULL THEN 0.0 ELSE 1.0 END) AS labelled_share FROM judged", "judged")
def review_counts(spark, sf_dir):
    return g.judged(spark, sf_dir).agg(F.count_if("needs_review").alias("review"), F.count_if(F.col("review_reason").startswith("near")).alias("false_alarms"), F.count_if(F.col("review_reason").startswith("burns")).alias("unmapped"), F.avg(F.col("model_agrees").cast("double")).alias("agree_share"), F.avg(F.col("label").isNotNull().cast("double")).alias("labelled_share"))


@query(f"{KEYS} final_class:s priority:d", f"SELECT {q.KEY}, final_class, {q.r('urgency + greatest(coalesce(frp_trend, 0), 0) * 10.0', 2)} AS priority FROM judged WHERE {q.INCIDENT} AND coalesce(in_india, true) ORDER BY 5 DESC, 1, 2, 3 LIMIT 20000", "judged")
def priority_triage(spark, sf_dir):
    return k.top(v.incidents(g.judged(spark, sf_dir)).withColumn("priority", v.triage_priority()), 20_000)


@query(f"{KEYS} priority:d", "SELECT * FROM judged WHERE in_india", "judged")
def priority_map(spark, sf_dir):
    return g.judged(spark, sf_dir).where(v.inside(False))


@query(f"{KEYS} latitude:s longitude:s frp_mean:s frp_trend:s hot_delta:s night_ratio:s", "SELECT cell_lat, cell_lon, episode_seq, " + ", ".join(f"CAST(CAST(round_even({c} * 1e{n}, 0) AS BIGINT) AS VARCHAR) AS {c}" for c, n in (("latitude", 5), ("longitude", 5), ("frp_mean", 2), ("frp_trend", 2), ("hot_delta", 2), ("night_ratio", 2))) + " FROM ep", "ep")
def rounded_events(spark, sf_dir):
    e = v.slim(d.episode_features(g.detections(spark, sf_dir)))
    return e.withColumns({c: F.rint(F.col(c) * 10.0**n).cast("bigint").cast("string") for c, n in (("latitude", 5), ("longitude", 5), ("frp_mean", 2), ("frp_trend", 2), ("hot_delta", 2), ("night_ratio", 2))})


@query("cell_lat:i cell_lon:i site_nights:i final_class:s", f"SELECT cell_lat, cell_lon, site_nights, rule_class AS final_class FROM (SELECT *, row_number() OVER (PARTITION BY cell_lat, cell_lon ORDER BY frp_max DESC NULLS LAST, episode_seq) AS n FROM star) WHERE n = 1", "star")
def site_top_class(spark, sf_dir):
    e = g.star(spark, sf_dir).withColumn("final_class", F.col("rule_class"))
    return k.site_top_class(plain_sites(spark, sf_dir), e)


@query(f"{KEYS} final_class:s priority:d place:i", q.TOP, "judged")
def topk_per_class(spark, sf_dir):
    return k.top_per_class(g.judged(spark, sf_dir))


@query(f"{KEYS} final_class:s priority:d", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY final_class ORDER BY md5('7/' || cell_lat || '/' || cell_lon || '/' || episode_seq) DESC, cell_lat, cell_lon, episode_seq) AS place FROM judged WHERE final_class IN ('agri_burn', 'wildfire')) WHERE place <= 2000", "judged")
def sample_per_class(spark, sf_dir):
    return k.sample_per_class(g.judged(spark, sf_dir))


@query("rule_class:s start:t episodes:i detections:i nights:i frp:d near:i", "SELECT rule_class, min(\"start\") AS start, count(*) AS episodes, sum(n_detections) AS detections, sum(n_nights) AS nights, max(frp_max) AS frp, sum(CASE WHEN d_industrial_hot < 5000 THEN 1 ELSE 0 END) AS near FROM star GROUP BY 1", "star")
def events_by_files(spark, sf_dir):
    """Detections written as raw files of text, read back, sessionized and classified, written as events and read again."""
    raw, events = new_path(spark, "raw"), new_path(spark, "events")
    g.raw_detections(spark, sf_dir).write.csv(raw, header=True)
    det = files.episodes(spark, f"{raw}/*.csv")
    e = d.episode_features(det).join(g.sites(spark, sf_dir, det).drop("latitude", "longitude"), d.SITE, "left")
    sinks.write_events(v.with_rules(e.withColumn("label", v.weak_label())), events)
    back = readers.read_events(spark, events)
    return back.groupBy("rule_class").agg(
        F.min("start").alias("start"), F.count(F.lit(1)).alias("episodes"), F.sum("n_detections").alias("detections"), F.sum("n_nights").alias("nights"),
        F.max("frp_max").alias("frp"), F.count_if(F.col("d_industrial_hot") < 5000).alias("near"))


CODE = "coalesce(list_position(vocab.{v}, {c}), 0) - 1"


@query(
    f"{KEYS} lat:d lon:d day:i cls:i frp:d nights:i dur:i dist:i lc:i cat:i pop:i night_ratio:d review:i priority:d age:i st:i",
    f"""SELECT {q.KEY}, {q.r('latitude', 4)} AS lat, {q.r('longitude', 4)} AS lon, date_diff('day', DATE '2025-01-01', "start") AS day, list_position([{q.quoted(CLASSES)}], final_class) - 1 AS cls, {q.r('coalesce(frp_max, 0)', 1)} AS frp,
  site_nights AS nights, duration_days AS dur, CASE WHEN d_industrial_hot < CAST('Infinity' AS DOUBLE) THEN round_even(d_industrial_hot, 0) ELSE -1 END AS dist, {CODE.format(v='lcv', c='landcover')} AS lc, {CODE.format(v='catv', c='nearest_hot_category')} AS cat,
  round_even(coalesce(pop_9km, 0), 0) AS pop, {q.r('coalesce(night_ratio, 0)', 2)} AS night_ratio, CASE WHEN needs_review THEN 1 ELSE 0 END AS review, {q.r('priority', 1)} AS priority, date_diff('day', "start", (SELECT max("start") FROM sel)) AS age, state AS st
  FROM sel, vocab""",
    "judged", more=f"sel AS ({q.TOP}), vocab AS (SELECT list_sort(list_distinct(list(landcover))) AS lcv, list_sort(list_distinct(list(nearest_hot_category))) AS catv FROM judged)",
)
def encode_columns(spark, sf_dir):
    j = g.judged(spark, sf_dir)
    return k.encoded(k.top_per_class(j), j)


@query("month_text:s " + " ".join(f"{c}:i" for c in CLASSES), f"SELECT strftime(\"start\", '%Y-%m') AS month_text, {q.MATRIX} FROM judged WHERE in_india GROUP BY 1", "judged")
def monthly_pivot(spark, sf_dir):
    return k.count_matrix(k.with_month(g.judged(spark, sf_dir).where(v.inside(False))), "month_text", "final_class")


@query("landcover:s " + " ".join(f"{c}:i" for c in CLASSES), f"SELECT landcover, {q.MATRIX} FROM judged GROUP BY 1", "judged")
def landcover_mix(spark, sf_dir):
    return k.count_matrix(g.judged(spark, sf_dir), "landcover", "final_class")


RECORD = f"{KEYS} lat:d lon:d cls:s start:s frp:d dur:i nights:i cat:s dist:i pop:i"


@query(f"{RECORD} lc:s reason:s review:b priority:d", f"SELECT {q.ALERT}, landcover AS lc, rule_reason AS reason, needs_review AS review, {q.r('priority', 1)} AS priority FROM (SELECT * FROM judged WHERE {q.INCIDENT} AND in_india ORDER BY priority DESC, {q.KEY} LIMIT 25)", "judged")
def alerts_top25(spark, sf_dir):
    return k.alerts(g.judged(spark, sf_dir).where(v.inside(False)))


@query(f"{RECORD} age:i state:i", f"SELECT {q.ALERT}, date_diff('day', \"start\", newest) AS age, state FROM (SELECT * FROM ind, (SELECT max(\"start\") AS newest FROM ind) WHERE {q.INCIDENT} AND \"start\" >= newest - INTERVAL 7 DAY ORDER BY priority DESC, {q.KEY} LIMIT 14)", "judged", more="ind AS (SELECT * FROM judged WHERE in_india)")
def arrivals_recent(spark, sf_dir):
    return k.arrivals(g.judged(spark, sf_dir).where(v.inside(False)))


@query("cell_lat:i cell_lon:i lat:d lon:d nights:i duty:d night_ratio:d lc:s cls:s", f"SELECT cell_lat, cell_lon, {q.r('latitude', 4)} AS lat, {q.r('longitude', 4)} AS lon, site_nights AS nights, {q.r('site_duty_cycle', 2)} AS duty, {q.r('night_ratio', 2)} AS night_ratio, landcover AS lc, final_class AS cls FROM (SELECT *, row_number() OVER (PARTITION BY cell_lat, cell_lon ORDER BY episode_seq) AS n FROM (SELECT * FROM judged ORDER BY site_nights DESC, {q.KEY} LIMIT 15)) WHERE n = 1", "judged")
def persistent_top15(spark, sf_dir):
    return k.persistent_sites(g.judged(spark, sf_dir))


VIEW = f"final_class IN ({q.quoted(INCIDENTS)}) AND coalesce(frp_max, 0) >= 40 AND site_nights >= 20 AND strftime(\"start\", '%Y-%m') BETWEEN '1996-01' AND '1999-06'"


def seen(spark, sf_dir):
    return k.with_month(g.judged(spark, sf_dir)).where(k.visible(INCIDENTS, 40.0, 20, "1996-01", "1999-06"))


@query(f"{KEYS} final_class:s frp_max:d", f"SELECT * FROM judged WHERE {VIEW}", "judged")
def dashboard_filter(spark, sf_dir):
    return seen(spark, sf_dir)


X, Y = "((longitude - 75.4) * 900.0 + 800.0 / 2)", "((20.03 - latitude) * 900.0 + 60.0 / 2)"


@query(f"{KEYS} final_class:s", f"SELECT * FROM judged WHERE {VIEW} AND {X} BETWEEN -20 AND 820 AND {Y} BETWEEN -20 AND 80 AND longitude <= 75.8", "judged")
def viewport_clip(spark, sf_dir):
    return seen(spark, sf_dir).where(k.in_view(20.03, 75.4, 900.0, 800.0, 60.0) & (F.col("longitude") <= 75.8))


@query("shown:i total:i", f"SELECT sum(CASE WHEN {VIEW} THEN 1 ELSE 0 END) AS shown, count(*) AS total FROM judged", "judged")
def visible_tally(spark, sf_dir):
    return k.with_month(g.judged(spark, sf_dir)).agg(F.count_if(k.visible(INCIDENTS, 40.0, 20, "1996-01", "1999-06")).alias("shown"), F.count(F.lit(1)).alias("total"))


@query(f"month_text:s total:i lifted:i", f"SELECT month_text, total, least(lifted, greatest((SELECT max(total) FROM stack), 1)) AS lifted FROM stack", "judged", more=f"stack AS (SELECT strftime(\"start\", '%Y-%m') AS month_text, count(*) AS total, sum(CASE WHEN {q.INCIDENT} THEN 20 ELSE 0 END) AS lifted FROM judged WHERE final_class <> 'wildfire' GROUP BY 1)")
def monthly_stack(spark, sf_dir):
    return k.monthly_stack(k.with_month(g.judged(spark, sf_dir)), [c for c in CLASSES if c != "wildfire"])


D2 = "((longitude - 75.3) * 900.0 * ((longitude - 75.3) * 900.0) + (20.03 - latitude) * 900.0 * ((20.03 - latitude) * 900.0))"


@query(f"{KEYS} final_class:s d2:d", f"SELECT *, {D2} AS d2 FROM judged WHERE {VIEW} AND {D2} < 260 ORDER BY d2, {q.KEY} LIMIT 1", "judged")
def click_nearest(spark, sf_dir):
    return k.nearest_click(seen(spark, sf_dir), 20.03, 75.3, 900.0)


@query(f"{KEYS} burned_for:s nearest_industry:s kind_of_site:s ground:s why:s", f"""SELECT {q.KEY}, concat(CAST(duration_days AS VARCHAR), CASE WHEN duration_days = 1 THEN ' day' ELSE ' days' END) AS burned_for,
  CASE WHEN dist < 0 THEN 'none mapped' WHEN dist = 0 THEN 'inside the fence' ELSE format('{{:,}}', dist) || ' m' END AS nearest_industry, replace(nearest_hot_category, '_', ' ') AS kind_of_site, replace(landcover, '_', ' ') AS ground,
  CASE WHEN needs_review THEN 'Where it sits says one thing, how it burns says another. Two independent checks disagree, so this one is worth opening.'
    WHEN final_class = 'gas_flare' THEN 'Alight on ' || CAST(site_nights AS VARCHAR) || ' separate nights at the same square kilometre. This is a permanent source — a flare stack or a coal seam — not an emergency.'
    WHEN final_class = 'mining' THEN 'Heat that keeps coming back inside a mapped mine or quarry.' WHEN final_class = 'industrial_fire' AND dist = 0 THEN 'Inside a mapped industrial footprint, at a spot with no history of routine burning.'
    WHEN final_class = 'industrial_fire' THEN 'Within ' || format('{{:,}}', dist) || ' m of hot industry, on ground that is not cropland or forest.'
    WHEN final_class = 'agri_burn' THEN 'A short daytime burn on cropland, well clear of any industry.' ELSE 'Forest or scrub, with nothing industrial anywhere near it.' END AS why
  FROM (SELECT *, CAST(round_even(d_industrial_hot, 0) AS BIGINT) AS dist FROM judged)""", "judged")  # fmt: skip
def point_detail(spark, sf_dir):
    return v.detail(g.judged(spark, sf_dir).withColumn("dist", F.rint("d_industrial_hot").cast("bigint")))


@query("freshness:s", "SELECT CASE WHEN n <= 0 THEN 'newest detection today' WHEN n = 1 THEN 'newest detection yesterday' ELSE 'newest detection ' || CAST(n AS VARCHAR) || ' days ago' END AS freshness FROM (SELECT date_diff('day', max(acq_date), DATE '2002-01-01') AS n FROM det)", "det")
def feed_freshness(spark, sf_dir):
    latest = d.clean(g.raw_detections(spark, sf_dir)).agg(F.max("acq_date").alias("latest"))
    return latest.select(v.freshness(F.col("latest"), F.lit("2002-01-01").cast("date")).alias("freshness"))


@query("turn:i satellite:s hour:d hours_ahead:d", f"SELECT *, row_number() OVER (ORDER BY hours_ahead, place) AS turn FROM (SELECT *, {q.r('(hour - 13.25 + 24) - 24 * floor((hour - 13.25 + 24) / 24)', 4)} AS hours_ahead FROM (VALUES {q.PASS_ROWS}) t(place, satellite, hour))")
def next_pass(spark, sf_dir):
    return k.passes(spark, 13.25)


TAGS = """CASE p_partkey % 14 WHEN 0 THEN '{"industrial":"Refinery"}' WHEN 1 THEN '{"name":"Old Refineries Ltd","man_made":"works"}' WHEN 2 THEN '{"industrial":"gas"}' WHEN 3 THEN '{"man_made":"gasometer"}'
 WHEN 4 THEN '{"man_made":"storage_tank"}' WHEN 5 THEN '{"landuse":"quarry"}' WHEN 6 THEN '{"name":"North Colliery","landuse":"industrial"}' WHEN 7 THEN '{"power":"plant","plant:source":"Solar"}' WHEN 8 THEN '{"power":"plant","generator:source":"coal"}'
 WHEN 9 THEN '{"name":"Brick field"}' WHEN 10 THEN '{"industrial":"factory"}' WHEN 11 THEN '{"man_made":"chimney"}' WHEN 12 THEN '{"landuse":"industrial","power":"line"}' ELSE '{}' END"""
TAG = lambda key: f"lower(coalesce(json_extract_string(tags, '$.\"{key}\"'), ''))"


@query("p_partkey:i category:s", f"""SELECT p_partkey, CASE WHEN ind = 'refinery' OR nm LIKE '%refinery%' OR nm LIKE '%refineries%' THEN 'refinery' WHEN ind IN ('oil', 'gas') OR mm IN ('petroleum_well', 'gasometer', 'gasworks') THEN 'oil_gas'
  WHEN mm = 'storage_tank' THEN 'storage_tank' WHEN mm IN ('mineshaft', 'adit') OR lu = 'quarry' OR nm LIKE '%colliery%' OR nm LIKE '%coalfield%' THEN 'mining'
  WHEN pw = 'plant' THEN CASE WHEN CASE WHEN ps <> '' THEN ps ELSE gs END IN ('solar', 'wind', 'hydro', 'battery', 'tidal', 'geothermal') THEN 'power_plant_nonthermal' ELSE 'power_plant_thermal' END
  WHEN mm = 'kiln' OR nm LIKE '%brick%' THEN 'kiln' WHEN mm = 'works' OR ind = 'factory' THEN 'factory' WHEN mm = 'chimney' THEN 'chimney' WHEN lu = 'industrial' THEN 'industrial_zone' ELSE 'other_industrial' END AS category FROM tagged""",
    more=f"t0 AS (SELECT p_partkey, {TAGS} AS tags FROM part), tagged AS (SELECT p_partkey, {TAG('industrial')} AS ind, {TAG('man_made')} AS mm, {TAG('landuse')} AS lu, {TAG('name')} AS nm, {TAG('power')} AS pw, {TAG('plant:source')} AS ps, {TAG('generator:source')} AS gs FROM t0)")
def osm_categorise(spark, sf_dir):
    parts = g.table(spark, sf_dir, "part").select("p_partkey", F.from_json(F.expr(TAGS), "map<string,string>").alias("tags"))
    return parts.withColumn("category", x.category(F.col("tags")))


LAT, LON, HALF = "(CAST(s_suppkey % 40 AS DOUBLE) / 8 + 10)", "(CAST(s_suppkey % 64 AS DOUBLE) / 4 + 70)", "(CAST(s_suppkey % 3 + 1 AS DOUBLE) / 16)"
ELEMENT = {
    "type": "CASE s_suppkey % 5 WHEN 0 THEN 'node' WHEN 1 THEN 'way' WHEN 2 THEN 'relation' WHEN 3 THEN 'way' ELSE 'node' END",
    "id": "s_suppkey",
    "lat": f"CASE WHEN s_suppkey % 5 = 0 THEN {LAT} END",
    "lon": f"CASE WHEN s_suppkey % 5 = 0 THEN {LON} END",
}


@query("osm_id:s latitude:d longitude:d min_lat:d min_lon:d max_lat:d max_lon:d extent_m:d category:s name:s", f"""SELECT ty || '/' || CAST(s_suppkey AS VARCHAR) AS osm_id, lat AS latitude, lon AS longitude, lat - h AS min_lat, lon - h AS min_lon, lat + h AS max_lat, lon + h AS max_lon,
  {q.r("sqrt(2 * h * 111320.0 * (2 * h * 111320.0) + 2 * h * 111320.0 * cos(radians(lat)) * (2 * h * 111320.0 * cos(radians(lat)))) / 2", 1)} AS extent_m, CASE WHEN s_suppkey % 2 = 0 THEN 'chimney' ELSE 'other_industrial' END AS category, s_name AS name
  FROM (SELECT *, {ELEMENT['type']} AS ty, {LAT} AS lat, {LON} AS lon, CASE WHEN s_suppkey % 5 = 1 THEN {HALF} ELSE 0.0 END AS h FROM supplier WHERE s_suppkey % 5 < 3)""")  # fmt: skip
def osm_flatten(spark, sf_dir):
    sup = g.table(spark, sf_dir, "supplier")
    bounds = F.struct(*[F.expr(f"CASE WHEN s_suppkey % 5 = 1 THEN {e} END").alias(n) for n, e in (("minlat", f"{LAT} - {HALF}"), ("minlon", f"{LON} - {HALF}"), ("maxlat", f"{LAT} + {HALF}"), ("maxlon", f"{LON} + {HALF}"))])
    center = F.struct(F.expr(f"CASE WHEN s_suppkey % 5 = 2 THEN {LAT} END").alias("lat"), F.expr(f"CASE WHEN s_suppkey % 5 = 2 THEN {LON} END").alias("lon"))
    tags = F.create_map(F.lit("name"), F.col("s_name"), F.lit("man_made"), F.expr("CASE WHEN s_suppkey % 2 = 0 THEN 'chimney' ELSE 'mast' END"))
    fields = [F.expr(e).alias(n) for n, e in ELEMENT.items()] + [F.when(F.expr("s_suppkey % 5 = 1"), bounds).alias("bounds"), F.when(F.expr("s_suppkey % 5 = 2"), center).alias("center"), tags.alias("tags")]
    answers = sup.select(F.to_json(F.struct(*fields)).alias("json"))  # as the service sends them; shards overlap
    parsed = answers.unionByName(answers).select(F.from_json("json", OSM).alias("e")).select("e.*")
    return readers.flatten_elements(parsed)


WIDE = "cell_lat, cell_lon, latitude + (cell_lon % 3) * 3 - 21 AS latitude, longitude + (cell_lat % 2) * 3 - 75.5 AS longitude"
TILE = "concat('ESA_WorldCover_10m_2021_v200_', CASE WHEN south >= 0 THEN 'N' ELSE 'S' END, lpad(CAST(abs(south) AS VARCHAR), 2, '0'), CASE WHEN west >= 0 THEN 'E' ELSE 'W' END, lpad(CAST(abs(west) AS VARCHAR), 3, '0'), '_Map.tif')"
CORNERS = f"wide AS (SELECT {WIDE} FROM st), corner AS (SELECT *, CAST(floor(latitude / 3) * 3 AS INT) AS south, CAST(floor(longitude / 3) * 3 AS INT) AS west FROM wide), tiled AS (SELECT *, {TILE} AS tile FROM corner)"


def wide_cells(spark, sf_dir):
    return plain_sites(spark, sf_dir).selectExpr(*WIDE.replace("cell_lat, cell_lon, ", "cell_lat|cell_lon|").replace(" AS latitude, ", " AS latitude|").split("|"))


@query("cell_lat:i cell_lon:i tile:s", "SELECT * FROM tiled", "st", more=CORNERS)
def landcover_tile_name(spark, sf_dir):
    return wide_cells(spark, sf_dir).withColumn("tile", x.tile_name("latitude", "longitude"))


HEIGHT, STEP = 360, 8
PIXELS = HEIGHT // STEP


@query("cell_lat:i cell_lon:i landcover_code:i landcover:s", f"""SELECT cell_lat, cell_lon, landcover_code, {q.LC_NAME} AS landcover FROM (
  SELECT cell_lat, cell_lon, CASE WHEN row % 5 = 4 THEN 0 ELSE ((row * {STEP} * 7 + col * {STEP} * 13) % 11) * 10 END AS landcover_code FROM (
  SELECT *, CAST(floor((south + 3 - latitude) / (3.0 / {PIXELS})) AS INT) AS row, CAST(floor((longitude - west) / (3.0 / {PIXELS})) AS INT) AS col FROM tiled
  WHERE tile IN (SELECT tile FROM tiled GROUP BY 1 ORDER BY count(*) DESC, tile LIMIT 4) AND tile NOT LIKE '%N03E003%'))""", "st", more=CORNERS)  # fmt: skip
def tile_raster_sample(spark, sf_dir):
    cells = wide_cells(spark, sf_dir)
    names = cells.select(x.tile_name("latitude", "longitude").alias("tile")).distinct().where("tile NOT LIKE '%N03E003%'")
    grid = spark.range(HEIGHT * HEIGHT).selectExpr(f"CAST(id DIV {HEIGHT} AS INT) AS row", f"CAST(id % {HEIGHT} AS INT) AS col").selectExpr("row", "col", "CAST(((row * 7 + col * 13) % 11) * 10 AS SMALLINT) AS code").where(f"row DIV {STEP} % 5 <> 4")
    out = s.sample_tiles(cells, grid.crossJoin(F.broadcast(names)), most=4, step=STEP, height=HEIGHT)
    return out.withColumn("landcover", x.landcover_name("landcover_code"))


@query("tile:s n:i", "SELECT tile, count(*) AS n FROM tiled GROUP BY 1 ORDER BY n DESC, tile LIMIT 3", "st", more=CORNERS)
def tile_ranking(spark, sf_dir):
    named = wide_cells(spark, sf_dir).withColumn("tile", x.tile_name("latitude", "longitude"))
    return named.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tile").limit(3)


@query("south:d west:d north:d east:d", f"SELECT {q.r('lat', 3)} AS south, {q.r('lon', 3)} AS west, {q.r('least(lat + 4.0, 37.5)', 3)} AS north, {q.r('least(lon + 4.0, 97.5)', 3)} AS east FROM (SELECT 6.0 + a.i * 4.0 AS lat, 68.0 + b.i * 4.0 AS lon FROM range(8) a(i) CROSS JOIN range(8) b(i))")
def tile_grid(spark, sf_dir):
    return s.tile_grid(spark, 68.0, 6.0, 97.5, 37.5, 4.0)


@query("first_day:t last_day:t max_nights:i median_pop:d inside_share:d sites:i episodes:i labels:i", "SELECT min(\"start\") AS first_day, max(\"end\") AS last_day, max(site_nights) AS max_nights, median(pop_9km) AS median_pop, avg(CASE WHEN in_india THEN 1.0 ELSE 0.0 END) AS inside_share, count(DISTINCT cell_lat * 100000 + cell_lon) AS sites, count(*) AS episodes, count(DISTINCT label) AS labels FROM star", "star")
def global_stats(spark, sf_dir):
    return g.star(spark, sf_dir).agg(F.min("start").alias("first_day"), F.max("end").alias("last_day"), F.max("site_nights").alias("max_nights"), F.median("pop_9km").alias("median_pop"), F.avg(F.col("in_india").cast("double")).alias("inside_share"), F.countDistinct("cell_lat", "cell_lon").alias("sites"), F.count(F.lit(1)).alias("episodes"), F.countDistinct("label").alias("labels"))


AREA_SQL = "SELECT name, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area FROM (VALUES " + ", ".join(f"('{n}', CAST({a[0]} AS DOUBLE), CAST({a[1]} AS DOUBLE), CAST({b[0]} AS DOUBLE), CAST({b[1]} AS DOUBLE))" for n, rings in g.STATES for ring in rings[:1] for a, b in zip(ring, [*ring[1:], ring[0]])) + ") t(name, x1, y1, x2, y2) GROUP BY 1 HAVING abs(sum(x1 * y2 - x2 * y1)) / 2 >= 0.0008"


@query("name:s area:d", AREA_SQL)
def ring_areas(spark, sf_dir):
    rows = [(n, [{"lon": float(a), "lat": float(b)} for a, b in [*rings[0], rings[0][0]]]) for n, rings in g.STATES]
    df = spark.createDataFrame(rows, "name string, ring array<struct<lon:double,lat:double>>")
    return df.withColumn("area", x.ring_area(F.col("ring"))).where("area >= 0.0008")


@query("grp:i x1:d y1:d x2:d y2:d", "SELECT grp, x1, y1, x2, y2 FROM (SELECT n_regionkey AS grp, CAST(least(a.x, b.x) AS DOUBLE) AS x1, CAST(CASE WHEN a.x < b.x OR (a.x = b.x AND a.y < b.y) THEN a.y ELSE b.y END AS DOUBLE) AS y1, CAST(greatest(a.x, b.x) AS DOUBLE) AS x2, CAST(CASE WHEN a.x < b.x OR (a.x = b.x AND a.y < b.y) THEN b.y ELSE a.y END AS DOUBLE) AS y2 FROM nation, (VALUES (0, 0, 0, 1, 0), (1, 1, 0, 1, 1), (2, 1, 1, 0, 1), (3, 0, 1, 0, 0)) s(i, ax, ay, bx, b_y), LATERAL (SELECT n_nationkey % 7 + ax AS x, n_nationkey // 7 + ay AS y) a, LATERAL (SELECT n_nationkey % 7 + bx AS x, n_nationkey // 7 + b_y AS y) b) GROUP BY 1, 2, 3, 4, 5 HAVING count(*) % 2 = 1")
def dissolve_edges(spark, sf_dir):
    corners = F.array(*[F.struct(F.lit(a).alias("ax"), F.lit(b).alias("ay"), F.lit(c).alias("bx"), F.lit(e).alias("by")) for a, b, c, e in ((0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0))])
    squares = g.table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("grp"), F.expr("n_nationkey % 7").alias("x"), F.expr("n_nationkey DIV 7").alias("y"), F.explode(corners).alias("e"))
    edges = squares.select("grp", *[(F.col(a) + F.col(f"e.{b}")).cast("double").alias(n) for n, a, b in (("x1", "x", "ax"), ("y1", "y", "ay"), ("x2", "x", "bx"), ("y2", "y", "by"))])
    return readers.dissolve(edges, "grp")


@query()
def model_score(spark, sf_dir):
    e = g.written_star(spark, sf_dir)
    fitted = m.fit(m.holdout(e).where("NOT is_test"), m.BURN_FEATURES)
    # without two labels to learn from there is no second opinion, and the rules alone speak
    judged = v.with_verdict(m.score(e, fitted)) if fitted else v.with_verdict(e).withColumns({"model_class": F.lit(None).cast("string"), "model_confidence": F.lit(None).cast("double")})
    return judged.select("cell_lat", "cell_lon", "episode_seq", "label", "model_class", "model_confidence", "final_class", "model_agrees", "needs_review", "review_reason")


@query()
def model_holdout(spark, sf_dir):
    e = g.written_star(spark, sf_dir)
    kinds = (("site", m.site_holdout(e)), ("time", m.time_holdout(e)), ("leak_control", m.leak_control(e)))
    # a split with fewer than two labels to learn from has no model, so nothing to report
    none = spark.createDataFrame([], f"{m.REPORT}, split string")
    return s.union_all([none, *[r.withColumn("split", F.lit(n)) for n, r in kinds if r is not None]])


@query()
def model_importance(spark, sf_dir):
    lost = m.importance(g.written_star(spark, sf_dir))
    return spark.createDataFrame([], m.IMPORTANCE) if lost is None else lost


@query()
def bundle_json(spark, sf_dir):
    return k.bundle(materialise(g.judged(spark, sf_dir).where(v.inside(False)), "judged"), [n for n, _ in g.STATES])


def queries() -> dict[str, Run]:
    return {n: c.run for n, c in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {n: c.sql for n, c in QUERIES.items() if c.sql}
