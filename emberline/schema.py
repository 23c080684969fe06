"""Names and constants of the domain. Values here must equal what users' data and labels expect."""

from __future__ import annotations

import math

from pyspark.sql import types as T

# Fixed values of the domain, as text.
CELL_DEG = 0.01
GAP_DAYS = 3
CANDIDATES = 8
POP_WINDOW = 9
FLARE_NIGHTS, PERSIST_NIGHTS, ROUTINE_NIGHTS = 150, 30, 60
CLASSES = ["industrial_fire", "gas_flare", "mining", "agri_burn", "wildfire"]
INCIDENTS = ["industrial_fire", "gas_flare", "mining"]
VEGETATION = ["agri_burn", "wildfire"]
CLASS_CAPS = {"industrial_fire": 3500, "gas_flare": 2500, "mining": 1500, "agri_burn": 2000, "wildfire": 2000}
HOT_CATEGORIES = ["refinery", "oil_gas", "storage_tank", "power_plant_thermal", "factory", "industrial_zone", "kiln", "chimney", "other_industrial"]
CATEGORIES = [*HOT_CATEGORIES, "mining", "power_plant_nonthermal"]
NAMED_CATEGORIES = ["refinery", "mining", "industrial_zone", "power_plant_thermal"]
M_PER_DEG, REF_LAT = 111_320.0, 22.0
CONFIDENCE = {"l": 0.25, "n": 0.60, "h": 0.90}
LANDCOVER = {
    0: "unknown", 10: "tree_cover", 20: "shrubland", 30: "grassland", 40: "cropland", 50: "built_up", 60: "bare_sparse",
    70: "snow_ice", 80: "water", 90: "herbaceous_wetland", 95: "mangroves", 100: "moss_lichen",
}
TAG_KEYS = ["landuse", "man_made", "industrial", "power", "product", "resource", "substance", "plant:source", "generator:source", "plant:output:electricity"]
PASSES = [("Terra", 10.5), ("NOAA-20", 12.67), ("Suomi-NPP", 13.5), ("Aqua", 13.5), ("NOAA-21", 14.33), ("Terra", 22.5), ("NOAA-20", 0.67), ("Suomi-NPP", 1.5), ("Aqua", 1.5), ("NOAA-21", 2.33)]
CITIES = [
    ("New Delhi", 28.61, 77.21), ("Mumbai", 19.08, 72.88), ("Kolkata", 22.57, 88.36), ("Chennai", 13.08, 80.27), ("Bengaluru", 12.97, 77.59),
    ("Hyderabad", 17.39, 78.49), ("Ahmedabad", 23.03, 72.58), ("Jaipur", 26.91, 75.79), ("Lucknow", 26.85, 80.95), ("Bhopal", 23.26, 77.41),
    ("Patna", 25.59, 85.14), ("Nagpur", 21.15, 79.09), ("Guwahati", 26.14, 91.74), ("Bhubaneswar", 20.30, 85.82), ("Surat", 21.17, 72.83),
    ("Visakhapatnam", 17.69, 83.22), ("Kochi", 9.93, 76.27), ("Chandigarh", 30.73, 76.78),
]
BURN_FEATURES = ["n_detections", "n_nights", "duration_days", "frp_max", "frp_mean", "frp_sum", "frp_std", "frp_cv", "frp_trend", "ti4_max", "ti4_mean", "hot_delta", "night_ratio", "confidence", "month"]
PLACE_FEATURES = [
    "site_nights", "site_detections", "site_episodes", "site_span_days", "site_duty_cycle", "site_night_ratio", "site_frp_cv", "d_industrial_hot",
    "d_refinery", "d_oil_gas", "d_storage_tank", "d_power_plant_thermal", "d_factory", "d_industrial_zone", "d_kiln", "d_chimney", "d_mining",
    "d_power_plant_nonthermal", "d_wri_plant", "wri_capacity_mw", "pop_9km", "landcover_code",
]
EPOCH = "2025-01-01"

COS_REF = math.cos(math.radians(REF_LAT))
M_LON = M_PER_DEG * COS_REF

_strings = lambda *names: [T.StructField(n, T.StringType()) for n in names]
#: Detections as text columns, in the two sensors' dialects; casts come later and turn bad values into null.
COMMON = ["source", "latitude", "longitude", "acq_date", "acq_time", "satellite", "confidence", "frp", "daynight", "scan", "track", "type"]
DETECTION_COLUMNS = ["source", "latitude", "longitude", "bright_ti4", "bright_ti5", "acq_date", "acq_time", "satellite", "confidence", "frp", "daynight", "scan", "track", "type"]
RENAMED = {"brightness": "bright_ti4", "bright_t31": "bright_ti5"}
OSM = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("id", T.LongType()), T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("bounds", T.StructType([T.StructField(n, T.DoubleType()) for n in ("minlat", "minlon", "maxlat", "maxlon")])),
    T.StructField("center", T.StructType([T.StructField(n, T.DoubleType()) for n in ("lat", "lon")])),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])
FOOTPRINTS = T.StructType([*_strings("osm_id"), *[T.StructField(n, T.DoubleType()) for n in ("latitude", "longitude", "min_lat", "min_lon", "max_lat", "max_lon", "extent_m")], *_strings("category", "name", "operator", "raw_tags")])
