"""Nearest-feature joins, polygon lookups and rasters without a spatial library."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.columns import box_metres, metres, tile_name, within
from ..schema import CANDIDATES, CATEGORIES, HOT_CATEGORIES, M_LON, NAMED_CATEGORIES, POP_WINDOW
from ..tables import materialise
from .detections import SITE

#: Polygons that go to every executor at most, and boxes of all categories together (and bytes of their names): each site
#: looks at every box that it gets that way. Categories beyond that are joined by buckets.
BROADCAST_FEATURES, BROADCAST_BOXES, BROADCAST_BYTES = 20_000, 2_000, 8 << 20


def nearest_boxes(sites: DataFrame, boxes: DataFrame, categories: Sequence[str] = CATEGORIES, named: Sequence[str] = NAMED_CATEGORIES, k: int = CANDIDATES, most: int = BROADCAST_BOXES, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """sites with d_<category> (and name_<category>): of the k nearest centroids of a category, the nearest box.

    Ties go to the nearer centroid, then to the smaller key. A category without boxes has distance infinity and no
    name. The smallest categories, up to ``most`` boxes and ``most_bytes`` of names together, go to the executors as one row
    of arrays, and sites aren't shuffled for them; the others are joined by buckets.
    """
    size = F.coalesce(F.sum(F.octet_length(F.col("name") if dict(boxes.dtypes)["name"] == "string" else F.to_json("name"))), F.lit(0))
    own = boxes.where(F.col("category").isin(*categories)).groupBy("category").agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).collect()
    counts = {r.category: (r.n, r.bytes) for r in own}
    few, n, held = [], 0, 0
    for c in sorted(categories, key=lambda c: (counts.get(c, (0, 0)), c)):
        n, held = n + counts.get(c, (0, 0))[0], held + counts.get(c, (0, 0))[1]
        if n <= most and held <= most_bytes:
            few.append(c)
    small, large = [c for c in categories if c in few], [c for c in categories if c not in few]
    out = near_by_arrays(sites, boxes, small, named, k) if small else sites
    return near_by_buckets(out, boxes, large, named, k, max(counts[c][0] for c in large)) if large else out


def with_nearest(df: DataFrame, best: dict[str, Column], named: Sequence[str]) -> DataFrame:
    far = F.lit(float("inf"))
    return df.withColumns({f"d_{c}": F.coalesce(b["d"], far) for c, b in best.items()} | {f"name_{c}": b["name"] for c, b in best.items() if c in named})


def near_by_arrays(sites: DataFrame, boxes: DataFrame, categories: Sequence[str], named: Sequence[str], k: int) -> DataFrame:
    fields = ["latitude", "longitude", "min_lat", "min_lon", "max_lat", "max_lon", "key", "name"]
    per = [F.collect_list(F.when(F.col("category") == c, F.struct(*fields))) for c in categories]
    row = F.broadcast(boxes.where(F.col("category").isin(*categories)).agg(F.array(*per).alias("__boxes")))
    lat, lon = F.col("latitude"), F.col("longitude")

    def best(own: Column) -> Column:
        near = F.transform(own, lambda f: F.struct(
            metres(lat, lon, f["latitude"], f["longitude"]).alias("cd"), f["key"].alias("key"),
            box_metres(lat, lon, f["min_lat"], f["min_lon"], f["max_lat"], f["max_lon"]).alias("d"), f["name"].alias("name")))
        first = F.slice(F.array_sort(near), 1, k)
        return F.array_min(F.transform(first, lambda s: F.struct(s["d"].alias("d"), s["cd"].alias("cd"), s["key"].alias("key"), s["name"].alias("name"))))

    # few rows with much work each: a fixed number of partitions keeps the planner from putting them in one task
    parts = max(int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions")), sites.sparkSession.sparkContext.defaultParallelism)
    both = sites.repartition(parts, *[c for c in SITE if c in sites.columns] or ["latitude", "longitude"]).crossJoin(row)
    # one expression over an array of the categories' boxes: the plan doesn't grow with the categories
    out = both.withColumn("__best", F.transform("__boxes", best))
    out = with_nearest(out, {c: F.col("__best")[i] for i, c in enumerate(categories)}, named)
    return out.drop("__boxes", "__best")


def near_by_buckets(sites: DataFrame, boxes: DataFrame, categories: Sequence[str], named: Sequence[str], k: int, most: int) -> DataFrame:
    """Equi-join on buckets and their neighbours; what isn't surely among those (a site's k-th centroid of a category) goes on
    with buckets twice as wide, until the buckets are as wide as the extent. The first width lets the largest category
    (``most`` boxes) have about 2 * k of its boxes in a bucket's neighbourhood if they lie evenly. A round's results and what is left are
    written, so that no plan grows with the rounds."""
    ends = boxes.agg(F.min("latitude").alias("s"), F.max("latitude").alias("n"), F.min("longitude").alias("w"), F.max("longitude").alias("e")).unionByName(
        sites.agg(F.min("latitude").alias("s"), F.max("latitude").alias("n"), F.min("longitude").alias("w"), F.max("longitude").alias("e"))
    ).agg(F.min("s"), F.max("n"), F.min("w"), F.max("e")).first()
    extent = max(ends[1] - ends[0], ends[3] - ends[2]) if ends and ends[0] is not None else 0.0
    step = max(0.02, extent * (2 * k / (9 * most)) ** 0.5)
    bucket = lambda c, s: F.floor(F.col(c) / s).cast("int")
    cats = F.explode(F.array(*[F.lit(c) for c in categories])).alias("category")
    near_by = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("o")
    left = materialise(sites.select(*SITE, "latitude", "longitude", cats), "near-left")
    found = None
    while True:
        last = step > extent
        q = left.select("*", near_by).select(*SITE, "latitude", "longitude", "category", (bucket("latitude", step) + F.col("o.i")).alias("by"), (bucket("longitude", step) + F.col("o.j")).alias("bx"))
        f = boxes.select("category", "key", "name", F.col("latitude").alias("flat"), F.col("longitude").alias("flon"), "min_lat", "min_lon", "max_lat", "max_lon", bucket("latitude", step).alias("by"), bucket("longitude", step).alias("bx"))
        near = q.join(f, ["category", "by", "bx"]).select(*SITE, "category", "key", "name", metres("latitude", "longitude", "flat", "flon").alias("cd"), box_metres("latitude", "longitude", "min_lat", "min_lon", "max_lat", "max_lon").alias("d"))
        rank = F.row_number().over(Window.partitionBy(*SITE, "category").orderBy("cd", "key"))
        top = near.withColumn("rank", rank).where(F.col("rank") <= k).groupBy(*SITE, "category").agg(
            F.count(F.lit(1)).alias("n"), F.max("cd").alias("reach"), F.min(F.struct("d", "cd", "key", "name")).alias("best"))
        sure = F.lit(True) if last else (F.col("n") == k) & (F.col("reach") <= step * M_LON)
        done = materialise(top.where(sure).select(*SITE, "category", "best"), "near-done")
        found = done if found is None else found.unionByName(done)
        if last:
            break
        left = materialise(left.join(done.select(*SITE, "category"), [*SITE, "category"], "left_anti"), "near-left")
        if left.isEmpty():
            break
        step *= 2
    per = found.groupBy(*SITE).agg(*[F.first(F.when(F.col("category") == c, F.col("best")), ignorenulls=True).alias(f"best_{c}") for c in categories])
    return with_nearest(sites.join(per, SITE, "left"), {c: F.col(f"best_{c}") for c in categories}, named).drop(*[f"best_{c}" for c in categories])


def with_hot(df: DataFrame, categories: Sequence[str] = HOT_CATEGORIES) -> DataFrame:
    """Nearest hot category and its distance; the first category wins ties, also where all are infinitely far."""
    best = F.array_min(F.array(*[F.struct(F.col(f"d_{c}").alias("d"), F.lit(i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(categories)]))
    return df.withColumn("hot", best).withColumns({"d_industrial_hot": F.col("hot.d"), "nearest_hot_category": F.col("hot.c")}).drop("hot")


def nearest_point(sites: DataFrame, points: DataFrame, attributes: Sequence[str], distance: str, most: int = BROADCAST_BOXES) -> DataFrame:
    """sites with the distance to the nearest point and its attributes: k = 1 over features that are points."""
    boxes = points.select("latitude", "longitude", *[F.col(a).alias(b) for a, b in zip(("latitude", "longitude") * 2, ("min_lat", "min_lon", "max_lat", "max_lon"))], "key", F.lit("point").alias("category"), F.struct(*attributes).alias("name"))
    out = nearest_boxes(sites, boxes, ["point"], ["point"], 1, most)
    return out.withColumns({distance: F.col("d_point")} | {a: F.col("name_point")[a] for a in attributes}).drop("d_point", "name_point")


def edges_of(spark: SparkSession, polygons: Sequence[tuple[str, Sequence[Sequence[tuple[float, float]]]]]) -> DataFrame:
    """place (order), name, bounds and edges of polygons given as rings of (lon, lat)."""
    rows = []
    for i, (name, rings) in enumerate(polygons):
        edges = [(float(a[0]), float(a[1]), float(b[0]), float(b[1])) for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]]) if a != b]
        xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
        rows.append((i, name, float(min(xs)), float(min(ys)), float(max(xs)), float(max(ys)), edges))
    return spark.createDataFrame(rows, "place int, name string, west double, south double, east double, north double, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")


def flag_inside(points: DataFrame, polygon: DataFrame | None, flag: str) -> DataFrame:
    """flag: strictly inside the polygon; without a polygon the flag is null."""
    if polygon is None:
        return points.withColumn(flag, F.lit(None).cast("boolean"))
    shape = F.broadcast(polygon.select(F.col("edges").alias("__edges")).limit(1))
    return points.crossJoin(shape).withColumn(flag, within("latitude", "longitude", F.col("__edges"))).drop("__edges")


def first_polygon(points: DataFrame, polygons: DataFrame, keys: Sequence[str], index: str = "state", most: int = BROADCAST_FEATURES) -> DataFrame:
    """points with the order of the first polygon that holds them, -1 without one; boxes first, then edges.

    A sorted array of the polygons goes to the executors, so points aren't shuffled; the number of polygons is checked.
    """
    if polygons.limit(most + 1).count() > most:
        box = points.join(polygons, F.col("longitude").between(F.col("west"), F.col("east")) & F.col("latitude").between(F.col("south"), F.col("north")))
        hits = box.where(within("latitude", "longitude", F.col("edges"))).groupBy(*keys).agg(F.min("place").alias(index))
        return points.join(hits, list(keys), "left").withColumn(index, F.coalesce(index, F.lit(-1)))
    row = F.broadcast(polygons.agg(F.array_sort(F.collect_list(F.struct("place", "west", "south", "east", "north", "edges"))).alias("__places")))
    lat, lon = F.col("latitude"), F.col("longitude")
    held = F.filter("__places", lambda p: lon.between(p["west"], p["east"]) & lat.between(p["south"], p["north"]) & within(lat, lon, p["edges"]))
    return points.crossJoin(row).withColumn(index, F.coalesce(F.get(held, F.lit(0))["place"], F.lit(-1))).drop("__places")


def box_sums(raster: DataFrame, rows: int, cols: int, size: int = POP_WINDOW) -> DataFrame:
    """Sums over size x size pixels of a raster (row, col, value), edges mirrored, in two passes of moving sums."""
    half = size // 2

    def along(df: DataFrame, axis: str, other: str, n: int) -> DataFrame:
        mirrored = F.filter(F.array(F.col(axis), -1 - F.col(axis), 2 * n - 1 - F.col(axis)), lambda p: (p >= -half) & (p < n + half))
        wide = df.select(F.explode(mirrored).alias(axis), other, "value")
        w = Window.partitionBy(other).orderBy(axis).rowsBetween(-half, half)
        return wide.withColumn("value", F.sum("value").over(w)).where(F.col(axis).between(0, n - 1))

    positive = raster.withColumn("value", F.greatest(F.col("value").cast("double"), F.lit(0.0)))
    return along(along(positive, "row", "col", rows), "col", "row", cols).select("row", "col", "value")


def sample_raster(points: DataFrame, raster: DataFrame, x0: float, y0: float, dx: float, dy: float, rows: int, cols: int, name: str) -> DataFrame:
    """points with the raster's value at their place; places outside take the nearest edge pixel."""
    clamp = lambda c, n: F.greatest(F.lit(0), F.least(F.floor(c), F.lit(n - 1))).cast("int")
    placed = points.withColumns({"__row": clamp((F.lit(y0) - F.col("latitude")) / dy, rows), "__col": clamp((F.col("longitude") - F.lit(x0)) / dx, cols)})
    pixels = raster.select(F.col("row").alias("__row"), F.col("col").alias("__col"), F.col("value").alias(name))
    return placed.join(pixels, ["__row", "__col"], "left").drop("__row", "__col")


def sample_tiles(cells: DataFrame, tiles: DataFrame, most: int = 150, step: int = 8, tile_deg: float = 3.0, height: int = 36000) -> DataFrame:
    """cells with the code of their tile's pixel at 1/step resolution: the ``most`` tiles with most cells, others go.

    tiles: (tile, row, col, code) of the full resolution; every step-th row and column is kept. A tile without
    any pixel was not readable, so its cells go; a place without a pixel has code 0.
    """
    n = height // step
    south, west = F.floor(F.col("latitude") / tile_deg) * tile_deg, F.floor(F.col("longitude") / tile_deg) * tile_deg
    named = cells.withColumns({
        "tile": tile_name("latitude", "longitude"), "row": F.floor((south + tile_deg - F.col("latitude")) / (tile_deg / n)).cast("int"),
        "col": F.floor((F.col("longitude") - west) / (tile_deg / n)).cast("int"),
    })
    top = named.groupBy("tile").count().orderBy(F.desc("count"), "tile").limit(most).select("tile")
    coarse = tiles.where((F.col("row") % step == 0) & (F.col("col") % step == 0)).select("tile", F.expr(f"row div {step}").cast("int").alias("row"), F.expr(f"col div {step}").cast("int").alias("col"), "code")
    readable = coarse.select("tile").distinct()
    kept = named.join(F.broadcast(top), "tile", "left_semi").join(readable, "tile", "left_semi")
    return kept.join(coarse, ["tile", "row", "col"], "left").withColumn("landcover_code", F.coalesce("code", F.lit(0)).cast("smallint")).drop("code", "row", "col", "tile")


def tile_grid(spark: SparkSession, west: float, south: float, east: float, north: float, step: float) -> DataFrame:
    """Tiles (south, west, north, east) of a box, the last ones cut at its end."""
    count = lambda a, b: max(0, -int(-(b - a) // step))
    r3 = lambda c: F.rint(c * 1000) / 1000
    lat = spark.range(count(south, north)).select((F.lit(float(south)) + F.col("id") * float(step)).alias("lat"))
    lon = spark.range(count(west, east)).select((F.lit(float(west)) + F.col("id") * float(step)).alias("lon"))
    return lat.crossJoin(F.broadcast(lon)).select(r3(F.col("lat")).alias("south"), r3(F.col("lon")).alias("west"), r3(F.least(F.col("lat") + step, F.lit(float(north)))).alias("north"), r3(F.least(F.col("lon") + step, F.lit(float(east)))).alias("east"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row for each key: the first in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
