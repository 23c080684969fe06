"""Column functions: tolerant casts, rounding, planar geometry, categories. All stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from ..schema import LANDCOVER, M_LON, M_PER_DEG, TAG_KEYS

Num = Column | str | float


def col(x: Num) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def number(x: Num) -> Column:
    """A double; what can't be read, and NaN, is null."""
    v = col(x).try_cast("double")
    return F.when(~F.isnan(v), v)


def date(x: Num) -> Column:
    return col(x).try_cast("date")


def rounded(x: Num, digits: int) -> Column:
    """Scaled, rounded half to even, scaled back."""
    return F.rint(col(x) * 10.0**digits) / 10.0**digits


def cell(x: Num, step: float = 0.01) -> Column:
    return F.rint(col(x) / step).cast("int")


def mean_coordinate(x: str) -> Column:
    """Mean of coordinates of five decimals, summed as whole numbers: the same in any order of rows."""
    return F.avg(F.rint(F.col(x) * 100000).cast("bigint")) / 100000


def mean_share(x: str) -> Column:
    """Mean of numbers of four decimals, summed as whole numbers."""
    return F.avg(F.rint(F.col(x) * 10000).cast("bigint")) / 10000


def slope(x: str, y: str) -> Column:
    """Least-squares slope of y against x from sums; 0 where x doesn't vary. Null y counts as 0."""
    n, fx, fy = F.count(F.lit(1)), F.col(x).cast("double"), F.coalesce(F.col(y), F.lit(0.0))
    sx, sy, sxx, sxy = F.sum(fx), F.sum(fy), F.sum(fx * fx), F.sum(fx * fy)
    under = n * sxx - sx * sx
    return F.when(under > 0, (n * sxy - sx * sy) / F.when(under != 0, under)).otherwise(0.0)


def lookup(key: Column, table: Mapping, default: str | None = None) -> Column:
    pairs = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def landcover_name(code: Num) -> Column:
    return lookup(col(code).cast("int"), LANDCOVER, "unknown")


def metres(lat1: Num, lon1: Num, lat2: Num, lon2: Num) -> Column:
    """Distance on the plane that is true at the reference latitude."""
    dy, dx = (col(lat1) - col(lat2)) * M_PER_DEG, (col(lon1) - col(lon2)) * M_LON
    return F.sqrt(dy * dy + dx * dx)


def box_metres(lat: Num, lon: Num, min_lat: Num, min_lon: Num, max_lat: Num, max_lon: Num) -> Column:
    """Distance to a box, 0 inside."""
    zero = F.lit(0.0)
    dy = F.greatest(col(min_lat) - col(lat), col(lat) - col(max_lat), zero) * M_PER_DEG
    dx = F.greatest(col(min_lon) - col(lon), col(lon) - col(max_lon), zero) * M_LON
    return F.sqrt(dy * dy + dx * dx)


def extent_metres(lat: Num, min_lat: Num, min_lon: Num, max_lat: Num, max_lon: Num) -> Column:
    """Half the diagonal of a footprint, one decimal."""
    dy, dx = (col(max_lat) - col(min_lat)) * M_PER_DEG, (col(max_lon) - col(min_lon)) * M_PER_DEG * F.cos(F.radians(col(lat)))
    return rounded(F.sqrt(dy * dy + dx * dx) / 2, 1)


def crossings(lat: Column, lon: Column, edges: Column) -> Column:
    """Edges (struct x1, y1, x2, y2) that a ray to the east crosses."""
    hit = lambda e: ((e["y1"] > lat) != (e["y2"] > lat)) & (lon < (e["x2"] - e["x1"]) * (lat - e["y1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"]) + e["x1"])
    return F.size(F.filter(edges, hit))


def on_edge(lat: Column, lon: Column, edges: Column) -> Column:
    touches = lambda e: (
        ((e["x2"] - e["x1"]) * (lat - e["y1"]) == (lon - e["x1"]) * (e["y2"] - e["y1"]))
        & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])) & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
    )
    return F.exists(edges, touches)


def within(lat: Num, lon: Num, edges: Column) -> Column:
    """Strictly inside a polygon given by the edges of its rings: boundary points are outside, holes count."""
    return (crossings(col(lat), col(lon), edges) % 2 == 1) & ~on_edge(col(lat), col(lon), edges)


def ring_area(ring: Column) -> Column:
    """Area of a closed ring (array of lon, lat) by the shoelace sum."""
    pairs = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: a["lon"] * b["lat"] - b["lon"] * a["lat"])
    return F.abs(F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)) / 2


def ring_centroid(ring: Column) -> Column:
    """Centroid (lon, lat) of a closed ring."""
    first, next_ = F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1)
    cross = F.zip_with(first, next_, lambda a, b: F.struct((a["lon"] * b["lat"] - b["lon"] * a["lat"]).alias("w"), (a["lon"] + b["lon"]).alias("x"), (a["lat"] + b["lat"]).alias("y")))
    total = lambda f: F.aggregate(F.transform(cross, f), F.lit(0.0), lambda s, v: s + v)
    weight = total(lambda c: c["w"])
    weight = F.when(weight != 0, weight * 3)
    return F.struct((total(lambda c: c["w"] * c["x"]) / weight).alias("lon"), (total(lambda c: c["w"] * c["y"]) / weight).alias("lat"))


def rounded_ring(ring: Column, digits: int = 3) -> Column:
    """A ring (array of lon, lat) with rounded places, each place once in a row; null if fewer than four are left, as such a
    ring has no area."""
    places = F.transform(ring, lambda p: F.struct(F.round(p["lon"], digits).alias("lon"), F.round(p["lat"], digits).alias("lat")))
    once = F.filter(places, lambda p, i: (i == 0) | (p != F.get(places, i - 1)))
    return F.when(F.size(once) >= 4, once)


def kept_rings(rings: Column, least: float, digits: int = 3) -> Column:
    """Of an array of rings those of at least an area, rounded, largest first."""
    sized = F.transform(F.filter(rings, lambda r: ring_area(r) >= least), lambda r: F.struct((-ring_area(r)).alias("a"), rounded_ring(r, digits).alias("r")))
    return F.transform(F.filter(F.array_sort(sized), lambda s: s["r"].isNotNull()), lambda s: s["r"])


def local_time(at: Column, minutes: int = 330) -> Column:
    """A UTC time on a clock that is minutes ahead (India: 5 hours and a half)."""
    return at + F.make_dt_interval(mins=F.lit(minutes))


def tile_name(lat: Num, lon: Num) -> Column:
    """Name of the 3-degree land-cover tile."""
    south, west = (F.floor(col(lat) / 3) * 3).cast("int"), (F.floor(col(lon) / 3) * 3).cast("int")
    ns, ew = F.when(south >= 0, "N").otherwise("S"), F.when(west >= 0, "E").otherwise("W")
    return F.concat(F.lit("ESA_WorldCover_10m_2021_v200_"), ns, F.lpad(F.abs(south).cast("string"), 2, "0"), ew, F.lpad(F.abs(west).cast("string"), 3, "0"), F.lit("_Map.tif"))


def category(tags: Column) -> Column:
    """Category of a map element by its tags; the first that fits."""
    tag = lambda k: F.coalesce(F.try_element_at(tags, F.lit(k)), F.lit(""))
    ind, made, use, name = (F.lower(tag(k)) for k in ("industrial", "man_made", "landuse", "name"))
    plant, generator = tag("plant:source"), tag("generator:source")
    fuel = F.lower(F.when(plant != "", plant).otherwise(generator))
    power = F.when(fuel.isin("solar", "wind", "hydro", "battery", "tidal", "geothermal"), "power_plant_nonthermal").otherwise("power_plant_thermal")
    return (
        F.when((ind == "refinery") | name.contains("refinery") | name.contains("refineries"), "refinery")
        .when(ind.isin("oil", "gas") | made.isin("petroleum_well", "gasometer", "gasworks"), "oil_gas")
        .when(made == "storage_tank", "storage_tank")
        .when(made.isin("mineshaft", "adit") | (use == "quarry") | name.contains("colliery") | name.contains("coalfield"), "mining")
        .when(tag("power") == "plant", power)
        .when((made == "kiln") | name.contains("brick"), "kiln")
        .when((made == "works") | (ind == "factory"), "factory")
        .when(made == "chimney", "chimney")
        .when(use == "industrial", "industrial_zone")
        .otherwise("other_industrial")
    )


def kept_tags(tags: Column) -> Column:
    return F.to_json(F.map_filter(tags, lambda k, _: k.isin(*TAG_KEYS)))
