"""The queries' oracles: SQL text over the driver's tables, written apart from the DataFrame plans."""

from __future__ import annotations

from ..schema import CANDIDATES, CATEGORIES, CLASS_CAPS, CLASSES, CONFIDENCE, HOT_CATEGORIES, INCIDENTS, LANDCOVER, M_LON, M_PER_DEG, NAMED_CATEGORIES, PASSES
from . import surrogate as g


def r(x: str, digits: int) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def of(table: dict[str, str]) -> str:
    return ", ".join(f"{e.format(RINT='round_r', TEXT='VARCHAR')} AS {n}" for n, e in table.items()).replace("round_r(l_tax * 100)", "round_even(l_tax * 100, 0)")


def quoted(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def metres(a: str, b: str) -> str:
    return f"sqrt(({a}.latitude - {b}.latitude) * {M_PER_DEG!r} * (({a}.latitude - {b}.latitude) * {M_PER_DEG!r}) + ({a}.longitude - {b}.longitude) * {M_LON!r} * (({a}.longitude - {b}.longitude) * {M_LON!r}))"


DY = f"(greatest(f.min_lat - s.latitude, s.latitude - f.max_lat, 0.0) * {M_PER_DEG!r})"
DX = f"(greatest(f.min_lon - s.longitude, s.longitude - f.max_lon, 0.0) * {M_LON!r})"
CONF = "coalesce(CASE WHEN regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?') THEN TRY_CAST(t AS DOUBLE) / 100 END, " + "CASE t " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in CONFIDENCE.items()) + " END, 0.5)"
LC_NAME = "CASE landcover_code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in LANDCOVER.items()) + " ELSE 'unknown' END"


def polygon_rows(polygons) -> str:
    out = []
    for i, (_, rings) in enumerate(polygons):
        for ring in rings:
            for a, b in zip(ring, [*ring[1:], ring[0]]):
                out.append(f"({i}, CAST({a[0]} AS DOUBLE), CAST({a[1]} AS DOUBLE), CAST({b[0]} AS DOUBLE), CAST({b[1]} AS DOUBLE))")
    return ", ".join(out)


def inside(polygons, name: str) -> str:
    """site, place of each polygon that holds it strictly."""
    return f"""{name} AS (
  SELECT s.cell_lat, s.cell_lon, e.place
  FROM st s CROSS JOIN (VALUES {polygon_rows(polygons)}) e(place, x1, y1, x2, y2)
  GROUP BY s.cell_lat, s.cell_lon, e.place
  HAVING sum(CASE WHEN (y1 > s.latitude) <> (y2 > s.latitude) AND s.longitude < (x2 - x1) * (s.latitude - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1
     AND sum(CASE WHEN (x2 - x1) * (s.latitude - y1) = (s.longitude - x1) * (y2 - y1) AND s.latitude BETWEEN least(y1, y2) AND greatest(y1, y2)
                   AND s.longitude BETWEEN least(x1, x2) AND greatest(x1, x2) THEN 1 ELSE 0 END) = 0)"""


SLOPE = "CASE WHEN n * sxx - sx * sx > 0 THEN (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) ELSE 0.0 END"
CTE = {
    "raw": f"raw AS (SELECT {of(g.DETECTION)} FROM lineitem)",
    "det": f"""txt AS (SELECT *, lower(trim(confidence)) AS t FROM raw),
det AS (SELECT l_orderkey, l_linenumber, latitude, longitude, frp, bright_ti4, bright_ti5, acq_date, {CONF} AS confidence, daynight = 'N' AS is_night,
  CAST(round_even(latitude / 0.01, 0) AS INT) AS cell_lat, CAST(round_even(longitude / 0.01, 0) AS INT) AS cell_lon FROM txt)""",
    "seq": """gaps AS (SELECT *, CASE WHEN date_diff('day', lag(acq_date) OVER (PARTITION BY cell_lat, cell_lon ORDER BY acq_date), acq_date) > 3 THEN 1 ELSE 0 END AS begins FROM det),
seq AS (SELECT *, CAST(sum(begins) OVER (PARTITION BY cell_lat, cell_lon ORDER BY acq_date RANGE UNBOUNDED PRECEDING) AS INT) AS episode_seq FROM gaps)""",
    "ep": f"""px AS (SELECT *, date_diff('day', min(acq_date) OVER (PARTITION BY cell_lat, cell_lon, episode_seq), acq_date) AS x FROM seq),
ea AS (SELECT cell_lat, cell_lon, episode_seq, avg(CAST(round_even(latitude * 100000, 0) AS BIGINT)) / 100000 AS latitude, avg(CAST(round_even(longitude * 100000, 0) AS BIGINT)) / 100000 AS longitude,
  min(acq_date) AS "start", max(acq_date) AS "end", count(*) AS n_detections, count(DISTINCT acq_date) AS n_nights, max(frp) AS frp_max, avg(frp) AS frp_mean, coalesce(sum(frp), 0.0) AS frp_sum, stddev_samp(frp) AS frp_std,
  max(bright_ti4) AS ti4_max, avg(bright_ti4) AS ti4_mean, avg(bright_ti5) AS ti5_mean, avg(CAST(is_night AS INT)) AS night_ratio, avg(CAST(round_even(confidence * 10000, 0) AS BIGINT)) / 10000 AS confidence,
  CAST(count(*) AS DOUBLE) AS n, sum(CAST(x AS DOUBLE)) AS sx, sum(coalesce(frp, 0.0)) AS sy, sum(CAST(x AS DOUBLE) * x) AS sxx, sum(x * coalesce(frp, 0.0)) AS sxy FROM px GROUP BY 1, 2, 3),
ep AS (SELECT cell_lat, cell_lon, episode_seq, latitude, longitude, "start", "end", n_detections, n_nights, frp_max, frp_mean, frp_sum, frp_std, ti4_max, ti4_mean, ti5_mean, night_ratio, confidence,
  {SLOPE} AS frp_trend, date_diff('day', "start", "end") + 1 AS duration_days, ti4_mean - ti5_mean AS hot_delta, frp_std / nullif(frp_mean, 0) AS frp_cv, month("start") AS month FROM ea)""",
    "st": """sa AS (SELECT cell_lat, cell_lon, avg(CAST(round_even(latitude * 100000, 0) AS BIGINT)) / 100000 AS latitude, avg(CAST(round_even(longitude * 100000, 0) AS BIGINT)) / 100000 AS longitude,
  count(DISTINCT acq_date) AS site_nights, count(*) AS site_detections, min(acq_date) AS site_first, max(acq_date) AS site_last, avg(frp) AS site_frp_mean, max(frp) AS site_frp_max, stddev_samp(frp) AS site_frp_std,
  avg(CAST(is_night AS INT)) AS site_night_ratio FROM det GROUP BY 1, 2),
se AS (SELECT cell_lat, cell_lon, count(DISTINCT episode_seq) AS site_episodes FROM seq GROUP BY 1, 2),
st AS (SELECT sa.*, site_episodes, date_diff('day', site_first, site_last) + 1 AS site_span_days, site_nights / CAST(greatest(date_diff('day', site_first, site_last) + 1, 1) AS DOUBLE) AS site_duty_cycle,
  site_frp_std / nullif(site_frp_mean, 0) AS site_frp_cv FROM sa JOIN se USING (cell_lat, cell_lon))""",
    "near": f"""fp0 AS (SELECT {of(g.FOOTPRINT)} FROM supplier),
fp AS (SELECT *, latitude - half AS min_lat, longitude - half AS min_lon, latitude + half AS max_lat, longitude + half AS max_lon FROM fp0),
cand AS (SELECT s.cell_lat, s.cell_lon, f.category, f.name, f.key, {metres("s", "f")} AS cd, sqrt({DY} * {DY} + {DX} * {DX}) AS bd FROM st s CROSS JOIN fp f),
k8 AS (SELECT *, row_number() OVER (PARTITION BY cell_lat, cell_lon, category ORDER BY cd, key) AS rk FROM cand),
best AS (SELECT *, row_number() OVER (PARTITION BY cell_lat, cell_lon, category ORDER BY bd, cd, key) AS first FROM k8 WHERE rk <= {CANDIDATES}),
near AS (SELECT cell_lat, cell_lon, {", ".join(f"coalesce(max(CASE WHEN category = '{c}' THEN bd END), CAST('Infinity' AS DOUBLE)) AS d_{c}" for c in CATEGORIES)},
  {", ".join(f"max(CASE WHEN category = '{c}' THEN name END) AS name_{c}" for c in NAMED_CATEGORIES)} FROM best WHERE first = 1 GROUP BY 1, 2),
hot0 AS (SELECT *, least({", ".join("d_" + c for c in HOT_CATEGORIES)}) AS d_industrial_hot FROM near),
hot AS (SELECT *, CASE {" ".join(f"WHEN d_{c} = d_industrial_hot THEN '{c}'" for c in HOT_CATEGORIES)} END AS nearest_hot_category FROM hot0)""",
    "plant": f"""pl AS (SELECT {of(g.PLANT)} FROM supplier),
pc AS (SELECT s.cell_lat, s.cell_lon, {metres("s", "p")} AS d_wri_plant, wri_fuel, wri_capacity_mw, key FROM st s CROSS JOIN pl p),
plant AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell_lat, cell_lon ORDER BY d_wri_plant, key) AS rk FROM pc) WHERE rk = 1)""",
    "lc": f"""lr AS (SELECT cell_lat, cell_lon, {g.LANDCOVER_CODE} AS landcover_code FROM st),
lc AS (SELECT cell_lat, cell_lon, landcover_code, {LC_NAME} AS landcover FROM lr)""",
    "pop": f"""px0 AS (SELECT r.i AS row, c.i AS col FROM range({g.ROWS}) r(i) CROSS JOIN range({g.COLS}) c(i)),
pix AS (SELECT row, col, greatest({g.PIXEL_VALUE}, 0.0) AS value FROM px0),
off AS (SELECT i - 4 AS o FROM range(9) t(i)),
wide AS (SELECT p.row, p.col, CASE WHEN p.row + a.o < 0 THEN -1 - (p.row + a.o) WHEN p.row + a.o >= {g.ROWS} THEN 2 * {g.ROWS} - 1 - (p.row + a.o) ELSE p.row + a.o END AS r2,
  CASE WHEN p.col + b.o < 0 THEN -1 - (p.col + b.o) WHEN p.col + b.o >= {g.COLS} THEN 2 * {g.COLS} - 1 - (p.col + b.o) ELSE p.col + b.o END AS c2 FROM pix p CROSS JOIN off a CROSS JOIN off b),
box AS (SELECT w.row, w.col, sum(p.value) AS value FROM wide w JOIN pix p ON p.row = w.r2 AND p.col = w.c2 GROUP BY 1, 2),
pop AS (SELECT s.cell_lat, s.cell_lon, b.value AS pop_9km FROM st s LEFT JOIN box b ON b.row = greatest(0, least(CAST(floor(({g.Y0} - s.latitude) / {g.PIXEL}) AS INT), {g.ROWS - 1}))
  AND b.col = greatest(0, least(CAST(floor((s.longitude - {g.X0}) / {g.PIXEL}) AS INT), {g.COLS - 1})))""",
    "area": inside(g.BOUNDARY, "area"),
    "state": inside(g.STATES, "state0") + ",\nstate AS (SELECT cell_lat, cell_lon, min(place) AS state FROM state0 GROUP BY 1, 2)",
    "sites": """sites AS (SELECT st.*, hot.* EXCLUDE (cell_lat, cell_lon), d_wri_plant, wri_fuel, wri_capacity_mw, landcover_code, landcover, pop_9km, area.place IS NOT NULL AS in_india, coalesce(state, -1) AS state
  FROM st LEFT JOIN hot USING (cell_lat, cell_lon) LEFT JOIN plant USING (cell_lat, cell_lon) LEFT JOIN lc USING (cell_lat, cell_lon) LEFT JOIN pop USING (cell_lat, cell_lon)
  LEFT JOIN area USING (cell_lat, cell_lon) LEFT JOIN state USING (cell_lat, cell_lon))""",
    "star": """e0 AS (SELECT ep.*, sites.* EXCLUDE (cell_lat, cell_lon, latitude, longitude) FROM ep LEFT JOIN sites USING (cell_lat, cell_lon)),
e1 AS (SELECT *, CASE WHEN site_nights >= 150 THEN 'gas_flare' WHEN d_mining <= 500 AND site_nights >= 30 THEN 'mining'
    WHEN d_industrial_hot <= 500 AND site_nights < 60 AND frp_max >= 15 AND duration_days <= 5 THEN 'industrial_fire'
    WHEN landcover = 'cropland' AND duration_days <= 2 AND night_ratio < 0.5 AND frp_max < 100 AND d_industrial_hot > 2000 AND month IN (3, 4, 5, 10, 11) THEN 'agri_burn'
    WHEN landcover IN ('tree_cover', 'shrubland') AND d_industrial_hot > 5000 AND duration_days >= 2 AND site_nights < 60 THEN 'wildfire' END AS label,
  CASE WHEN site_nights >= 150 THEN 1 WHEN d_mining <= 1000 AND site_nights >= 30 THEN 2 WHEN d_industrial_hot <= 500 AND site_nights < 60 THEN 3
    WHEN landcover IN ('tree_cover', 'shrubland', 'mangroves') AND d_industrial_hot > 500 THEN 4 WHEN landcover = 'cropland' AND duration_days <= 2 AND frp_max < 100 THEN 5
    WHEN d_industrial_hot <= 1500 AND site_nights < 60 AND landcover IN ('built_up', 'bare_sparse', 'grassland', 'cropland', 'unknown') THEN 6
    WHEN landcover = 'cropland' THEN 7 WHEN landcover = 'built_up' THEN 8 ELSE 9 END AS rule FROM e0),
star AS (SELECT *, CASE rule WHEN 1 THEN 'gas_flare' WHEN 2 THEN 'mining' WHEN 3 THEN 'industrial_fire' WHEN 4 THEN 'wildfire' WHEN 5 THEN 'agri_burn' WHEN 6 THEN 'industrial_fire' WHEN 7 THEN 'agri_burn' WHEN 8 THEN 'industrial_fire' ELSE 'wildfire' END AS rule_class,
  CASE rule WHEN 1 THEN 'active >= 150 nights at this cell -> permanent thermal source' WHEN 2 THEN 'inside/near a mine or quarry footprint and recurring' WHEN 3 THEN 'within 500 m of a hot-industry footprint, not a permanent burner'
    WHEN 4 THEN 'forest/scrub land cover and not on top of industry' WHEN 5 THEN 'short daytime burn on cropland' WHEN 6 THEN 'near industry on built-up/bare ground' WHEN 7 THEN 'cropland land cover'
    WHEN 8 THEN 'built-up land cover' ELSE 'default: no industrial context' END AS rule_reason FROM e1)""",
    "judged": f"""j0 AS (SELECT *, {g.PSEUDO_CLASS} AS model_class, {g.PSEUDO_CONFIDENCE} AS model_confidence,
  coalesce(frp_max, 0) * CASE WHEN site_nights < 60 THEN 1.0 ELSE 0.3 END * (1.0 / (1.0 + coalesce(d_industrial_hot, 1e6) / 500.0)) * (1.0 + ln(1 + coalesce(pop_9km, 0)) / 10.0) AS urgency FROM star),
judged AS (SELECT *, rule_class AS final_class, model_class = rule_class AS model_agrees, CASE WHEN model_class = rule_class THEN 'rules+model' ELSE 'rules_only' END AS final_source,
  model_confidence >= 0.8 AND ((rule_class = 'industrial_fire' AND model_class IN ('agri_burn', 'wildfire')) OR (rule_class IN ('agri_burn', 'wildfire') AND model_class = 'gas_flare')) AS needs_review,
  CASE WHEN model_confidence >= 0.8 AND rule_class = 'industrial_fire' AND model_class IN ('agri_burn', 'wildfire') THEN 'near industry but burns like vegetation - possible false alarm'
       WHEN model_confidence >= 0.8 AND rule_class IN ('agri_burn', 'wildfire') AND model_class = 'gas_flare' THEN 'burns like a persistent flare with no industry mapped - possible unmapped source' ELSE '' END AS review_reason,
  {r("urgency", 2)} AS priority FROM j0)""",
}
NEEDS = {
    "raw": [], "det": ["raw"], "seq": ["det"], "ep": ["seq"], "st": ["seq"], "near": ["st"], "plant": ["st"], "lc": ["st"], "pop": ["st"], "area": ["st"], "state": ["st"],
    "sites": ["near", "plant", "lc", "pop", "area", "state"], "star": ["ep", "sites"], "judged": ["star"],
}
KEY = "cell_lat, cell_lon, episode_seq"


def ctes(*names: str) -> list[str]:
    out: list[str] = []

    def add(n: str) -> None:
        for m in NEEDS[n]:
            add(m)
        if n not in out:
            out.append(n)

    for n in names:
        add(n)
    return out


TYPES = {"i": "CAST({c} AS BIGINT)", "d": "round_even(CAST({c} AS DOUBLE) * 1e4, 0) / 1e4", "t": "CAST({c} AS DATE)", "s": "CAST({c} AS VARCHAR)", "b": "CAST({c} AS BOOLEAN)"}


def shaped(spec: str, body: str, *needs: str, more: str = "") -> str:
    """The query's text: the parts it needs, then its columns by the spec's names and types."""
    cols = ", ".join(f"{TYPES[k].format(c=_q(n))} AS {_q(n)}" for n, k in (x.split(":") for x in spec.split()))
    parts = [CTE[n] for n in ctes(*needs)] + ([more] if more else [])
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return f"{head}SELECT {cols} FROM (\n{body}\n) q"


def _q(name: str) -> str:
    return f'"{name}"'


FULL_DIST = "CASE WHEN d_industrial_hot < CAST('Infinity' AS DOUBLE) THEN CAST(trunc(d_industrial_hot) AS BIGINT) ELSE -1 END"
INCIDENT = f"final_class IN ({quoted(INCIDENTS)})"
CAP = "CASE final_class " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in CLASS_CAPS.items()) + " END"
ALERT = f"{KEY}, {r('latitude', 4)} AS lat, {r('longitude', 4)} AS lon, final_class AS cls, CAST(\"start\" AS VARCHAR) AS \"start\", {r('coalesce(frp_max, 0)', 1)} AS frp, duration_days AS dur, site_nights AS nights, coalesce(nearest_hot_category, '-') AS cat, {FULL_DIST} AS dist, CAST(trunc(coalesce(pop_9km, 0)) AS BIGINT) AS pop"
PASS_ROWS = ", ".join(f"({i}, '{n}', CAST({h} AS DOUBLE))" for i, (n, h) in enumerate(PASSES))
MATRIX = ", ".join(f"sum(CASE WHEN final_class = '{c}' THEN 1 ELSE 0 END) AS {c}" for c in CLASSES)
TOP = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY final_class ORDER BY priority DESC, {KEY}) AS place FROM judged WHERE {INCIDENT}) WHERE place <= {CAP}"
