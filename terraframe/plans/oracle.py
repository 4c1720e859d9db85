"""The registered queries as SQL for DuckDB, written from the definitions."""

from __future__ import annotations

SURFACE = """SELECT (o_orderkey % 200)::INTEGER AS x, (o_orderkey // 200)::INTEGER AS y,
    273.15::DOUBLE + o_custkey % 40 AS t,
    273.65::DOUBLE + o_custkey % 40 + o_orderkey % 7 - 3 AS t_a,
    0.05::DOUBLE + (o_orderkey % 30) / 100::DOUBLE AS alpha,
    95000::DOUBLE + (o_custkey % 100) * 50 AS p,
    20::DOUBLE + o_custkey % 60 AS rh,
    (o_custkey % 3000)::DOUBLE AS z
    FROM orders"""
LAND = """SELECT (l_orderkey % 200)::INTEGER AS x, (l_orderkey // 200)::INTEGER AS y,
    0.5::DOUBLE + max(l_quantity) / 10::DOUBLE AS u,
    250::DOUBLE + max(l_tax) * 1000::DOUBLE AS r_ld,
    300::DOUBLE + max(l_discount) * 1000::DOUBLE AS r_lu,
    max(l_tax) * 1000::DOUBLE AS r_nl
    FROM lineitem GROUP BY l_orderkey"""
SKY = """SELECT (event_id % 200)::INTEGER AS x, (event_id // 200)::INTEGER AS y,
    100::DOUBLE + value AS r_sd FROM events"""
RASTERS = f"WITH surface AS ({SURFACE}), land AS ({LAND}), sky AS ({SKY})"

SLOPE = ("4098::DOUBLE * (0.6108::DOUBLE * exp(17.27::DOUBLE * (t - 273.15::DOUBLE) / (t - 273.15::DOUBLE + 237.3::DOUBLE)))"
         " / pow(t - 273.15::DOUBLE + 237.3::DOUBLE, 2)")
SVP = "0.611::DOUBLE * exp(17.27::DOUBLE * (t - 273.16::DOUBLE) / (t - 35.86::DOUBLE))"
RESISTANCE = ("ln(10::DOUBLE / 0.005::DOUBLE) * ln(10::DOUBLE / (0.1::DOUBLE * 0.005::DOUBLE))"
              " / (0.41::DOUBLE * 0.41::DOUBLE * u)")
WIND = "u * 4.87::DOUBLE / ln(67.8::DOUBLE * 10 - 5.42::DOUBLE)"
LAMBDA = "(2.501::DOUBLE - 0.00236::DOUBLE * (t - 273.15::DOUBLE)) * 1000000::DOUBLE"
CHAIN = f"""{RASTERS},
one AS (SELECT x, y, t, t_a, p / 1000::DOUBLE AS e_a, {SLOPE} AS delta,
    (1::DOUBLE - alpha) * r_sd + r_ld - r_lu - (1::DOUBLE - 0.98::DOUBLE) * r_ld AS r_n,
    {RESISTANCE} AS r_ah, {SVP} AS e_o, {LAMBDA} AS vaporization
    FROM surface JOIN land USING (x, y) JOIN sky USING (x, y)),
two AS (SELECT *, 1005::DOUBLE * 1.225::DOUBLE * (t - t_a) / r_ah AS h FROM one),
three AS (SELECT *, 3600::DOUBLE * (r_n - h) / (vaporization * 1000::DOUBLE) AS et_inst FROM two),
four AS (SELECT *, (e_o - e_a) * 1005::DOUBLE * 1.225::DOUBLE / (et_inst * 0.66::DOUBLE) - r_ah AS r_s FROM three),
chain AS (SELECT *, (delta * r_n + 1005::DOUBLE * 1.225::DOUBLE * (e_o - e_a) / r_ah)
    / (delta + 0.66::DOUBLE * (1 + r_s / r_ah)) AS le FROM four)"""
SCALARS = """SELECT min(t) - 272.15::DOUBLE AS t_min, max(t) - 272.15::DOUBLE AS t_max,
    min(rh) AS rh_min, max(rh) AS rh_max,
    101.3::DOUBLE * pow((293::DOUBLE - 0.0065::DOUBLE * 10) / 293::DOUBLE, 5.26::DOUBLE) AS pressure FROM surface"""
SCALARS = f"""scalars AS (SELECT *, 0.000665::DOUBLE * pressure AS gamma, (e_max + e_min) / 2 AS e_s,
    (e_min * rh_max / 2 + e_max * rh_min / 2) / 2 AS e_a FROM (
    SELECT *, 0.6108::DOUBLE * exp(17.27::DOUBLE * t_min / (t_min + 237.3::DOUBLE)) AS e_min,
    0.6108::DOUBLE * exp(17.27::DOUBLE * t_max / (t_max + 237.3::DOUBLE)) AS e_max FROM ({SCALARS})))"""


def _xy(key: str, x: str = "x", y: str = "y") -> str:
    return (f"({key} * 7919 % 36000) / 100::DOUBLE - 180::DOUBLE AS {x}, "
            f"({key} * 104729 % 18000) / 100::DOUBLE - 90::DOUBLE AS {y}")


POINTS = f"SELECT event_id, {_xy('event_id')}, event_type, value FROM events"
REGIONS = """SELECT n_nationkey AS region_id, n_name AS "NAME", (-160 + 80 * (n_nationkey % 5))::DOUBLE AS cx,
    (-72 + 36 * (n_nationkey // 5))::DOUBLE AS cy FROM nation"""
PARCELS = f"""SELECT c_custkey, c_mktsegment, {_xy('c_custkey', 'cx', 'cy')},
    0.2::DOUBLE + (c_custkey % 50) / 10::DOUBLE AS w,
    (0.2::DOUBLE + (c_custkey % 50) / 10::DOUBLE) / 2 AS h FROM customer"""
GRANULES = f"""SELECT 'g' || o_orderkey AS name, {_xy('o_orderkey', 'minx', 'miny')},
    {_xy('o_orderkey', 'maxx0', 'maxy0')}, o_orderdate::DATE AS date, o_orderstatus AS status FROM orders"""
GRANULES = f"SELECT * EXCLUDE (maxx0, maxy0), maxx0 + 1 AS maxx, maxy0 + 1 AS maxy FROM ({GRANULES})"
ROADS = f"""SELECT o_orderkey, o_custkey, o_orderstatus || ',' || o_orderpriority AS label,
    {_xy('o_orderkey', 'x1', 'y1')}, {_xy('o_custkey', 'x2', 'y2')} FROM orders"""
FEATURES = (f"WITH points AS ({POINTS}), regions AS ({REGIONS}), parcels AS ({PARCELS}), "
            f"granules AS ({GRANULES}), roads AS ({ROADS})")
INSIDE = "abs(x - cx) / 30 + abs(y - cy) / 15 < 1 - 1e-12"
CLOSED = "abs(x - cx) / 30 + abs(y - cy) / 15 <= 1 + 1e-12"
RANGE = "x >= -128.1::DOUBLE AND x <= -63.8::DOUBLE AND y >= 27.3::DOUBLE AND y <= 54.3::DOUBLE"


def _meets(w: str, h: str) -> str:
    """A diamond and the range box share a point: the nearest box point lies in the diamond."""
    return (f"greatest(-128.1::DOUBLE - cx, 0, cx + 63.8::DOUBLE) / {w}"
            f" + greatest(27.3::DOUBLE - cy, 0, cy - 54.3::DOUBLE) / {h} <= 1")


def _round(*names: str, digits: int = 6) -> str:
    # Adding zero turns a negative zero into a plain one.
    return ", ".join(f"round({n}, {digits}) + 0::DOUBLE AS {n}" for n in names)


ORACLE: dict[str, str] = {
    "raster_tiff": f"{RASTERS} SELECT x, y, round(t, 6) AS t, round(p, 6) AS p FROM surface",
    "bil_load": f"""{RASTERS} SELECT x, y, 0::INTEGER AS band, p AS value FROM surface
        UNION ALL SELECT x, y, 1::INTEGER AS band, z AS value FROM surface""",
    "raster_load": f"{RASTERS} SELECT x, y, t, t_a, p FROM surface",
    "rasterize": f"{RASTERS} SELECT x, y, {_round('u', 'r_ld', 'r_lu', 'r_nl')} FROM land",
    "grid_coords": f"""{RASTERS} SELECT x, y, round(-180::DOUBLE + (x + 0.5::DOUBLE) * 1.8::DOUBLE, 6) + 0::DOUBLE AS centre_x,
        round(-(y + 0.5::DOUBLE), 6) + 0::DOUBLE AS centre_y, (x // 10)::INTEGER AS tx, (y // 10)::INTEGER AS ty,
        (y % 10 * 10 + x % 10)::INTEGER AS tile_offset FROM surface""",
    "map_pixels": f"{RASTERS} SELECT x, y, round(t - 272.15::DOUBLE, 6) + 0::DOUBLE AS t, round(p / 1000::DOUBLE, 6) + 0::DOUBLE AS p FROM surface",
    "band_select": """SELECT (l_orderkey % 200)::INTEGER AS x, (l_orderkey // 200)::INTEGER AS y,
        max(l_quantity) AS value FROM lineitem WHERE l_linenumber = 1 GROUP BY l_orderkey""",
    "flatten": f"{RASTERS} SELECT x, y, t, p FROM surface",
    "raster_minmax": f"""{RASTERS} SELECT round(min(t), 6) + 0::DOUBLE AS t_min, round(max(t), 6) + 0::DOUBLE AS t_max,
        round(min(rh), 6) + 0::DOUBLE AS rh_min, round(max(rh), 6) + 0::DOUBLE AS rh_max FROM surface""",
    "tile_count": f"{RASTERS} SELECT count(*) AS n_tiles FROM (SELECT DISTINCT x // 10, y // 10 FROM land)",
    "pixel_lookup": f"{RASTERS} SELECT x, y, t, t_a, p FROM surface WHERE x = 1 AND y = 4",
    "overlay_3way": f"""{RASTERS} SELECT x, y, {_round('t', 'u', 'r_sd')}, round(t + u + r_sd, 6) + 0::DOUBLE AS total
        FROM surface JOIN land USING (x, y) JOIN sky USING (x, y)""",
    "overlay_outer": f"""{RASTERS} SELECT x, y, {_round('t', 'u', 'r_sd')}
        FROM surface FULL JOIN land USING (x, y) FULL JOIN sky USING (x, y)""",
    "overlay_nested": f"""{RASTERS} SELECT x, y, round({SLOPE}, 6) + 0::DOUBLE AS delta, round({WIND}, 6) + 0::DOUBLE AS u_2,
        round(t, 6) + 0::DOUBLE AS t, round((1 - 0.23::DOUBLE) * r_sd - r_nl, 6) + 0::DOUBLE AS r_n
        FROM surface JOIN land USING (x, y) JOIN sky USING (x, y)""",
    "reshape_nn": f"""{RASTERS}, target_x AS (SELECT unnest(range(75))::INTEGER AS x2),
        target_y AS (SELECT unnest(range((SELECT max(y) FROM surface) + 1))::INTEGER AS y2),
        cols AS (SELECT x2, floor((-180::DOUBLE + (x2 + 0.5::DOUBLE) * 4.8::DOUBLE + 180) / 1.8::DOUBLE)::INTEGER AS x FROM target_x),
        lines AS (SELECT y2, floor((y2 + 0.5::DOUBLE) * 2.5::DOUBLE)::INTEGER AS y FROM target_y)
        SELECT x2 AS x, y2 AS y, t, p FROM surface JOIN cols USING (x) JOIN lines USING (y)""",
    "svp_slope": f"{RASTERS} SELECT x, y, round({SLOPE}, 6) + 0::DOUBLE AS delta FROM surface",
    "svp": f"{RASTERS} SELECT x, y, round({SVP}, 6) + 0::DOUBLE AS e_o FROM surface",
    "aero_resistance": f"{RASTERS} SELECT x, y, round({RESISTANCE}, 6) + 0::DOUBLE AS r_ah FROM land",
    "wind_2m": f"{RASTERS} SELECT x, y, round({WIND}, 6) + 0::DOUBLE AS u_2 FROM land",
    "atm_pressure": f"""{RASTERS} SELECT x, y, round(pressure, 6) + 0::DOUBLE AS pressure, round(0.000665::DOUBLE * pressure, 8) + 0::DOUBLE AS gamma
        FROM (SELECT x, y, 101.3::DOUBLE * pow((293::DOUBLE - 0.0065::DOUBLE * z) / 293::DOUBLE, 5.26::DOUBLE) AS pressure FROM surface)""",
    "net_radiation": f"{CHAIN} SELECT x, y, round(r_n, 6) + 0::DOUBLE AS r_n FROM chain",
    "sensible_heat": f"{CHAIN} SELECT x, y, round(h, 6) + 0::DOUBLE AS h FROM chain",
    "instant_et": f"{CHAIN} SELECT x, y, round(vaporization, 3) + 0::DOUBLE AS vaporization, round(et_inst, 10) + 0::DOUBLE AS et_inst FROM chain",
    "surface_resistance": f"{CHAIN} SELECT x, y, round(1000000::DOUBLE / r_s, 8) + 0::DOUBLE AS inverse_r_s FROM chain",
    "et_penman_monteith": f"""{CHAIN} SELECT x, y, {_round('delta', 'r_n', 'r_ah', 'h', 'e_o')},
        {_round('et_inst', 'le', digits=10)} FROM chain""",
    "tile_algebra": f"{CHAIN} SELECT x, y, round(delta, 6) + 0::DOUBLE AS delta, round(le, 10) + 0::DOUBLE AS le FROM chain",
    "fao56_scalars": f"""{RASTERS}, {SCALARS} SELECT {_round('t_min', 't_max', 'rh_min', 'rh_max', 'pressure', 'e_min', 'e_max', 'e_s', 'e_a')},
        round(gamma, 8) + 0::DOUBLE AS gamma FROM scalars""",
    "fao56_et0": f"""{RASTERS}, {SCALARS},
        stack AS (SELECT x, y, t, {SLOPE} AS delta, {WIND} AS u_2, (1 - 0.23::DOUBLE) * r_sd - r_nl AS r_n
            FROM surface JOIN land USING (x, y) JOIN sky USING (x, y))
        SELECT x, y, {_round('delta', 'r_n', 'u_2')},
        round((0.408::DOUBLE * delta * r_n + gamma * 900 * u_2 * (e_s - e_a) / (t + 273))
            / (delta + gamma * (1 + 0.34::DOUBLE * u_2)), 6) AS et_o FROM stack, scalars""",
    "feature_load": f"{FEATURES} SELECT event_id, {_round('x', 'y')}, event_type, value FROM points",
    "range_query": f"{FEATURES} SELECT event_id, {_round('x', 'y')}, event_type, value FROM points WHERE {RANGE}",
    "range_contains": f"""{FEATURES} SELECT event_id, {_round('x', 'y')}, event_type, value FROM points
        WHERE x > -128 AND x < -64 AND y > 27 AND y < 54""",
    "range_query_count": f"{FEATURES} SELECT count(*) AS n_all, count(*) FILTER ({RANGE}) AS n_in_range FROM points",
    "range_pushdown": """SELECT l_orderkey, l_linenumber, l_extendedprice AS x, l_quantity AS y FROM lineitem
        WHERE l_extendedprice BETWEEN 20000 AND 45000 AND l_quantity BETWEEN 10 AND 30""",
    "range_polygons": f"{FEATURES} SELECT c_custkey, c_mktsegment FROM parcels WHERE {_meets('w', 'h')}",
    "shapefile_load": f"""{FEATURES} SELECT c_custkey, round(cx - w, 6) + 0::DOUBLE AS minx, round(cy - h, 6) + 0::DOUBLE AS miny,
        round(cx + w, 6) + 0::DOUBLE AS maxx, round(cy + h, 6) + 0::DOUBLE AS maxy FROM parcels WHERE {_meets('w', 'h')}""",
    "range_polygon": f"""{FEATURES}, quad AS (SELECT * FROM (VALUES (-100, -40, 60, -70), (60, -70, 120, 30),
            (120, 30, -20, 80), (-20, 80, -100, -40)) AS q(x1, y1, x2, y2))
        SELECT event_id, {_round('x', 'y')}, event_type, value FROM points WHERE NOT EXISTS (SELECT 1 FROM quad
        WHERE (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) <= 1e-9)""",
    "pip_intersects": f"{FEATURES} SELECT region_id, event_id FROM regions JOIN points ON {CLOSED}",
    "pip_contains": f"{FEATURES} SELECT region_id, event_id FROM regions JOIN points ON {INSIDE}",
    "pip_concave": f"""{FEATURES} SELECT region_id, event_id FROM regions JOIN points
        ON {CLOSED} AND (y >= cy OR (x - cx) / 5 + (cy - y) / 15 <= 1 + 1e-12)""",
    "pip_parcels": f"""{FEATURES} SELECT c_custkey, event_id FROM parcels JOIN points
        ON abs(x - cx) / w + abs(y - cy) / h < 1 - 1e-9""",
    "pip_attributes": f"""{FEATURES} SELECT region_id, "NAME", event_id, event_type, value, {_round('x', 'y')}
        FROM regions JOIN points ON {CLOSED}""",
    "geotag_points": f"""{FEATURES} SELECT event_id, {_round('x', 'y')}, event_type, value, "NAME" AS state
        FROM regions JOIN points ON {INSIDE} WHERE {RANGE} AND {_meets('30', '15')}""",
    "wkt_points": f"""{FEATURES} SELECT event_id, 'POINT (' || round(x, 2) || ' ' || round(y, 2) || ')' AS geometry,
        event_type FROM points""",
    "envelope_join": f"""{FEATURES} SELECT name, c_custkey FROM granules JOIN parcels
        ON minx <= cx + w AND maxx >= cx - w AND miny <= cy + h AND maxy >= cy - h""",
    "geojson_features": f"""{FEATURES} SELECT event_id, event_type, 'Point' AS geom_type, {_round('x', 'y')} FROM points""",
    "road_segments": f"""{FEATURES} SELECT o_orderkey, label, o_custkey, {_round('x1', 'y1', 'x2', 'y2')},
        round(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 6) + 0::DOUBLE AS length FROM roads""",
    "line_centroid": f"{FEATURES} SELECT o_orderkey, round((x1 + x2) / 2, 6) + 0::DOUBLE AS x, round((y1 + y2) / 2, 6) + 0::DOUBLE AS y FROM roads",
    "road_summary": f"""{FEATURES} SELECT count(*) AS num_features, count(*) AS num_non_empty,
        2 * count(*) AS num_points, 0::BIGINT AS point_features, count(*) AS line_features,
        0::BIGINT AS polygon_features,
        round(min(least(x1, x2)), 6) + 0::DOUBLE AS minx, round(min(least(y1, y2)), 6) + 0::DOUBLE AS miny,
        round(max(greatest(x1, x2)), 6) + 0::DOUBLE AS maxx, round(max(greatest(y1, y2)), 6) + 0::DOUBLE AS maxy,
        round(avg(abs(x2 - x1)), 6) + 0::DOUBLE AS avg_width, round(avg(abs(y2 - y1)), 6) + 0::DOUBLE AS avg_height FROM roads""",
    "feature_summary": f"""{FEATURES} SELECT count(*) AS num_features, count(*) AS num_non_empty,
        5 * count(*) AS num_points, 0::BIGINT AS point_features, 0::BIGINT AS line_features,
        count(*) AS polygon_features, round(min(cx - w), 6) + 0::DOUBLE AS minx, round(min(cy - h), 6) + 0::DOUBLE AS miny,
        round(max(cx + w), 6) + 0::DOUBLE AS maxx, round(max(cy + h), 6) + 0::DOUBLE AS maxy,
        round(avg(2 * w), 6) + 0::DOUBLE AS avg_width, round(avg(2 * h), 6) + 0::DOUBLE AS avg_height FROM parcels""",
    "polygon_mbr": f"""{FEATURES} SELECT c_custkey, round(cx - w, 6) + 0::DOUBLE AS minx, round(cy - h, 6) + 0::DOUBLE AS miny,
        round(cx + w, 6) + 0::DOUBLE AS maxx, round(cy + h, 6) + 0::DOUBLE AS maxy FROM parcels""",
    # The dented diamond is the diamond less the triangle (0, -h), (w, 0), (w / 6, 0).
    "polygon_centroid": f"""{FEATURES}, areas AS (SELECT *, 2 * w * h AS whole, (w - w / 6) * h / 2 AS cut FROM parcels)
        SELECT c_custkey, round(cx - cut * (w + w / 6) / 3 / (whole - cut), 6) + 0::DOUBLE AS x,
        round(cy + cut * h / 3 / (whole - cut), 6) + 0::DOUBLE AS y FROM areas""",
    # The hole has a sixteenth of the area and its centre a quarter of the width to the right.
    "polygon_centroid_holes": f"""{FEATURES} SELECT c_custkey, round(cx - w / 60, 6) + 0::DOUBLE AS x,
        round(cy, 6) + 0::DOUBLE AS y FROM parcels""",
    "range_contains_boxes": f"""{FEATURES} SELECT name FROM granules
        WHERE minx >= -128 AND maxx <= -64 AND miny >= 27 AND maxy <= 54""",
    # Lines of the first two kinds run on the border; one of the third kind does not if its ends are on two sides, off the corner.
    "range_contains_lines": f"""{FEATURES}, ends AS (SELECT *, least(54, greatest(27, y1)) AS sy, least(-64, greatest(-128, x2)) AS bx FROM roads)
        SELECT o_orderkey FROM ends WHERE (o_orderkey % 4 = 2 AND sy > 27 AND bx > -128)
        OR (o_orderkey % 4 = 3 AND least(x1, x2) >= -128 AND greatest(x1, x2) <= -64 AND least(y1, y2) >= 27 AND greatest(y1, y2) <= 54
            AND NOT (x1 = x2 AND (x1 = -128 OR x1 = -64)) AND NOT (y1 = y2 AND (y1 = 27 OR y1 = 54)))""",
    # Diamonds of one proportion meet (or lie in each other) where their sizes add up to (or make up for) the distance.
    "join_parcels_regions": f"""{FEATURES} SELECT region_id, c_custkey FROM regions r JOIN parcels p
        ON abs(p.cx - r.cx) / (30 + w) + abs(p.cy - r.cy) / (15 + h) <= 1 + 1e-9""",
    "join_regions_contain": f"""{FEATURES} SELECT region_id, c_custkey FROM regions r JOIN parcels p
        ON abs(p.cx - r.cx) / 30 + abs(p.cy - r.cy) / 15 + w / 30 <= 1 + 1e-9""",
    # The distance of a line's points from a diamond is smallest at an end or on one of the diamond's axes.
    "join_roads_regions": f"""{FEATURES}, scaled AS (SELECT region_id, o_orderkey, (x1 - cx) / 30 AS u, (y1 - cy) / 15 AS v,
            (x2 - x1) / 30 AS du, (y2 - y1) / 15 AS dv FROM roads, regions),
        places AS (SELECT *, greatest(0, least(1, coalesce(-u / nullif(du, 0), 0))) AS s,
            greatest(0, least(1, coalesce(-v / nullif(dv, 0), 0))) AS t FROM scaled)
        SELECT region_id, o_orderkey FROM places WHERE least(abs(u) + abs(v), abs(u + du) + abs(v + dv),
            abs(u + s * du) + abs(v + s * dv), abs(u + t * du) + abs(v + t * dv)) <= 1 + 1e-9""",
    "range_polygon_shapes": f"""{FEATURES}
        SELECT c_custkey, 'intersects' AS predicate FROM parcels WHERE abs(cx) / (90 + w) + abs(cy) / (45 + h) <= 1 + 1e-9
        UNION ALL SELECT c_custkey, 'contains' FROM parcels WHERE abs(cx) / 90 + abs(cy) / 45 + w / 90 <= 1 + 1e-9""",
    "drop_to_2d": f"""{FEATURES} SELECT 'point' AS kind, round(x, 6) + 0::DOUBLE AS minx, round(y, 6) + 0::DOUBLE AS miny,
        round(x, 6) + 0::DOUBLE AS maxx, round(y, 6) + 0::DOUBLE AS maxy FROM points
        UNION ALL SELECT 'box', {_round('minx', 'miny', 'maxx', 'maxy')} FROM granules""",
    "spatial_partition_check": f"""{FEATURES} SELECT count(*) AS n_features, 16::BIGINT AS n_parts, true AS balanced,
        0::BIGINT AS n_overlaps, count(DISTINCT event_id) AS n_seen_once,
        round(min(x), 6) + 0::DOUBLE AS minx, round(max(x), 6) + 0::DOUBLE AS maxx, round(min(y), 6) + 0::DOUBLE AS miny, round(max(y), 6) + 0::DOUBLE AS maxy FROM points""",
    "indexed_range": f"{FEATURES} SELECT event_id, {_round('x', 'y')} FROM points WHERE {RANGE}",
    "pyramid_counts": f"""{FEATURES}, box AS (SELECT min(x) AS x0, min(y) AS y0,
            greatest(max(x) - min(x), max(y) - min(y)) AS side FROM points),
        levels AS (SELECT unnest(range(20))::INTEGER AS z),
        placed AS (SELECT z, least(floor((x - x0) / side * pow(2, z)), pow(2, z) - 1)::INTEGER AS tx,
            least(floor((y - y0) / side * pow(2, z)), pow(2, z) - 1)::INTEGER AS ty FROM points, box, levels)
        SELECT z, tx, ty, count(*) AS n_features FROM placed GROUP BY z, tx, ty""",
    "pyramid_clusters": f"""WITH boxes AS (SELECT cx - w AS minx, cx + w AS maxx, cy - h AS miny, cy + h AS maxy FROM ({PARCELS})),
        box AS (SELECT min(minx) AS x0, min(miny) AS y0, greatest(max(maxx) - min(minx), max(maxy) - min(miny)) AS side FROM boxes),
        levels AS (SELECT unnest(range(9))::INTEGER AS z),
        placed AS (SELECT z, side, maxx - minx AS w, maxy - miny AS h,
            least(floor(((minx + maxx) / 2 - x0) / side * pow(2, z + 2)), pow(2, z + 2) - 1)::INTEGER AS cx,
            least(floor(((miny + maxy) / 2 - y0) / side * pow(2, z + 2)), pow(2, z + 2) - 1)::INTEGER AS cy FROM boxes, box, levels)
        SELECT z, cx >> 2 AS tx, cy >> 2 AS ty, cx & 3 AS cell_x, cy & 3 AS cell_y,
            greatest(64, ceil(max(w) / any_value(side) * 256 * pow(2, z)))::INTEGER AS w,
            greatest(64, ceil(max(h) / any_value(side) * 256 * pow(2, z)))::INTEGER AS h, count(*) AS count
        FROM placed GROUP BY z, cx, cy""",
    "cluster_cells": f"""{FEATURES}, pixels AS (SELECT floor((x + 180) * (1000 / 360::DOUBLE))::INTEGER AS px,
            floor((y + 90) * (500 / 180::DOUBLE))::INTEGER AS py FROM points),
        cells AS (SELECT (px // 50)::INTEGER AS cell_x, (py // 50)::INTEGER AS cell_y FROM pixels)
        SELECT cell_x, cell_y, least(cell_x * 50, 950)::INTEGER AS x, least(cell_y * 50, 450)::INTEGER AS y,
        50::INTEGER AS w, 50::INTEGER AS h, count(*) AS count FROM cells GROUP BY cell_x, cell_y""",
    "granule_select": f"""{FEATURES} SELECT name, date FROM granules
        WHERE date BETWEEN DATE '1995-01-01' AND DATE '1997-12-31' AND minx <= -112.742::DOUBLE AND maxx >= -125.53::DOUBLE
        AND miny <= 43.213::DOUBLE AND maxy >= 30.751::DOUBLE""",
    "granule_missing": f"""{FEATURES} SELECT name, date FROM granules
        WHERE date BETWEEN DATE '1995-01-01' AND DATE '2000-12-31' AND minx <= 12.742::DOUBLE AND maxx >= -125.53::DOUBLE
        AND miny <= 43.213::DOUBLE AND maxy >= -30.751::DOUBLE AND status <> 'F'""",
}
ORACLE["overlay_tiles"] = ORACLE["overlay_3way"]
ORACLE["overlay_stored"] = ORACLE["overlay_3way"]
ORACLE["raster_store"] = ORACLE["flatten"]
ORACLE["wkt_polygons"] = ORACLE["polygon_mbr"]
ORACLE["csv_points"] = ORACLE["geotag_points"]
ORACLE["wkt_store"] = ORACLE["polygon_mbr"]
ORACLE["convert_formats"] = ORACLE["geojson_features"]
ORACLE["overwrite_store"] = ORACLE["feature_load"]
ORACLE["summary_json"] = ORACLE["feature_summary"]
ORACLE["index_pyramid"] = ORACLE["pyramid_counts"]
