import io
import json
import struct
import sys
import zipfile
from dataclasses import replace

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from terraframe.functions.geometry import Box
from terraframe.grid import Grid
from terraframe.operators import raster
from terraframe.plans import jobs
from terraframe.sources import bil, features, geojson, roads, shapefile, tiff
from terraframe.sources.writers import FeatureWriter, qualified, register_feature_writer


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data) if isinstance(data, bytes) else path.write_text(data)
    return str(path)


# Roads


def test_roads(spark, tmp_path):
    path = put(tmp_path / "roads.csv", '1,10,-117.5,33.5,11,-117.4,33.6,main\n2,"a, ""b""",1,2,x,3,4\n3,,0,0,,1,1,p,,q\n4,r,0,0,s,1,1,\n')
    rows = roads.load_roads(spark, path).orderBy(F.col("attrs")[0]).collect()
    assert [r.attrs for r in rows] == [["1", "10", "11", "main"], ["2", 'a, "b"', "x"], ["3", "", "", "p", "", "q"], ["4", "r", "s"]]
    assert (rows[0].x1, rows[0].y1, rows[0].x2, rows[0].y2) == (-117.5, 33.5, -117.4, 33.6)
    assert [tuple(p) for p in rows[1].path] == [(1.0, 2.0), (3.0, 4.0)]


@pytest.mark.parametrize("line", ["1,10,abc,33.5,11,-117.4,33.6,main", "1,10,3"])
def test_bad_road_fails_the_job(spark, tmp_path, line):
    path = put(tmp_path / "bad.csv", line + "\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|INVALID_ARRAY_INDEX"):
        roads.load_roads(spark, path).collect()


# GeoJSON

COLLECTION = [
    {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.5, 2.5, 9.0]}, "properties": {"name": "p", "n": 1}},
    {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]]]}, "properties": {"name": "q", "n": 2}},
    {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [
        [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [1, 2], [2, 2], [1, 1]]], [[[8, 8], [9, 8], [9, 9], [8, 8]]]]}, "properties": {"name": "r", "n": 3}},
    {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[0, 0], [3, 4]]}, "properties": {"name": "s", "n": 4}},
    {"type": "Feature", "geometry": None, "properties": {"name": "t", "n": None}},
]


def check_features(frame):
    rows = {r.name: r for r in frame.collect()}
    assert set(rows) == set("pqrst")
    assert (rows["p"].geom_type, rows["p"].x, rows["p"].y, rows["p"].rings, rows["p"].maxy) == ("Point", 1.5, 2.5, None, 2.5)
    assert [len(r) for r in rows["r"].rings] == [5, 4, 4] and rows["r"].maxx == 9.0
    assert [tuple(p) for p in rows["s"].rings[0]] == [(0.0, 0.0), (3.0, 4.0)]
    assert rows["t"].geom_type is None and rows["t"].minx is None


def test_geojson_layouts(spark, tmp_path):
    whole = put(tmp_path / "a.geojson", json.dumps({"type": "FeatureCollection", "features": COLLECTION}, indent=1))
    check_features(geojson.load_geojson(spark, whole, "name string, n int", layout="collection"))
    by_line = ('{"type":"FeatureCollection","features":[' + ",\n".join(json.dumps(f) for f in COLLECTION) + "]}")
    lines = put(tmp_path / "b.geojson", by_line)
    check_features(geojson.load_geojson(spark, lines, "name string, n int", layout="lines"))
    plain = put(tmp_path / "c.geojson", "\n".join(json.dumps(f) for f in COLLECTION))
    check_features(geojson.load_geojson(spark, plain, "name string, n int"))
    assert geojson.load_geojson(spark, plain, layout="lines").first().properties == {"name": "p", "n": "1"}


def test_geojson_never_loses_features_silently(spark, tmp_path):
    crowded = put(tmp_path / "a.geojson", json.dumps({"type": "FeatureCollection", "features": COLLECTION}))
    with pytest.raises(Exception, match="several features"):
        geojson.load_geojson(spark, crowded, layout="lines").collect()
    broken = put(tmp_path / "b.geojson", '{"type": "Feature", "geometry": {"type": "Point", "coord')
    with pytest.raises(Exception, match="(?i)malformed"):
        geojson.load_geojson(spark, broken, layout="lines").collect()
    other = put(tmp_path / "c.geojson", '{"type":"Feature","geometry":{"type":"GeometryCollection"},"properties":{}}')
    with pytest.raises(Exception, match="unsupported"):
        geojson.load_geojson(spark, other, layout="lines").collect()


# Shapefiles


def shp(records):
    """Bytes of a shapefile: records are (type, parts or point)."""
    body = b""
    for number, (kind, geometry) in enumerate(records, 1):
        if kind in (1, 11):
            content = struct.pack("<i2d", kind, *geometry) + (struct.pack("<2d", 7, 8) if kind == 11 else b"")
        elif kind == 0:
            content = struct.pack("<i", 0)
        else:
            flat = [p for part in geometry for p in part]
            firsts = [sum(len(q) for q in geometry[:i]) for i in range(len(geometry))]
            content = struct.pack("<i4d2i", kind, 0, 0, 0, 0, len(geometry), len(flat))
            content += struct.pack(f"<{len(firsts)}i", *firsts) + b"".join(struct.pack("<2d", *p) for p in flat)
        body += struct.pack(">2i", number, len(content) // 2) + content
    return b"\0" * 100 + body


def dbf(names):
    header = struct.pack("<4BIHH20x", 3, 1, 1, 1, len(names), 32 + 2 * 32 + 1, 1 + 8 + 4)
    fields = b"".join(struct.pack("<11sc4xBB14x", n, b"C", size, 0) for n, size in ((b"NAME", 8), (b"NO", 4)))
    return header + fields + b"\r" + b"".join(b" " + n.encode().ljust(8) + str(i).rjust(4).encode() for i, n in enumerate(names))


RING = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]
SHAPES = [(1, (3.0, 4.0)), (5, [RING, HOLE]), (3, [[(0.0, 0.0), (1.0, 1.0)]]), (0, None), (11, (5.0, 6.0))]
NAMES = ["point", "poly", "line", "none", "high"]


@pytest.mark.parametrize("packed", [True, False])
def test_shapefile(spark, tmp_path, packed):
    if packed:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("in/a.shp", shp(SHAPES))
            archive.writestr("in/a.dbf", dbf(NAMES))
        path = put(tmp_path / "a.zip", buffer.getvalue())
    else:
        path = put(tmp_path / "a.shp", shp(SHAPES))
        put(tmp_path / "a.dbf", dbf(NAMES))
    rows = {r.NAME: r for r in features.load_features(spark, path, attributes=["NAME", "NO"]).collect()}
    assert set(rows) == set(NAMES) and rows["high"].NO == "4"
    assert (rows["point"].x, rows["high"].y) == (3.0, 6.0)
    assert [[tuple(p) for p in ring] for ring in rows["poly"].rings] == [RING, HOLE]
    assert rows["line"].geom_type == "LineString" and rows["none"].geom_type is None
    for box, expected in (("1.2,2.5,1.9,2.7", ["poly"]), ("1.5,1.1,1.9,1.4", []), ("0,0,0.1,0.1", ["line", "poly"])):
        inside = features.load_features(spark, path, filter_mbr=box).collect()
        assert sorted(r.attributes["NAME"] for r in inside) == expected


def test_unknown_shape_type_fails(spark, tmp_path):
    path = put(tmp_path / "a.shp", shp([(8, [RING])]))
    with pytest.raises(Exception, match="shape type 8"):
        shapefile.load_shapefile(spark, path).collect()


@pytest.fixture(scope="module")
def shapes(spark):
    """Polygons, lines, points and features without a shape."""
    def ring(*points):
        pairs = [p.split(", ") for p in points]
        return "array(" + ", ".join(f"named_struct('x', id + {x}, 'y', {y})" for x, y in pairs) + ")"

    return spark.range(600).selectExpr(
        "concat('n\u00e4me ', id) AS name", "id AS no", "CASE id % 4 WHEN 0 THEN 'Polygon' WHEN 1 THEN 'MultiLineString' WHEN 2 THEN 'Point' END AS geom_type",
        "if(id % 4 = 2, cast(id as double), null) AS x", "if(id % 4 = 2, 1D, null) AS y",
        f"if(id % 4 < 2, array({ring('0D, 0D', '1D, 0D', '1D, 4D', '0D, 0D')}, {ring('0.5D, 0.1D', '0.6D, 0.1D', '0.5D, 0.1D')}), null) AS rings",
    ).withColumn("geom_type", F.when(F.col("geom_type") == "Polygon", "MultiPolygon").otherwise(F.col("geom_type")))


def test_shapefiles_are_written_and_read_by_many_tasks(spark, shapes, tmp_path):
    path = str(tmp_path / "many")
    features.save_features(shapes, path, "shapefile", range_bytes=20_000)
    assert len(list((tmp_path / "many").glob("part-*.shp"))) > 3 and not list((tmp_path / "many").glob("_temp*"))
    back = features.load_features(spark, path, "shapefile", attributes=["name", "no"], range_bytes=3000)
    assert back.rdd.getNumPartitions() > 15
    names = ["name", "geom_type", "x", "y", "rings"]
    assert sorted(map(str, back.select(*names).collect())) == sorted(map(str, shapes.select(*names).collect()))
    with pytest.raises(Exception, match="already holds"):
        features.save_features(shapes, path, "shapefile")
    features.save_features(shapes.limit(0), path, "shapefile", overwrite=True)
    assert features.load_features(spark, path, "shapefile").count() == 0


def test_filters_reach_the_shapefile_reader(spark, shapes, tmp_path, plan):
    path = str(tmp_path / "some")
    features.save_features(shapes, path, "shapefile")
    found = features.load_features(spark, path, "shapefile", "100.2,0,103.5,3", attributes=["no"])
    scan = next(x for x in plan(found).splitlines() if "BatchScan" in x)
    assert "minx" in scan
    # Feature 101 is a line along the bottom and up to (102, 4), 102 a point, 103 has no shape.
    assert sorted(int(r.no) for r in found.collect()) == [100, 101, 102]
    reader = shapefile._Reader(path, 1 << 20)
    list(reader.pushFilters([shapefile.LessThanOrEqual(("minx",), 103.5), shapefile.GreaterThanOrEqual(("maxx",), 100.2)]))
    read = [n for part in reader.partitions() for batch in reader.read(part) for n in batch.column("minx").to_pylist()]
    assert sorted(read) == [100.0, 101.0, 102.0]


def test_deleted_records_code_pages_and_cut_files(spark, tmp_path):
    table = bytearray(dbf(["point", "poly", "line", "none", "gro\u00df"]).replace("gro\u00df".encode(), b"gro\xdf "))
    put(tmp_path / "a.shp", shp(SHAPES))
    table[32 + 2 * 32 + 1 + 13] = ord("*")
    put(tmp_path / "a.dbf", bytes(table))
    for page, last in ((None, "gro\u00df"), ("1252", "gro\u00df"), ("ISO-8859-5", "gro\u043f"), ("88591", "gro\u00df")):
        if page:
            put(tmp_path / "a.cpg", page)
        rows = [r.NAME for r in features.load_features(spark, f"{tmp_path}/a.shp", attributes=["NAME"]).collect()]
        assert rows == ["point", "line", "none", last]
    body = bytearray(shp(SHAPES))
    struct.pack_into(">i", body, 24, len(body) // 2)
    put(tmp_path / "b.shp", bytes(body[:-8]))
    with pytest.raises(Exception, match="ends at"):
        features.load_features(spark, f"{tmp_path}/b.shp").collect()
    put(tmp_path / "b.shp", bytes(body))
    put(tmp_path / "b.dbf", dbf(NAMES[:-1]))
    with pytest.raises(Exception, match="5 shapes but 4 records"):
        features.load_features(spark, f"{tmp_path}/b.shp").collect()


# Rasters


def test_bil(spark, tmp_path):
    data = (np.arange(12).reshape(3, 4) * 70000 - 9).astype(">i4")
    put(tmp_path / "r.bil", data.tobytes())
    put(tmp_path / "r.hdr", "BYTEORDER M\nNROWS 3\nNCOLS  4\nNBANDS 1\nNBITS 32\nNODATA -9\n")
    held = {(r.x, r.y, r.band): r.value for r in bil.load_bil(spark, f"{tmp_path}/r").collect()}
    assert held == {(x, y, 0): float(data[y, x]) for x in range(4) for y in range(3)}
    assert bil.load_bil(spark, f"{tmp_path}/r", nodata=-9).count() == 11
    little = np.arange(24, dtype="<i2").reshape(3, 2, 4)
    put(tmp_path / "s.bil", little.tobytes())
    put(tmp_path / "s.hdr", "NROWS 3 NCOLS 4 NBANDS 2 NBITS 16")
    held = {(r.x, r.y, r.band): r.value for r in bil.load_bil(spark, f"{tmp_path}/s", dtype="<i2").collect()}
    assert held == {(x, y, b): float(little[y, b, x]) for x in range(4) for y in range(3) for b in range(2)}


@pytest.mark.parametrize(("header", "message"), [
    ("NROWS x NCOLS 4", "expected a number"), ("NROWS 3", "lacks"), ("NROWS 3 NCOLS 4 NBITS 64", "at most 32"),
])
def test_bad_bil_header(spark, tmp_path, header, message):
    with pytest.raises(ValueError, match=message):
        bil.read_header(spark, put(tmp_path / "r.hdr", header))


def tif(order, image, tile=None, nodata=None, compression=1):
    """Bytes of an uncompressed TIFF of a (height, width, bands) array."""
    height, width, bands = image.shape
    dtype = image.dtype.newbyteorder(order)
    blocks = []
    if tile:
        for ty in range(-(-height // tile)):
            for tx in range(-(-width // tile)):
                block = np.zeros((tile, tile, bands), dtype)
                part = image[ty * tile:(ty + 1) * tile, tx * tile:(tx + 1) * tile]
                block[:part.shape[0], :part.shape[1]] = part
                blocks.append(block.tobytes())
    else:
        blocks = [image[y:y + 2].astype(dtype).tobytes() for y in range(0, height, 2)]
    kind = {"u": 1, "i": 2, "f": 3}[image.dtype.kind]
    tags = [(256, 3, [width]), (257, 3, [height]), (258, 3, [image.dtype.itemsize * 8] * bands), (259, 3, [compression]),
            (277, 3, [bands]), (284, 3, [1]), (339, 3, [kind] * bands)]
    sizes = [len(b) for b in blocks]
    tags += [(322, 3, [tile]), (323, 3, [tile]), (324, 4, None), (325, 4, sizes)] if tile else [(273, 4, None), (278, 3, [2]), (279, 4, sizes)]
    if nodata is not None:
        tags.append((42113, 2, nodata))
    tags.sort(key=lambda t: t[0])
    at = 8 + 2 + 12 * len(tags) + 4
    extra, entries = b"", b""
    starts_at = at
    layouts = {3: "H", 4: "I", 2: "s"}
    reserve = sum(len(struct.pack(f"{order}{len(v)}{layouts[k]}", *v)) if k != 2 else len(v) + 1 for _, k, v in tags if v is not None)
    first = starts_at + reserve + 4 * len(blocks) + 64
    offsets = [first + sum(sizes[:i]) for i in range(len(blocks))]
    for tag, k, values in tags:
        values = offsets if values is None else values
        raw = values + b"\0" if k == 2 else struct.pack(f"{order}{len(values)}{layouts[k]}", *values)
        count = len(raw) if k == 2 else len(values)
        if len(raw) > 4:
            entries += struct.pack(order + "HHII", tag, k, count, at + len(extra))
            extra += raw
        else:
            entries += struct.pack(order + "HHI", tag, k, count) + raw.ljust(4, b"\0")
    head = {"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, 8)
    data = head + struct.pack(order + "H", len(tags)) + entries + b"\0" * 4 + extra
    return data.ljust(first, b"\0") + b"".join(blocks)


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("tile", [None, 4])
@pytest.mark.parametrize("dtype", ["float32", "int16", "uint8"])
def test_tiff(spark, tmp_path, order, tile, dtype):
    image = (np.arange(5 * 7 * 2).reshape(5, 7, 2) * 3).astype(dtype)
    path = put(tmp_path / "a.tif", tif(order, image, tile, nodata=b"6"))
    tiles = tiff.load_tiff(spark, path)
    info = tiles.first()
    grid = Grid(0, 0, 7, 5, 4326, info.width, info.height, info.tile_width, info.tile_height)
    for band in range(2):
        pixels = raster.flatten(tiles.where(F.col("band") == band).select("tx", "ty", "tile"), grid)
        held = {(r.x, r.y): r.tile for r in pixels.collect()}
        expected = {(x, y): float(image[y, x, band]) for x in range(7) for y in range(5) if image[y, x, band] != 6}
        assert held == expected


def test_compressed_tiff_is_refused(spark, tmp_path):
    path = put(tmp_path / "a.tif", tif("<", np.zeros((2, 2, 1), "uint8"), compression=5))
    with pytest.raises(Exception, match="uncompressed"):
        tiff.load_tiff(spark, path).collect()


# Sinks and formats


@pytest.fixture()
def points(spark):
    return spark.createDataFrame([(1, "a", 1.5, 2.5), (2, "b;c", -3.0, 4.0)], "id int, text string, x double, y double")


def test_csv_points(spark, points, tmp_path):
    path = f"{tmp_path}/out"
    features.save_features(points, path, "csv")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert "x;y;id;text" in lines and "1.5;2.5;1;a" in lines and '-3.0;4.0;2;"b;c"' in lines
    back = features.load_features(spark, path, "csv", schema="x double, y double, id int, text string")
    assert back.select(points.columns).exceptAll(points).isEmpty()
    with pytest.raises(Exception, match="(?i)exists"):
        features.save_features(points, path, "csv")
    features.save_features(points.limit(1), path, "csv", overwrite=True, x_column=1, y_column=3)
    assert "id;x;text;y" in [r.value for r in spark.read.text(path).collect()]


@pytest.mark.parametrize("fmt", ["wkt", "geojson", "parquet"])
def test_formats_keep_every_geometry(spark, tmp_path, fmt):
    source = put(tmp_path / "a.geojson", "\n".join(json.dumps(f) for f in COLLECTION))
    first = features.load_features(spark, source, "geojson", properties="name string, n int", layout="lines")
    path = f"{tmp_path}/out"
    features.save_features(first, path, fmt)
    extra = {"geojson": {"properties": "name string, n int", "layout": "lines"}}.get(fmt, {})
    check_features(features.load_features(spark, path, fmt, **extra))


def test_wkt_of_a_multipolygon_keeps_holes(spark, tmp_path):
    source = put(tmp_path / "a.geojson", "\n".join(json.dumps(f) for f in COLLECTION))
    frame = geojson.load_geojson(spark, source, "name string", layout="lines")
    text = {r.name: r.g for r in frame.select("name", features.geometry_wkt(frame).alias("g")).collect()}
    assert text["r"].startswith("MULTIPOLYGON (((0.0 0.0") and text["r"].count("((") == 2 and "), (1.0 1.0" in text["r"]
    assert text["s"] == "LINESTRING (0.0 0.0, 3.0 4.0)" and text["p"] == "POINT (1.5 2.5)" and text["t"] is None


def test_wkt_rejects_unknown_shapes(spark, tmp_path):
    path = put(tmp_path / "a.csv", "id;geometry\n1;CIRCLE (0 0, 1 1)\n")
    with pytest.raises(Exception, match="unsupported WKT"):
        features.load_features(spark, path, "wkt").collect()


def test_convert_and_registry(spark, points, tmp_path):
    points.write.parquet(f"{tmp_path}/in.parquet")
    features.convert(spark, f"{tmp_path}/in.parquet", f"{tmp_path}/out", oformat="geojson")
    back = features.load_features(spark, f"{tmp_path}/out", "geojson", properties="id int, text string", layout="lines")
    assert back.select(points.columns).exceptAll(points).isEmpty() and back.count() == 2
    features.convert(spark, f"{tmp_path}/out", f"{tmp_path}/csv", "geojson", "csv", properties="id int, text string", layout="lines")
    assert features.load_features(spark, f"{tmp_path}/csv", "csv").count() == 2
    features.register_reader("constant", lambda session, path, n=1: session.range(n).selectExpr("id", "0D x", "0D y"), ".const")
    assert features.load_features(spark, "some.const", n=3).count() == 3
    assert features.load_features(spark, "some.const", n=3, filter_mbr=Box(1, 1, 2, 2)).count() == 0
    with pytest.raises(ValueError, match="unknown feature format"):
        features.load_features(spark, "a.unknown")
    with pytest.raises(ValueError, match="unknown feature format"):
        features.save_features(points, f"{tmp_path}/x", "unknown")


def test_options_by_input():
    options = {"iformat": "geojson", "iformat[0]": "shapefile", "sep[1]": ","}
    assert features.options_for(options, 0) == {"iformat": "shapefile"}
    assert features.options_for(options, 1) == {"iformat": "geojson", "sep": ","}


def test_range_reaches_the_scan(spark, points, tmp_path, plan):
    points.write.parquet(f"{tmp_path}/p.parquet")
    found = features.load_features(spark, f"{tmp_path}/p.parquet", filter_mbr="0,0,2,3")
    text = plan(found.select("id"))
    assert "GreaterThanOrEqual(x,0.0)" in text and "LessThanOrEqual(y,3.0)" in text
    assert "ReadSchema: struct<id:int,x:double,y:double>" in text and [r.id for r in found.collect()] == [1]


def test_point_in_polygon_job(spark, tmp_path, points):
    put(tmp_path / "poly.shp", shp([(5, [RING, HOLE])]))
    put(tmp_path / "poly.dbf", dbf(["square"]))
    features.save_features(points.unionByName(points.withColumns({"x": F.lit(3.0), "y": F.lit(3.5)})), f"{tmp_path}/points", "geojson")
    options = {"iformat[0]": "shapefile", "attributes[0]": ["NAME", "NO"], "iformat[1]": "geojson", "layout[1]": "lines",
               "properties[1]": "id int, text string"}

    def run(**more):
        jobs.run_point_in_polygon(spark, f"{tmp_path}/poly.shp", f"{tmp_path}/points", f"{tmp_path}/out", options=options, **more)

    run()
    lines = sorted(r.value for r in spark.read.text(f"{tmp_path}/out").collect())
    expected = ["NAME;NO;geometry;id;text", "square;0;POINT (1.5 2.5);1;a", "square;0;POINT (3.0 3.5);1;a", 'square;0;POINT (3.0 3.5);2;"b;c"']
    assert sorted(set(lines)) == sorted(expected)
    with pytest.raises(Exception, match="(?i)exists"):
        run()
    run(overwrite=True)


# Workers cannot import a test module, so its classes travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class TabWriter(FeatureWriter):
    short_name = "tabbed"
    extension = ".tab"

    def initialize(self, out, schema):
        super().initialize(out, schema)
        out.write(("#" + "\t".join(schema.names) + "\n").encode())

    def write(self, row):
        self.out.write(("\t".join(str(v) for v in row) + "\n").encode())

    def close(self):
        self.out.write(b"#end\n")


def test_custom_writer(spark, points, tmp_path):
    register_feature_writer(spark, TabWriter)
    path = tmp_path / "out"
    points.repartition(2).write.format("tabbed").mode("append").save(str(path))
    files = sorted(path.glob("part-*.tab"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert len(files) == 2 and lines.count("#end") == 2 and "1\ta\t1.5\t2.5" in lines
    assert not list(path.glob("_temporary*"))
    with pytest.raises(Exception, match="already holds"):
        points.write.format("tabbed").mode("append").save(str(path))
    points.coalesce(1).write.format("tabbed").mode("overwrite").save(str(path))
    assert len(list(path.glob("part-*.tab"))) == 1


def test_failing_writer_leaves_nothing(spark, points, tmp_path):
    class Broken(TabWriter):
        short_name = "broken"

        def write(self, row):
            raise RuntimeError("disk on fire")

    register_feature_writer(spark, Broken)
    with pytest.raises(Exception, match="disk on fire"):
        points.write.format("broken").mode("append").save(str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("*"))


def test_short_bil_is_refused(spark, tmp_path):
    put(tmp_path / "r.hdr", "NROWS 4\nNCOLS 3\n")
    put(tmp_path / "r.bil", bytes(4 * 3 * 3))
    with pytest.raises(ValueError, match="36 bytes"):
        bil.load_bil(spark, f"{tmp_path}/r")


@pytest.mark.parametrize("line", ['{"type":"Feature","geometry":{"type":"Point","coord', '{"geometry":null}', '{"type":"Feat"}'])
def test_geojson_lines_without_a_feature_are_refused(spark, tmp_path, line):
    good = '{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{}}'
    frame = geojson.load_geojson(spark, put(tmp_path / "f.json", f"{good}\n\n{line}\n"), layout="lines")
    with pytest.raises(Exception):
        frame.collect()


@pytest.mark.parametrize(("stored", "wanted"), [(None, 2), (4, 2), (4, 4), (None, 3)])
def test_tiff_is_cut_to_the_grid(spark, tmp_path, stored, wanted):
    image = np.arange(6 * 4 * 2).reshape(6, 4, 2).astype("int16")
    path = put(tmp_path / "in" / "a.tif", tif("<", image, stored))
    grid = Grid(0, 0, 4, 6, 4326, 4, 6, wanted, wanted)
    pixels = raster.flatten(tiff.load_on_grid(spark, path, grid), grid)
    assert {(r.x, r.y): r.tile for r in pixels.collect()} == {(x, y): float(image[y, x, 0]) for x in range(4) for y in range(6)}
    with pytest.raises(ValueError, match="4 x 7"):
        tiff.load_on_grid(spark, path, Grid(0, 0, 4, 7, 4326, 4, 7, 2, 2))
    put(tmp_path / "in" / "b.tif", tif("<", image, stored))
    with pytest.raises(ValueError, match="exactly one"):
        tiff.load_on_grid(spark, f"{tmp_path}/in", grid)


def test_one_image_is_read_by_several_tasks(spark, tmp_path):
    image = np.arange(64 * 48).reshape(64, 48, 1).astype("int32")
    for stored, count in ((16, 12), (None, 32)):
        path = put(tmp_path / f"{stored}.tif", tif("<", image, stored))
        tiles = tiff.load_tiff(spark, path, range_bytes=1024)
        held = {(r.tx, r.ty): r.tile for r in tiles.collect()}
        height, width = (stored, stored) if stored else (2, 48)
        assert held[(0, 1)] == image[height : 2 * height, :width, 0].ravel().tolist()
        assert len(held) == count
        assert tiles.select(F.spark_partition_id()).distinct().count() > 4


def test_long_strips_are_cut():
    assert tiff._strip_cut(100, 1, 30) == 30 and tiff._strip_cut(100, 4, 30) == 25
    assert tiff._strip_cut(20, 5, 30) == 20 and tiff._strip_cut(97, 2, 30) == 1


def test_single_strip_image(tmp_path):
    image = np.arange(10 * 6).reshape(10, 6, 1).astype("uint8")
    raw = bytearray(tif("<", image))
    # One strip for all lines: rows per strip 10, one offset.
    directory = {struct.unpack_from("<H", raw, 10 + 12 * i)[0]: 10 + 12 * i for i in range(struct.unpack_from("<H", raw, 8)[0])}
    first = struct.unpack_from("<I", raw, struct.unpack_from("<I", raw, directory[273] + 8)[0])[0]
    struct.pack_into("<H", raw, directory[278] + 8, 10)
    struct.pack_into("<II", raw, directory[273] + 4, 1, first)
    struct.pack_into("<II", raw, directory[279] + 4, 1, 60)
    path = put(tmp_path / "one.tif", bytes(raw))
    plans = list(tiff._plan_file(path, 24))
    assert [p["tile_height"] for p in plans] == [4, 4, 4]
    values = [tile.values.to_pylist() for p in plans for *_, tile in tiff._tiles(p, True)]
    assert [v for tile in values for v in tile if v is not None] == list(range(60))


def test_64_bit_tiff(spark, tmp_path):
    data = np.arange(256, dtype="<f4").tobytes()
    tags = [(256, 4, 16), (257, 4, 16), (258, 3, 32), (259, 3, 1), (277, 3, 1), (322, 4, 16), (323, 4, 16),
            (324, 16, 16 + 8 + 20 * 10 + 8), (325, 16, len(data)), (339, 3, 3)]
    body = struct.pack("<Q", len(tags)) + b"".join(struct.pack("<HHQQ", t, k, 1, v) for t, k, v in tags) + bytes(8)
    path = put(tmp_path / "big.tif", b"II" + struct.pack("<HHHQ", 43, 8, 0, 16) + body + data)
    assert tiff.load_tiff(spark, path).first().tile == [float(i) for i in range(256)]


@pytest.mark.parametrize(("dtype", "nodata", "scale"), [("u1", 0, 0.5), ("f4", None, 1.0), ("<i2", -1, 1.0), ("f8", -9.0, 2.0)])
def test_tiff_round_trip(spark, tmp_path, dtype, nodata, scale):
    grid = Grid(10.0, 50.0, 17.0, 40.0, 4326, 70, 100, 16, 16)
    pixels = spark.range(70 * 100).where("id % 7 <> 0 AND id < 6000").selectExpr(
        "cast(id % 70 as int) AS x", "cast(id div 70 as int) AS y", "id % 100 + 1D AS a", "id % 50 + 2D AS b")
    tiles = raster.to_tiles(pixels, grid)
    path = str(tmp_path / "out dir")
    tiff.write_tiff(tiles, path, grid, ["a", "b"], dtype, nodata, scale, block=2)
    assert len(list((tmp_path / "out dir").glob("part-*.tif"))) == 9 and not list((tmp_path / "out dir").glob("_temp*"))
    for number, band in enumerate("ab"):
        back = raster.flatten(tiff.load_mosaic(spark, path, grid, number), grid)
        wanted = {(r.x, r.y): r[band] for r in pixels.collect()}
        assert {(r.x, r.y): r.tile for r in back.collect()} == wanted
    with pytest.raises(Exception, match="already holds"):
        tiff.write_tiff(tiles, path, grid, ["a"], dtype, nodata, scale)
    tiff.write_tiff(tiles.limit(1), path, grid, ["a"], dtype, nodata, scale, overwrite=True)
    assert tiff.load_mosaic(spark, path, grid).count() == 1
    with pytest.raises(Exception, match="does not lie"):
        tiff.load_mosaic(spark, path, replace(grid, x1=10.05, x2=17.05)).collect()


def test_tiff_values_that_do_not_fit_are_refused(spark, tmp_path):
    grid = Grid(0.0, 0.0, 16.0, 16.0, 4326, 16, 16, 16, 16)
    tiles = raster.to_tiles(spark.sql("SELECT 1 AS x, 1 AS y, 300D AS v UNION ALL SELECT 2, 1, 7D"), grid)
    for number, (nodata, message) in enumerate(((255, "does not fit"), (7, "fit|nodata value 7"))):
        with pytest.raises(Exception, match=message):
            tiff.write_tiff(tiles, str(tmp_path / str(number)), grid, ["v"], "u1", nodata)
        assert not list((tmp_path / str(number)).glob("*"))
    with pytest.raises(Exception, match="nodata value 7"):
        tiff.write_tiff(tiles, str(tmp_path / "n"), grid, ["v"], "i2", 7)
    with pytest.raises(ValueError, match="need a nodata"):
        tiff.write_tiff(tiles, str(tmp_path / "m"), grid, ["v"], "u1")
    empty = tiles.limit(0)
    tiff.write_tiff(empty, str(tmp_path / "e"), grid, ["v"])


def test_bil_folder(spark, tmp_path):
    grid = Grid(0.0, 30.0, 12.0, 0.0, 4326, 12, 30, 5, 4)
    pixels = spark.range(12 * 30).where("id % 5 <> 0").selectExpr(
        "cast(id % 12 as int) AS x", "cast(id div 12 as int) AS y", "id * 1000D AS a", "-id - 1D AS b")
    path = str(tmp_path / "lines")
    bil.write_bil(raster.to_tiles(pixels, grid), path, grid, ["a", "b"])
    assert len(list((tmp_path / "lines").glob("*.bil"))) == 8
    back = bil.load_bil_folder(spark, path, grid, nodata=-9999, range_bytes=150)
    assert back.select(F.spark_partition_id()).distinct().count() > 8
    wanted = {(r.x, r.y, i): r[b] for r in pixels.collect() for i, b in enumerate("ab")}
    assert {(r.x, r.y, r.band): r.value for r in back.collect()} == wanted
    with pytest.raises(Exception, match="does not fit"):
        bil.write_bil(raster.to_tiles(pixels, grid), path + "2", grid, ["a"], dtype="<i2")


def test_writer_paths_lie_in_the_default_file_system():
    assert qualified("/a/b", "hdfs://name:9000/") == "hdfs://name:9000/a/b"
    assert qualified("/a/b", "file:///") == "/a/b" and qualified("s3://k/a", "hdfs://name") == "s3://k/a"
    with pytest.raises(ValueError, match="absolute"):
        qualified("a", "hdfs://name")
