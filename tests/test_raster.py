import random

import pytest
from pyspark.sql import functions as F

from terraframe.grid import Grid
from terraframe.operators import raster
from terraframe.plans import jobs
from terraframe.sources import rasters

GRID = Grid(-50, 40, -60, 30, 4326, 10, 10, 10, 10)
SPOTS = [(0, 0), (1, 4), (7, 1), (4, 8), (3, 8)]
VALUES = {"a": [34, 47, 5, 1456, 2], "b": [5, 17, 8, 1426, 69], "c": [8, 61, 17, 735, 37]}


def literal(spark, band, grid=GRID):
    rows = [(x, y, float(v)) for (x, y), v in zip(SPOTS, VALUES[band])]
    return raster.rasterize(spark.createDataFrame(rows, f"x int, y int, {band} double"), grid, [band])


def as_dict(frame, *columns):
    return {(r.x, r.y): tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in frame.collect()}


def noise(spark, band, count, width, height, seed):
    rng = random.Random(seed)
    rows = {(rng.randrange(width), rng.randrange(height)): rng.uniform(-5, 5) for _ in range(count)}
    return spark.createDataFrame([(x, y, v) for (x, y), v in rows.items()], f"x int, y int, {band} double")


def test_overlay_goldens(spark):
    layers = [literal(spark, b) for b in "abc"]
    total = jobs.overlay_sum(layers)
    assert as_dict(total, "total") == {(0, 0): 47, (1, 4): 125, (7, 1): 30, (4, 8): 3617, (3, 8): 108}
    one = raster.pixel_at(raster.band_array(raster.overlay(layers), "abc"), 1, 4).first()
    assert one.bands == [47.0, 17.0, 61.0]
    tiles = raster.overlay_tiles([raster.to_tiles(r, GRID) for r in layers])
    assert tuple(raster.tile_pixel_at(tiles, GRID, 1, 4).first()) == (1, 4, 47.0, 17.0, 61.0)


def test_overlay_refuses_equal_band_names(spark):
    with pytest.raises(ValueError, match="band names"):
        raster.overlay([literal(spark, "a"), literal(spark, "a")])


def test_outer_overlay_keeps_single_pixels(spark):
    a, b = literal(spark, "a").where("x < 4"), literal(spark, "b").where("x > 0")
    expected = {(0, 0): (34.0, None), (1, 4): (47.0, 17.0), (7, 1): (None, 8.0), (4, 8): (None, 1426.0), (3, 8): (2.0, 69.0)}
    assert as_dict(raster.overlay([a, b], how="outer"), "a", "b") == expected
    tiled = [raster.to_tiles(r, GRID) for r in (a, b)]
    assert as_dict(raster.flatten(raster.overlay_tiles(tiled, "outer"), GRID), "a", "b") == expected


def test_rasterize_merges_duplicates_and_cuts_the_grid(spark):
    rows = [(1, 1, 2.0), (1, 1, 9.0), (1, 1, None), (2, 2, None), (10, 0, 1.0), (-1, 0, 1.0)]
    pixels = spark.createDataFrame(rows, "x int, y int, value double")
    assert as_dict(raster.rasterize(pixels, GRID), "value") == {(1, 1): 9.0}
    assert as_dict(raster.rasterize(pixels, GRID, agg=F.min), "value") == {(1, 1): 2.0}


@pytest.mark.parametrize("tile", [(10, 10), (7, 3), (64, 64)])
def test_tiles_round_trip_with_partial_edges(spark, tile):
    grid = Grid(0, 0, 35, 28, 4326, 35, 28, *tile)
    pixels = noise(spark, "v", 300, 35, 28, seed=1)
    tiles = raster.to_tiles(pixels, grid)
    assert {len(r.v) for r in tiles.collect()} == {grid.tile_pixels}
    assert as_dict(raster.flatten(tiles, grid), "v") == as_dict(pixels, "v")
    assert raster.tile_count(pixels, grid).first().n_tiles == tiles.count()


def test_grid_of_the_documented_size():
    grid = Grid(0, 0, 1, 1, 4326, 349, 277, 10, 10)
    assert (grid.tiles_across, grid.tiles_down, grid.width * grid.height) == (35, 28, 96673)


def test_coordinates_of_a_flipped_grid(spark):
    row = raster.with_coordinates(literal(spark, "a").where("x = 1"), GRID).first()
    assert (row.centre_x, row.centre_y, row.tx, row.ty, row.tile_offset) == (-51.5, 35.5, 0, 0, 41)


@pytest.mark.parametrize(
    ("source", "target"),
    [
        (Grid(-50, 40, -60, 30, 4326, 20, 14), Grid(-50, 40, -60, 30, 4326, 7, 33)),
        (Grid(-50, 40, -60, 30, 4326, 20, 14), Grid(-58, 31, -49, 45, 4326, 31, 9)),
        (Grid(0, 0, 20, 14, 4326, 20, 14), Grid(3.3, 20, 3.9, -5, 4326, 1000, 40)),
    ],
)
def test_reshape_equals_brute_force(spark, source, target):
    pixels = noise(spark, "v", 200, 20, 14, seed=2)
    held = as_dict(pixels, "v")
    expected = {}
    for x in range(target.width):
        for y in range(target.height):
            cx, cy = target.x1 + (x + 0.5) * target.step_x, target.y1 + (y + 0.5) * target.step_y
            at = (int((cx - source.x1) / source.step_x // 1), int((cy - source.y1) / source.step_y // 1))
            if at in held:
                expected[x, y] = held[at]
    assert as_dict(raster.reshape_nearest(pixels, source, target), "v") == expected


def test_reshape_wants_one_crs(spark):
    with pytest.raises(ValueError, match="srid"):
        raster.reshape_nearest(literal(spark, "a"), GRID, Grid(0, 0, 1, 1, 4269, 2, 2))


def test_map_pixels_and_tiles(spark):
    a = literal(spark, "a")
    doubled = raster.map_pixels(a, a=lambda v: v * 2, b=F.col("a") + 1)
    assert as_dict(doubled, "a", "b")[1, 4] == (94.0, 48.0)
    tiles = raster.map_tiles(raster.to_tiles(a, GRID), lambda t: t * 2)
    assert as_dict(raster.flatten(tiles, GRID), "a")[1, 4] == 94.0


def test_min_max_is_one_pass(spark, plan):
    frame = raster.min_max(literal(spark, "a"))
    assert tuple(frame.first()) == (2.0, 1456.0)


def test_bucketed_rasters_meet_without_a_shuffle(spark, plan):
    grid = Grid(0, 0, 40, 40, 4326, 40, 40, 8, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = []
        for seed, band in enumerate("ab"):
            tiles = raster.to_tiles(noise(spark, band, 400, 40, 40, seed), grid)
            rasters.write_tile_table(tiles, f"bucketed_{band}", buckets=4, mode="overwrite")
            frames.append(spark.table(f"bucketed_{band}"))
        stack = raster.overlay_tiles(frames)
        text = plan(stack)
        assert "Exchange" not in text and "SortMergeJoin" in text
        expected = as_dict(noise(spark, "a", 400, 40, 40, 0), "a").keys() & as_dict(noise(spark, "b", 400, 40, 40, 1), "b").keys()
        assert as_dict(raster.flatten(stack, grid, complete=True), "a").keys() == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_write_modes(spark, tmp_path):
    tiles = raster.to_tiles(literal(spark, "a"), GRID)
    rasters.write_tiles(tiles, f"{tmp_path}/one", GRID, write_mode="compatibility")
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    rasters.write_tiles(tiles, f"{tmp_path}/many", GRID)
    with pytest.raises(Exception, match="(?i)exists"):
        rasters.write_tiles(tiles, f"{tmp_path}/many", GRID)
    rasters.write_tiles(tiles, f"{tmp_path}/many", GRID, mode="overwrite")
    back = raster.flatten(rasters.read_tiles(spark, f"{tmp_path}/many"), GRID)
    assert as_dict(back, "a") == as_dict(literal(spark, "a"), "a")
    # The size of the grid does not matter, and tiles are ordered over the files.
    rasters.write_tiles(tiles, f"{tmp_path}/big", Grid(0, 0, 1, 1, 4326, 100_000, 100_000), write_mode="compatibility")
    assert rasters.read_tiles(spark, f"{tmp_path}/big").exceptAll(tiles).isEmpty()


def test_tiles_are_computed_where_they_lie(spark, plan):
    grid = Grid(0, 0, 40, 40, 4326, 40, 40, 8, 8)
    tiles = [raster.to_tiles(noise(spark, band, 400, 40, 40, seed), grid) for seed, band in enumerate("ab")]
    stack = raster.overlay_tiles(tiles)
    result = raster.compute_tiles(stack, grid, lambda pixels: pixels.withColumn("c", F.col("a") - F.col("b")), ["c"])
    assert plan(result).count("Exchange") == plan(stack).count("Exchange") == 2
    pixels = raster.overlay([noise(spark, band, 400, 40, 40, seed) for seed, band in enumerate("ab")])
    expected = {key: a - b for key, (a, b) in as_dict(pixels, "a", "b").items()}
    assert as_dict(raster.flatten(result, grid), "c") == expected


def test_penman_monteith_job_on_stored_rasters(spark, tmp_path):
    grid = Grid(0, 0, 20, 10, 4326, 20, 10, 8, 8)
    bands = {"t": 290.0, "t_a": 288.0, "u": 3.0, "r_sd": 400.0, "r_ld": 300.0, "r_lu": 350.0, "alpha": 0.2, "p": 99000.0}
    paths = {}
    for i, (band, value) in enumerate(bands.items()):
        layer = raster.map_pixels(noise(spark, band, 190, 20, 10, i), **{band: lambda v, base=value: v / 1000 + base})
        paths[band] = f"{tmp_path}/{band}"
        rasters.write_tiles(raster.to_tiles(layer, grid), paths[band], grid)
    jobs.run_penman_monteith(spark, paths, grid, f"{tmp_path}/le")
    found = as_dict(raster.flatten(rasters.read_tiles(spark, f"{tmp_path}/le"), grid), "le")
    stack = raster.overlay([raster.flatten(rasters.read_tiles(spark, p), grid) for p in paths.values()])
    expected = as_dict(jobs.penman_monteith(stack), "le")
    assert found.keys() == expected.keys() and len(found) > 0
    assert all(abs(found[k] - v) <= 1e-12 * abs(v) for k, v in expected.items())


def test_tiles_refuse_duplicates_and_drop_pixels_outside(spark):
    grid = Grid(0.0, 10.0, 10.0, 0.0, 4326, 10, 10, 10, 10)
    twice = spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0)], "x int, y int, value double")
    with pytest.raises(Exception, match="two pixels at one place"):
        raster.to_tiles(twice, grid).collect()
    outside = spark.createDataFrame([(-1, 0, 1.0), (9, 9, 2.0)], "x int, y int, value double")
    back = raster.flatten(raster.to_tiles(outside, grid), grid).collect()
    assert [(r.x, r.y, r.value) for r in back] == [(9, 9, 2.0)]
