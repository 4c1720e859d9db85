import random

import pytest
from pyspark.sql import functions as F

from terraframe.functions.geometry import Box
from terraframe.operators import granules, vector, visual
from terraframe.plans import jobs


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(4)
    rows = [(rng.gauss(0, 9), rng.uniform(-3, 3)) for _ in range(900)] + [(1.5, 1.5)] * 450
    return spark.createDataFrame(rows, "x double, y double").persist()


def test_every_level_counts_every_feature(points):
    levels = visual.pyramid(points).groupBy("z").agg(F.sum("n_features").alias("n"), F.count("*").alias("tiles")).collect()
    assert sorted(r.z for r in levels) == list(range(20))
    assert {r.n for r in levels} == {1350}
    assert next(r.tiles for r in levels if r.z == 0) == 1


def test_levels_equal_a_direct_aggregate(points):
    box = visual.data_bounds(points)
    rolled = visual.pyramid(points, 0, 19).where("z = 4")
    direct = visual.pyramid(points, 4, 4, bounds=box)
    assert rolled.exceptAll(direct).isEmpty() and direct.exceptAll(rolled).isEmpty()


def test_tiles_are_shuffled_once_per_band_of_levels(spark, points, tmp_path):
    points.write.parquet(str(tmp_path / "points"))
    rolled = visual.pyramid(spark.read.parquet(str(tmp_path / "points")), 0, 19)
    rolled.collect()
    text = rolled._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [x for x in text.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    # The counts of the deepest level, then the deepest tiles, those above level 11 and those above level 3.
    assert len(shuffles) == 4 and sum("_tx" in x for x in shuffles) == 3


@pytest.mark.parametrize("low, high", [(0, 7), (0, 8), (3, 12), (5, 5), (0, 30)])
def test_bands_of_levels_join_up(points, low, high):
    box = visual.data_bounds(points)
    rolled = visual.pyramid(points, low, high, bounds=box)
    for z in {low, (low + high) // 2, max(low, high - 8), high}:
        one, direct = rolled.where(F.col("z") == z), visual.pyramid(points, z, z, bounds=box)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, direct.collect()))


def test_threshold_and_bounds(points):
    box = Box(0, 0, 4, 4)
    inside = points.where("x between 0 and 4 and y between 0 and 4").count()
    assert visual.pyramid(points, 0, 0, bounds=box).first().n_features == inside
    assert visual.pyramid(points, 0, 6, threshold=100).agg(F.min("n_features")).first()[0] > 100
    with pytest.raises(ValueError, match="levels"):
        visual.pyramid(points, 3, 2)


def test_far_edge_and_single_place(spark):
    spots = spark.createDataFrame([(0.0, 0.0), (8.0, 8.0)], "x double, y double")
    assert sorted(tuple(r) for r in visual.pyramid(spots, 3, 3).collect()) == [(3, 0, 0, 1), (3, 7, 7, 1)]
    assert visual.pyramid(spots.where("x = 8"), 2, 2).collect()[0].n_features == 1
    assert visual.pyramid(spots.where("x = 9"), 0, 5).count() == 0


def test_clusters_are_complete_and_stay_on_the_canvas(points):
    canvas = visual.Canvas(visual.data_bounds(points), 300, 120)
    clusters = visual.cluster_plot(points, canvas, 50).collect()
    assert sum(r["count"] for r in clusters) == 1350
    for r in clusters:
        assert (r.w, r.h) == (50, 50) and 0 <= r.x <= 250 and 0 <= r.y <= 70


def test_wide_features_widen_their_cluster(spark):
    boxes = spark.createDataFrame([(10.0, 10.0, 90.0, 12.0), (48.0, 10.0, 49.0, 11.0)], "minx double, miny double, maxx double, maxy double")
    rows = visual.cluster_plot(boxes, visual.Canvas(Box(0, 0, 100, 100), 100, 100), 20).collect()
    assert sorted((r["count"], r.w, r.h) for r in rows) == [(2, 80, 20)]


def test_own_plotter(points):
    class Counter(visual.Plotter):
        def __init__(self):
            super().__init__(keys=("side",), aggregates={"n": F.count("*")})

        def prepare(self, features, canvas):
            return features.withColumn("side", canvas.pixel_x(F.col("x")) >= canvas.width // 2)

    rows = visual.plot(points, Counter(), visual.Canvas(Box(-100, -100, 100, 100), 10, 10)).collect()
    assert sum(r.n for r in rows) == 1350 and len(rows) == 2


def test_index_and_visualize(spark, points, tmp_path):
    text = jobs.index_and_visualize(spark, points.withColumn("tag", F.lit("a")), f"{tmp_path}/index", f"{tmp_path}/plot", max_level=8)
    assert '"num_features" : 1350' in text and '"name" : "tag"' in text
    plot = spark.read.parquet(f"{tmp_path}/plot")
    assert plot.where("z = 8").agg(F.sum("n_features")).first()[0] == 1350
    with pytest.raises(Exception, match="(?i)exists"):
        jobs.index_and_visualize(spark, points, f"{tmp_path}/index", f"{tmp_path}/plot")
    jobs.index_and_visualize(spark, points, f"{tmp_path}/index", f"{tmp_path}/plot", max_level=3, overwrite=True)
    assert spark.read.parquet(f"{tmp_path}/plot").agg(F.max("z")).first()[0] == 3


def manifest(spark):
    rows = [("a", 0, 0, 1, 1, "2018-01-01"), ("b", 0, 0, 1, 1, "2018-01-07"), ("c", 0, 0, 1, 1, "2018-01-08"),
            ("d", 5, 5, 6, 6, "2018-01-02"), ("e", 1, 1, 2, 2, "2018-01-03")]
    return spark.createDataFrame([(n, *map(float, b), d) for n, *b, d in rows],
                                 "name string, minx double, miny double, maxx double, maxy double, d string").withColumn("date", F.to_date("d"))


def test_granules(spark):
    wanted = granules.select_granules(manifest(spark), "0.5,0.5,1,1", "2018.01.01..2018.01.07")
    assert sorted(r.name for r in wanted.collect()) == ["a", "b", "e"]
    present = manifest(spark).where("name in ('a', 'd')")
    assert sorted(r.name for r in granules.missing_granules(wanted, present).collect()) == ["b", "e"]
    for bad in ("2018.01.01", "2018.01.07..2018.01.01", "x..y"):
        with pytest.raises(ValueError):
            granules.parse_interval(bad)


def test_summary_counts_empty_features(spark):
    frame = spark.createDataFrame([(1, 2.0, 3.0), (2, None, None)], "id int, x double, y double")
    row = vector.summarize(frame).first()
    assert (row.num_features, row.num_non_empty, row.num_points, row.point_features) == (2, 1, 1, 1)
    assert (row.minx, row.maxy, row.avg_width) == (2.0, 3.0, 0.0)


def test_new_granules_are_taken_once(spark, tmp_path):
    from terraframe.streaming.granule_feed import take_new_granules

    schema = "name string, minx double, miny double, maxx double, maxy double, date date"
    rows = manifest(spark).drop("d")

    def run(rect, checkpoint):
        take_new_granules(spark, f"{tmp_path}/manifest", schema, f"{tmp_path}/taken", f"{tmp_path}/{checkpoint}", rect, "2018.01.01..2018.01.07")
        return sorted(r.name for r in spark.read.parquet(f"{tmp_path}/taken").collect())

    rows.where("name < 'd'").write.parquet(f"{tmp_path}/manifest")
    assert run("0,0,1,1", "first") == ["a", "b"]
    rows.where("name <> 'b'").write.mode("append").parquet(f"{tmp_path}/manifest")
    assert run("0,0,1,1", "first") == ["a", "b", "e"]
    assert run("0,0,9,9", "wider") == ["a", "b", "d", "e"]


def test_any_state_rolls_up(spark):
    """Each level of a plotter's state equals the state made from the features directly."""
    class Hottest(visual.PyramidPlotter):
        def finish(self, cells, side):
            return cells.withColumn("mean", F.col("total") / F.col("n"))

    plotter = Hottest(3, {"n": (F.count("*"), F.sum), "total": (F.sum("v"), F.sum), "top": (F.max("v"), F.max)})
    spots = spark.range(3000).selectExpr(
        "cast(id * 37 % 101 as double) AS x", "cast(id * 53 % 97 as double) AS y", "cast(id % 11 as double) AS v")
    box = Box(0.0, 0.0, 100.0, 96.0)
    rolled = visual.plot_pyramid(spots, plotter, 1, 12, box)
    for z in (1, 4, 5, 12):
        direct = visual.plot_pyramid(spots, plotter, z, z, box)
        assert rolled.where(F.col("z") == z).exceptAll(direct).isEmpty() and direct.exceptAll(rolled).isEmpty()
    assert rolled.where("z = 1").agg(F.max("cell_x"), F.sum("n")).first() == (7, 3000)


def test_cluster_pyramid_sizes(spark):
    boxes = spark.createDataFrame([(0.0, 0.0, 80.0, 8.0), (1.0, 1.0, 1.0, 1.0), (2.0, 2.0, 2.0, 2.0), (None, None, None, None)],
                                  "minx double, miny double, maxx double, maxy double")
    found = visual.plot_pyramid(boxes, visual.ClusterPyramid(2, 64), 0, 3, Box(0.0, 0.0, 100.0, 100.0))
    held = {(r.z, r.tx, r.ty, r.cell_x, r.cell_y): (r.w, r.h, r["count"]) for r in found.collect()}
    assert held[(0, 0, 0, 0, 0)] == (16, 16, 2) and held[(0, 0, 0, 1, 0)] == (52, 16, 1)
    assert held[(3, 3, 0, 0, 1)] == (410, 41, 1)
    with pytest.raises(ValueError, match="divide"):
        visual.ClusterPyramid(3, 100)
    with pytest.raises(ValueError, match="levels"):
        visual.plot_pyramid(boxes, visual.ClusterPyramid(), 0, 29)
