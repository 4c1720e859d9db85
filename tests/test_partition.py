import random

import pytest
from pyspark.sql import functions as F

from terraframe.functions.geometry import Box
from terraframe.operators import partition, vector
from terraframe.session import shared_folder


def cloud(spark, count=4000, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.gauss(0, 30), rng.expovariate(0.1)) for i in range(count)]
    return spark.createDataFrame(rows, "id int, x double, y double")


@pytest.mark.parametrize("parts", [1, 2, 7, 16, 60])
def test_points_are_balanced_and_complete(spark, parts):
    points = cloud(spark)
    assigned = partition.SpatialPartitioner.fit(points, parts).assign(points)
    sizes = [r["count"] for r in assigned.groupBy("part_id").count().collect()]
    assert sum(sizes) == 4000 and assigned.select("id").distinct().count() == 4000
    assert len(sizes) >= parts and max(sizes) <= 1.3 * 4000 / parts + 2


def test_partitions_are_disjoint(spark):
    points = cloud(spark)
    boxes = partition.partition_summary(partition.SpatialPartitioner.fit(points, 16).assign(points)).collect()
    for a in boxes:
        for b in boxes:
            if a.part_id < b.part_id:
                assert a.maxx < b.minx or b.maxx < a.minx or a.maxy < b.miny or b.maxy < a.miny


def test_crossing_boxes_are_replicated_with_one_home(spark):
    rng = random.Random(2)
    rows = [(i, x, y, x + rng.uniform(0, 8), y + rng.uniform(0, 8)) for i in range(800)
            for x, y in [(rng.uniform(-50, 50), rng.uniform(-50, 50))]]
    boxes = spark.createDataFrame(rows, "id int, minx double, miny double, maxx double, maxy double")
    partitioner = partition.SpatialPartitioner.fit(boxes, 16)
    assigned = partitioner.assign(boxes, home="is_home")
    assert assigned.count() > 800
    assert assigned.dropDuplicates(["id", "part_id"]).count() == assigned.count()
    homes = assigned.where("is_home")
    assert homes.count() == 800 and homes.select("id").distinct().count() == 800
    # A feature is in the part of every point it covers.
    corner = partitioner.assign(boxes.select("id", F.col("maxx").alias("x"), F.col("maxy").alias("y")))
    missing = corner.select("id", "part_id").join(assigned, ["id", "part_id"], "left_anti")
    assert missing.count() == 0


def test_one_crowded_place(spark):
    points = cloud(spark, 600).unionByName(spark.range(400).selectExpr("cast(id + 600 as int) id", "5D x", "5D y"))
    partitioner = partition.SpatialPartitioner.fit(points, 9)
    assigned = partitioner.assign(points)
    assert assigned.count() == 1000
    assert assigned.where("x = 5 and y = 5").select("part_id").distinct().count() == 1


def test_index_round_trip_prunes_and_splits_crowded_parts(spark, plan):
    points = cloud(spark, 3000).unionByName(
        spark.range(0, 1500, numPartitions=8).selectExpr("cast(id + 3000 as int) id", "5D x", "5D y")
    )
    path = shared_folder(spark, "index")
    partition.write_index(points, partition.SpatialPartitioner.fit(points, 16), path, files=12)
    box = Box(-20, 2, 10, 9)
    found = partition.read_index(spark, path, box)
    met = {r.file.rpartition("part_id=")[2] for r in partition.read_tree(spark, path, box).collect()}
    assert {f.rpartition("part_id=")[2] for f in found.inputFiles()} == met and 0 < len(met) < partition.read_tree(spark, path).count()
    expected = vector.range_query(points, box)
    by_parts = partition.read_index(spark, path, box, named_files=0)
    assert "dynamicpruning" in plan(by_parts) and by_parts.count() == expected.count()
    assert partition.read_index(spark, path, Box(900, 900, 901, 901)).count() == 0
    assert found.select("id", "x", "y").exceptAll(expected).isEmpty() and found.count() == expected.count()
    assert partition.read_index(spark, path).count() == 4500
    # The crowded place is written by several tasks.
    stored = spark.read.parquet(f"{path}/features").where("x = 5 and y = 5")
    assert stored.select(F.input_file_name()).distinct().count() > 1
    with pytest.raises(Exception, match="(?i)exists"):
        partition.write_index(points, partition.SpatialPartitioner.fit(points, 16), path)


def test_index_of_boxes_returns_each_feature_once(spark):
    rng = random.Random(5)
    rows = [(i, x, y, x + rng.uniform(0, 30), y + rng.uniform(0, 30)) for i in range(300)
            for x, y in [(rng.uniform(-50, 50), rng.uniform(-50, 50))]]
    boxes = spark.createDataFrame(rows, "id int, minx double, miny double, maxx double, maxy double")
    path = shared_folder(spark, "index")
    partition.write_index(boxes, partition.SpatialPartitioner.fit(boxes, 25), path)
    box = Box(-3, -3, 4, 4)
    expected = sorted(r.id for r in vector.range_query(boxes, box).collect())
    assert sorted(r.id for r in partition.read_index(spark, path, box).collect()) == expected
    assert partition.read_index(spark, path, copies=True).count() > 300


def test_z_order_keeps_near_points_near(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "x double, y double")
    codes = frame.select(partition.z_order(F.col("x"), F.col("y"), Box(0, 0, 1, 1), 1).alias("z")).collect()
    assert [r.z for r in codes] == [0, 2, 1, 3]


def test_many_cuts_are_one_constant(spark, plan):
    strips, rows = 64, 64
    partitioner = partition.SpatialPartitioner(
        tuple(float(i) for i in range(1, strips)), tuple(tuple(s + i / 100 for i in range(1, rows)) for s in range(strips))
    )
    spots = spark.createDataFrame([(0.5, 0.5), (7.0, 7.305), (63.5, 99.0), (-1.0, -1.0)], "x double, y double")
    assigned = partitioner.assign(spots)
    assert "from_json" not in plan(assigned)
    assert [r.part_id for r in assigned.orderBy("x").collect()] == [0, 50, 7 * 64 + 30, 64 * 64 - 1]


def test_partition_count_is_checked(spark):
    with pytest.raises(ValueError, match="partitions"):
        partition.SpatialPartitioner.fit(cloud(spark, 10), 0)


def test_parts_are_balanced_by_bytes(spark):
    """One feature of a hundred has nine tenths of the vertices, all of them in one corner."""
    path = "array<struct<x:double,y:double>>"
    big = F.pmod("id", F.lit(100)) == 0
    x = F.when(big, F.rand(1) * 5).otherwise(F.rand(2) * 100)
    y = F.when(big, F.rand(3) * 5).otherwise(F.rand(4) * 100)
    spots = spark.range(0, 20_000, numPartitions=4).select("id", x.alias("x0"), y.alias("y0"), F.when(big, 900).otherwise(1).alias("n"))
    lines = spots.select("id", F.expr(f"transform(sequence(1, n), i -> named_struct('x', x0, 'y', y0)) AS path")).withColumn("path", F.col("path").cast(path))
    stored = shared_folder(spark, "lines")
    lines.write.parquet(stored)
    lines = spark.read.parquet(stored)
    partitioner = partition.SpatialPartitioner.fit(lines, 9)
    assert partitioner.bytes == partition.total_bytes(lines) and partitioner.y_cuts == ()
    parts = partition.partition_summary(partitioner.assign(lines)).collect()
    assert sum(p.n_features for p in parts) == 20_000 and len(parts) == 9
    assert max(p.n_bytes for p in parts) <= 1.3 * sum(p.n_bytes for p in parts) / 9
    # By counts alone the parts would differ ninefold and more.
    assert max(p.n_features for p in parts) > 3 * min(p.n_features for p in parts)
    # Without a wish, the number of parts follows from the size.
    by_size = partition.SpatialPartitioner.fit(lines, part_bytes=partitioner.bytes // 4)
    assert 4 <= by_size.strips * by_size.rows <= 9


def test_overlapping_parts_are_found(spark):
    rows = [(0, 0.0, 0.0, 2.0, 2.0), (1, 2.0, 2.0, 3.0, 3.0), (2, 2.5, 2.5, 2.6, 2.6), (3, 9.0, 9.0, 9.0, 9.0)]
    parts = spark.createDataFrame(rows, "part_id int, minx double, miny double, maxx double, maxy double")
    assert sorted(tuple(r) for r in partition.overlapping_parts(parts).collect()) == [(0, 1), (1, 2)]


def test_the_tree_packs_files_partitions_and_strips(spark):
    points = cloud(spark, 2000)
    path = shared_folder(spark, "index")
    partition.write_index(points, partition.SpatialPartitioner.fit(points, 9), path, files=6)
    levels = {n: spark.read.parquet(f"{path}/tree/level={n}") for n in (0, 1, 2)}
    assert all(f.agg(F.sum("n_features")).first()[0] == 2000 for f in levels.values())
    assert levels[1].count() == 9 and levels[2].count() == 3
    for low, high in ((0, 1), (1, 2)):
        outside = levels[low].alias("c").join(levels[high].alias("p"), F.expr("c.parent = p.node")).where(
            "c.minx < p.minx or c.miny < p.miny or c.maxx > p.maxx or c.maxy > p.maxy")
        assert outside.count() == 0
    empty = shared_folder(spark, "index")
    partition.write_index(points.where("false"), partition.SpatialPartitioner.fit(points.where("false"), 4), empty)
    assert partition.read_tree(spark, empty).count() == 0
