"""Run the headline queries and print one JSON line.

Each query runs to completion into a sink that keeps nothing. One untimed pass over
the first query warms the JVM; every query is then timed several times and the
median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from terraframe.plans.queries import QUERIES
from terraframe.session import local_session

HEADLINE = [
    "et_penman_monteith", "fao56_et0", "overlay_3way", "overlay_outer", "overlay_tiles", "rasterize", "flatten",
    "raster_minmax", "tile_count", "reshape_nn", "range_query_count", "range_pushdown", "range_polygons",
    "pip_intersects", "pip_contains", "pip_concave", "pip_parcels", "pip_attributes", "geotag_points",
    "envelope_join", "join_parcels_regions", "join_regions_contain", "range_polygon_shapes", "road_segments", "feature_summary", "polygon_centroid", "spatial_partition", "indexed_range",
    "pyramid_counts", "index_pyramid", "cluster_cells", "granule_missing",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, "bench", spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(names[0])
    seconds = {name: round(statistics.median(run(name) for _ in range(repeats)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
             "queries": seconds, "sf": Path(folder).name.removeprefix("sf"), "cpus": cpus, "repeats": repeats}
        )
    )


if __name__ == "__main__":
    main()
