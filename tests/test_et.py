import math

import pytest
from pyspark.sql import functions as F

from terraframe.functions import et
from terraframe.functions.ieee import divide, ln
from terraframe.grid import Grid
from terraframe.operators import raster
from terraframe.plans import jobs

GRID = Grid(-50, 40, -60, 30, 4326, 10, 10, 10, 10)
SPOTS = [(0, 0), (3, 4), (8, 9)]


def same(a, b, rel):
    if b is None or (isinstance(b, float) and math.isnan(b)):
        return a is None if b is None else math.isnan(a)
    return a == b or math.isclose(a, b, rel_tol=rel)


def test_divide_and_ln_follow_ieee(spark):
    row = spark.range(1).select(
        divide(F.lit(1.0), F.lit(0.0) * F.col("id")).alias("a"),
        divide(F.lit(-1.0), F.lit(0.0)).alias("b"),
        divide(F.lit(0.0), F.lit(0.0)).alias("c"),
        divide(F.lit(math.nan), F.lit(0.0)).alias("d"),
        divide(F.lit(1.0), F.lit(None).cast("double")).alias("e"),
        divide(F.lit(6.0), 4).alias("f"),
        ln(0).alias("g"), ln(-1).alias("h"), ln(1).alias("i"),
    ).first()
    expected = [math.inf, -math.inf, math.nan, math.nan, None, 1.5, -math.inf, math.nan, 0.0]
    assert all(same(a, b, 0) for a, b in zip(row, expected))


# Bands, then delta, r_n, r_ah, h, et_inst, e_o, r_s, le.
CHAIN = [
    ((300.0, 298.0, 3.0, 500.0, 350.0, 450.0, 0.2, 101000.0),
     (0.20756192850716093, 293.0, 149.26718797564197, 16.495587767097213, 0.00040835329833701457,
      3.5331662012655483, -445224598.5485961, 0.0003774605768969463)),
    ((285.0, 286.5, 6.5, 120.0, 300.0, 360.0, 0.15, 98000.0),
     (0.09168001175327482, 36.0, 68.89254829645014, -26.805330121532972, 9.142583095805344e-05,
      1.3882891936473505, -1971147331.9350107, 9.125105354668256e-05)),
    ((300.0, 298.0, 0.0, 500.0, 350.0, 450.0, 0.2, 101000.0),
     (0.20756192850716093, 293.0, math.inf, 0.0, 0.0004327146733266767, 3.5331662012655483, -math.inf, math.nan)),
]


@pytest.mark.parametrize(("precision", "rel"), [("double", 1e-9), ("float", 2e-3)])
def test_penman_monteith(spark, precision, rel):
    rows = [(i, 0, *bands) for i, (bands, _) in enumerate(CHAIN)]
    stack = spark.createDataFrame(
        rows, "x int, y int, t double, t_a double, u double, r_sd double, r_ld double, r_lu double, alpha double, p double"
    )
    names = ["delta", "r_n", "r_ah", "h", "et_inst", "e_o", "r_s", "le"]
    found = jobs.penman_monteith(stack, precision).orderBy("x").select(names).collect()
    for row, (_, expected) in zip(found, CHAIN):
        for name, a, b in zip(names, row, expected):
            assert same(a, b, rel), (name, a, b)


def literal(spark, band, values):
    rows = [(x, y, v) for (x, y), v in zip(SPOTS, values)]
    return raster.rasterize(spark.createDataFrame(rows, f"x int, y int, {band} double"), GRID, [band])


@pytest.mark.parametrize("precision", ["double", "float"])
def test_fao56_on_literal_pixels(spark, precision):
    t = literal(spark, "t", [10.1, 200.6, 300.2])
    rh = literal(spark, "rh", [2.7, 2.2, 3.8])
    u = literal(spark, "u", [561.4, 230.7, 766.5])
    r_s = literal(spark, "r_s", [461.1, 356.7, 166.4])
    r_nl = literal(spark, "r_nl", [468.4, 756.6, 151.2])
    scalars = jobs.fao56_scalars(t, rh, precision=precision)
    s = scalars.first()
    rel = 1e-9 if precision == "double" else 1e-4
    assert same(s.t_min, -262.05, rel) and same(s.t_max, 28.05, rel)
    assert same(s.pressure, 101.18184945982543, rel) and same(s.gamma, 0.06728592989078391, rel)
    assert same(s.e_max, 3.7909487948394647, rel)
    if precision == "double":
        # Differences of nearly equal numbers stand in the exponent, so few digits agree.
        assert same(s.e_min, 1.5768964047830952e79, 1e-6)
        assert same(s.e_s, 7.884482023915476e78, 1e-6) and same(s.e_a, 1.4980515845439405e79, 1e-6)
    else:
        assert s.e_min == math.inf and s.e_s == math.inf and s.e_a == math.inf
    stack = raster.overlay([t, u, r_s, r_nl])
    found = jobs.fao56_reference_et(stack, scalars, precision=precision).orderBy("x").collect()
    for row, r_n, u_2 in zip(found, [-113.353, -481.941, -23.072], [419.8997335992838, 172.5523130412447, 573.3044991162292]):
        assert same(row.r_n, r_n, 1e-4 if precision == "float" else 1e-9)
        assert same(row.u_2, u_2, 1e-4)
    expected = [-4103.6918141134865, -3.899620854749813e79, -3.2092014500758845e79]
    for row, value in zip(found, expected if precision == "double" else [math.nan] * 3):
        assert same(row.et_o, value, 1e-6)


def test_fao56_scalars_from_one_stack_read_it_once(spark, plan):
    stack = spark.range(10).selectExpr("cast(id as int) x", "0 y", "280D + id t", "20D + id rh")
    scalars = jobs.fao56_scalars(stack, stack)
    assert plan(scalars).count("Range (0, 10") == 1
    assert scalars.first().rh_max == 29.0


def test_named_constants_stay_apart(spark):
    row = spark.range(1).select(
        et.kelvin_to_celsius(300.0).alias("a"), et.kelvin_to_celsius(300.0, et.KELVIN_OFFSET_RASTER).alias("b")
    ).first()
    assert round(row.b - row.a, 9) == 1.0
