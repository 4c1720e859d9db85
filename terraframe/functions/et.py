"""Evapotranspiration equations as column expressions.

Every function takes and returns columns (plain numbers are accepted too), so a
chain of them stays inside whole-stage code generation. Temperatures are kelvin
unless the name says celsius; radiation is W/m2; pressure is kPa; wind is m/s.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ieee import Number, as_column, divide, ln

# Fixed values of the published equations. The three kelvin offsets differ on
# purpose: each belongs to its own equation.
KELVIN_OFFSET = 273.15
KELVIN_OFFSET_SVP = 273.16
KELVIN_OFFSET_RASTER = 272.15
KELVIN_OFFSET_FAO = 273.0
SVP_SCALE = 0.611
SVP_SCALE_CELSIUS = 0.6108
MAGNUS_SLOPE = 17.27
MAGNUS_SHIFT = 237.3
SVP_SHIFT = 35.86
SLOPE_SCALE = 4098.0
VON_KARMAN = 0.41
AIR_SPECIFIC_HEAT = 1005.0
AIR_DENSITY = 1.225
WATER_DENSITY = 1000.0
PSYCHROMETRIC = 0.66
PSYCHROMETRIC_PER_KPA = 0.665e-3
SURFACE_EMISSIVITY = 0.98
GRASS_ALBEDO = 0.23
SECONDS_PER_HOUR = 3600.0
ROUGHNESS_RATIO = 0.1

Value = Column | Number


def kelvin_to_celsius(temperature: Value, offset: float = KELVIN_OFFSET) -> Column:
    return as_column(temperature) - F.lit(offset)


def pascal_to_kilopascal(pressure: Value) -> Column:
    return as_column(pressure) / F.lit(1000.0)


def svp_celsius(temperature: Value) -> Column:
    """Saturation vapour pressure at a temperature in celsius."""
    t = as_column(temperature)
    return F.lit(SVP_SCALE_CELSIUS) * F.exp(divide(F.lit(MAGNUS_SLOPE) * t, t + F.lit(MAGNUS_SHIFT)))


def svp(temperature: Value) -> Column:
    """Saturation vapour pressure at a temperature in kelvin."""
    t = as_column(temperature)
    return F.lit(SVP_SCALE) * F.exp(
        divide(F.lit(MAGNUS_SLOPE) * (t - F.lit(KELVIN_OFFSET_SVP)), t - F.lit(SVP_SHIFT))
    )


def svp_slope(temperature: Value) -> Column:
    """Slope of the saturation vapour pressure curve at a temperature in kelvin."""
    c = kelvin_to_celsius(temperature)
    return divide(F.lit(SLOPE_SCALE) * svp_celsius(c), F.pow(c + F.lit(MAGNUS_SHIFT), F.lit(2.0)))


def mean_svp(at_min: Value, at_max: Value) -> Column:
    return (as_column(at_max) + as_column(at_min)) / F.lit(2.0)


def actual_vapour_pressure(
    at_min: Value, at_max: Value, rh_min: Value, rh_max: Value, rh_divisor: float = 2.0
) -> Column:
    """Actual vapour pressure from humidity extremes.

    ``rh_divisor`` is 2 as in the original workload; pass 100 for humidity in percent.
    """
    low = as_column(at_min) * as_column(rh_max) / F.lit(rh_divisor)
    high = as_column(at_max) * as_column(rh_min) / F.lit(rh_divisor)
    return (low + high) / F.lit(2.0)


def pressure_from_elevation(elevation: Value) -> Column:
    """Atmospheric pressure in kPa at an elevation in metres."""
    ratio = (F.lit(293.0) - F.lit(0.0065) * as_column(elevation)) / F.lit(293.0)
    return F.lit(101.3) * F.pow(ratio, F.lit(5.26))


def psychrometric_constant(pressure: Value) -> Column:
    return F.lit(PSYCHROMETRIC_PER_KPA) * as_column(pressure)


def net_shortwave(solar: Value, albedo: float = GRASS_ALBEDO) -> Column:
    return F.lit(1.0 - albedo) * as_column(solar)


def net_radiation_simple(net_short: Value, net_long: Value) -> Column:
    return as_column(net_short) - as_column(net_long)


def net_radiation(
    short_down: Value, long_down: Value, long_up: Value, albedo: Value,
    emissivity: float = SURFACE_EMISSIVITY,
) -> Column:
    absorbed = (F.lit(1.0) - as_column(albedo)) * as_column(short_down)
    reflected = F.lit(1.0 - emissivity) * as_column(long_down)
    return absorbed + as_column(long_down) - as_column(long_up) - reflected


def wind_at_2m(wind: Value, height: float = 10.0) -> Column:
    return divide(as_column(wind) * F.lit(4.87), ln(67.8 * height - 5.42))


def reference_et(
    slope: Value, wind: Value, temperature: Value, radiation: Value, gamma: Value,
    mean_pressure: Value, actual_pressure: Value, soil_heat: Value = 0.0,
) -> Column:
    """FAO-56 reference evapotranspiration; 273 is added to whatever temperature is given."""
    slope, gamma, wind = as_column(slope), as_column(gamma), as_column(wind)
    energy = F.lit(0.408) * slope * (as_column(radiation) - as_column(soil_heat))
    deficit = as_column(mean_pressure) - as_column(actual_pressure)
    vapour = divide(
        gamma * F.lit(900.0) * wind * deficit, as_column(temperature) + F.lit(KELVIN_OFFSET_FAO)
    )
    return divide(energy + vapour, slope + gamma * (F.lit(1.0) + F.lit(0.34) * wind))


def aerodynamic_resistance(
    wind: Value, roughness: float = 0.005, displacement: float = 0.0, height: float = 10.0
) -> Column:
    """Resistance to heat transport; all but the wind is constant and folds into one literal."""
    momentum = ln((height - displacement) / roughness)
    heat = ln((height - displacement) / (ROUGHNESS_RATIO * roughness))
    return divide(momentum * heat, F.lit(math.pow(VON_KARMAN, 2)) * as_column(wind))


def sensible_heat_flux(surface: Value, air: Value, resistance: Value) -> Column:
    warmth = F.lit(AIR_SPECIFIC_HEAT * AIR_DENSITY) * (as_column(surface) - as_column(air))
    return divide(warmth, resistance)


def latent_heat_of_vaporization(temperature: Value) -> Column:
    return (F.lit(2.501) - F.lit(0.00236) * kelvin_to_celsius(temperature)) * F.lit(1e6)


def instantaneous_et(
    surface: Value, radiation: Value, sensible: Value, soil_heat: Value = 0.0
) -> Column:
    energy = as_column(radiation) - as_column(soil_heat) - as_column(sensible)
    return divide(
        F.lit(SECONDS_PER_HOUR) * energy,
        latent_heat_of_vaporization(surface) * F.lit(WATER_DENSITY),
    )


def bulk_surface_resistance(
    surface_svp: Value, air_pressure: Value, instant_et: Value, resistance: Value
) -> Column:
    gradient = (as_column(surface_svp) - as_column(air_pressure)) * F.lit(AIR_SPECIFIC_HEAT * AIR_DENSITY)
    return divide(gradient, as_column(instant_et) * F.lit(PSYCHROMETRIC)) - as_column(resistance)


def latent_heat_flux(
    slope: Value, radiation: Value, air_svp: Value, air_pressure: Value,
    resistance: Value, surface_resistance: Value, soil_heat: Value = 0.0,
) -> Column:
    """Penman-Monteith latent heat flux."""
    slope = as_column(slope)
    energy = slope * (as_column(radiation) - as_column(soil_heat))
    gradient = F.lit(AIR_SPECIFIC_HEAT * AIR_DENSITY) * (as_column(air_svp) - as_column(air_pressure))
    ratio = divide(surface_resistance, resistance)
    return divide(
        energy + divide(gradient, resistance),
        slope + F.lit(PSYCHROMETRIC) * (F.lit(1.0) + ratio),
    )
