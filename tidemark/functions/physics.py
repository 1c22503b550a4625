"""Published formulas for weather, evaporation and cosmic-ray soil moisture, as Column expressions.

Arguments are columns or numbers. A missing input gives a missing result. Site constants are always arguments.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import as_column

Number = Column | float | int

# Physical constants and published coefficients.
KELVIN_OFFSET = 273.15
LAPSE_RATE = 0.0065  # K per m
PRESSURE_EXPONENT = 5.257
STANDARD_PRESSURE = 1013.25  # hPa
SECONDS_PER_HALF_HOUR = 1800
GAS_CONSTANT_VAPOUR = 461.5  # J per kg and K
NEUTRON_A0, NEUTRON_A1, NEUTRON_A2 = 0.0808, 0.372, 0.115  # Desilets et al. 2010
HUMIDITY_FACTOR = 0.0054  # Rosolem et al. 2013
SNOW_ATTENUATION = 48.0  # mm, Desilets 2017
WATER_COUNT_FRACTION = 0.24  # of N0, Desilets 2017
BURIED_MAX, BURIED_MIN = 1144.0, 141.0  # mm, Howat et al. 2018
BURIED_A1, BURIED_A2, BURIED_A3 = 0.313, 0.082, 1.117  # Howat et al. 2018


def pressure_ratio(ta: Column, altitude: Number) -> Column:
    """Pressure at the altitude (m) over pressure at sea level, for air temperature in degrees Celsius."""
    drop = as_column(altitude) * LAPSE_RATE
    return F.pow(1 - F.try_divide(drop, ta + drop + KELVIN_OFFSET), F.lit(PRESSURE_EXPONENT))


def sea_level_pressure(pa: Column, ta: Column, altitude: Number) -> Column:
    return F.try_divide(pa, pressure_ratio(ta, altitude))


def net_radiation(swin: Column, swout: Column, lwin: Column, lwout: Column) -> Column:
    """Downward minus upward, short and long wave."""
    return (swin - swout) + (lwin - lwout)


def mean_of_two(first: Column, second: Column) -> Column:
    return (first + second) / 2


def saturation_vapour_pressure(ta: Column) -> Column:
    """kPa, Allen et al. 1998 (FAO-56) eq. 11."""
    return F.exp(F.try_divide(ta * 17.27, ta + 237.3)) * 0.6108


def penman_monteith_30min(
    rn: Column, g: Column, ta: Column, rh: Column, ws: Column, pa: Column, wind_height: Number
) -> Column:
    """Reference evapotranspiration in mm per half hour, FAO-56 eq. 53 with a step of 30 minutes.

    rn and g in W m-2, ta in degrees Celsius, rh in %, ws in m s-1 at wind_height (m), pa in hPa.
    """
    ws_2m = F.try_divide(ws * 4.87, F.log(as_column(wind_height) * 67.8 - 5.42))
    saturated = saturation_vapour_pressure(ta)
    slope = F.try_divide(saturated * 4098.0, F.pow(ta + 237.3, F.lit(2.0)))
    gamma = pa / 10 * 0.000665
    available = (rn - g) * (SECONDS_PER_HALF_HOUR / 1e6)
    deficit = saturated * (1 - rh / 100)
    wind_term = F.try_divide(gamma * 18.5, ta + 273.0) * ws_2m * deficit
    return F.try_divide(slope * available * 0.408 + wind_term, slope + gamma * (1 + ws_2m * 0.34))


def latent_heat_to_water(le: Column, ta: Column) -> Column:
    """Evapotranspiration in mm per half hour from latent heat flux (W m-2)."""
    heat_of_vaporisation = 2.501 - ta * 0.002361
    return F.try_divide(le * SECONDS_PER_HALF_HOUR, heat_of_vaporisation * 1e6)


def latent_heat_flux(rn: Column, g: Column, h: Column) -> Column:
    """What is left of net radiation after soil and sensible heat."""
    return rn - g - h


def absolute_humidity(ta: Column, rh: Column) -> Column:
    """Water vapour density in g m-3."""
    vapour_pressure = saturation_vapour_pressure(ta) * rh * 10.0  # Pa
    return F.try_divide(vapour_pressure * 1000, (ta + KELVIN_OFFSET) * GAS_CONSTANT_VAPOUR)


def solar_zenith(time: Column, latitude: Number) -> Column:
    """Angle of the sun from the vertical, in radians, with noon at 12:00 (FAO-56 eq. 24)."""
    day = F.dayofyear(time)
    hour = F.hour(time) + F.minute(time) / 60 + F.second(time) / 3600
    declination = F.sin(day * (2 * math.pi / 365) - 1.39) * 0.409
    hour_angle = (hour - 12) * (math.pi / 12)
    phi = F.radians(as_column(latitude))
    return F.acos(F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.cos(hour_angle))


def albedo(swin: Column, swout: Column, zenith: Column) -> Column:
    """Reflected over incoming shortwave; null with the sun below the horizon."""
    return F.when(zenith < math.pi / 2, F.try_divide(swout, swin))


def neutron_intensity_factor(count: Column, ref_c0: Number, gamma: Number) -> Column:
    """Multiplier for the incoming intensity, Hawdon et al. 2014: 1 / (1 + gamma (I / I0 - 1))."""
    return F.try_divide(F.lit(1.0), 1 + as_column(gamma) * (F.try_divide(count, as_column(ref_c0)) - 1))


def humidity_factor(q: Column, ref_q0: Number) -> Column:
    return 1 + (q - as_column(ref_q0)) * HUMIDITY_FACTOR


def pressure_factor(pa: Column, attenuation_length: Number, ref_pressure: Number = STANDARD_PRESSURE) -> Column:
    """exp((P - P0) / L), Desilets and Zreda 2003."""
    return F.exp(F.try_divide(pa - as_column(ref_pressure), as_column(attenuation_length)))


def snow_day(albedo_value: Column, low: Number, high: Number) -> Column:
    """Is the albedo that of a snow cover: from the lower to the upper threshold."""
    return albedo_value.between(as_column(low), as_column(high))


def corrected_counts(count: Column, *factors: Column) -> Column:
    for factor in factors:
        count = count * factor
    return count


def water_content(
    count: Column,
    ref_soc: Number,
    ref_bulkdensity: Number,
    ref_latticewater: Number,
    n0: Number,
    n_min: Number,
    n_max: Number,
) -> Column:
    """Volumetric water content in %, Desilets et al. 2010; null for counts outside [n_min, n_max]."""
    total = F.try_divide(F.lit(NEUTRON_A0), F.try_divide(count, as_column(n0)) - NEUTRON_A1) - NEUTRON_A2
    content = (total - as_column(ref_latticewater) - as_column(ref_soc)) * as_column(ref_bulkdensity) * 100
    return F.when(count.between(as_column(n_min), as_column(n_max)), content)


def snow_water(count: Column, snow_free_count: Column, n0: Number) -> Column:
    """Snow water equivalent (mm) above ground, Desilets 2017; null where the logarithm has no value."""
    floor_count = as_column(n0) * WATER_COUNT_FRACTION
    ratio = F.try_divide(count - floor_count, snow_free_count - floor_count)
    return F.when(ratio > 0, F.log(ratio) * -SNOW_ATTENUATION)


def snow_water_sigma(count: Column, snow_free_count: Column, n0: Number) -> Column:
    """Standard error of ``snow_water`` from Poisson counting errors of both counts."""
    floor_count = as_column(n0) * WATER_COUNT_FRACTION
    relative = F.try_divide(count, F.pow(count - floor_count, F.lit(2.0))) + F.try_divide(
        snow_free_count, F.pow(snow_free_count - floor_count, F.lit(2.0))
    )
    return F.sqrt(relative) * SNOW_ATTENUATION


def _buried_attenuation(ratio: Column) -> Column:
    rise = F.pow(1 + F.exp((BURIED_A1 - ratio) / BURIED_A2), F.lit(-BURIED_A3))
    return 1 / (1 / BURIED_MAX + rise * (1 / BURIED_MIN - 1 / BURIED_MAX))


def snow_water_buried(count: Column, snow_free_count: Column) -> Column:
    """Snow water equivalent (mm) for a sensor under the snow, Howat et al. 2018."""
    ratio = F.try_divide(count, snow_free_count)
    return F.when(ratio > 0, F.log(ratio) * -1 * _buried_attenuation(ratio))


def snow_water_buried_sigma(count: Column, snow_free_count: Column) -> Column:
    """Standard error of ``snow_water_buried`` from Poisson counting errors, at fixed attenuation."""
    ratio = F.try_divide(count, snow_free_count)
    spread = F.sqrt(F.try_divide(F.lit(1.0), count) + F.try_divide(F.lit(1.0), snow_free_count))
    return F.when(ratio > 0, spread * _buried_attenuation(ratio))


def soil_moisture_index(vwc: Column, wilting_point: Number, field_capacity: Number, saturation: Number) -> Column:
    """0 at the wilting point, 1 at field capacity; water beyond saturation does not count."""
    dry, full = as_column(wilting_point), as_column(saturation)
    held = F.when(vwc > full, full).otherwise(vwc)
    return F.try_divide(held - dry, as_column(field_capacity) - dry)


def _bound_water(ref_soc: Number, ref_bulkdensity: Number, ref_latticewater: Number) -> Column:
    return (as_column(ref_soc) + as_column(ref_latticewater)) * as_column(ref_bulkdensity)


def effective_depth(vwc: Column, ref_soc: Number, ref_bulkdensity: Number, ref_latticewater: Number) -> Column:
    """Depth in cm, Franz et al. 2012."""
    bound_water = _bound_water(ref_soc, ref_bulkdensity, ref_latticewater)
    return F.try_divide(F.lit(5.8), bound_water + vwc / 100 + 0.0829)


def penetration_depth(
    vwc: Column, pa: Column, ref_soc: Number, ref_bulkdensity: Number, ref_latticewater: Number, distance: Number
) -> Column:
    """Depth (cm) that 86% of the neutrons come from, at a distance (m) from the sensor, Koehli et al. 2015."""
    water = vwc / 100 + _bound_water(ref_soc, ref_bulkdensity, ref_latticewater)
    pressure_scale = F.try_divide(F.lit(0.5), 0.86 - F.exp(pa / -STANDARD_PRESSURE))
    scaled_distance = F.try_divide(as_column(distance), pressure_scale)
    reach = F.try_divide((F.exp(scaled_distance * -0.01) + 0.96655) * 0.14249 * (water + 20), water + 0.0429)
    return F.try_divide(reach + 8.321, as_column(ref_bulkdensity))
