"""Expected generation and demand curves (P19-P22) as Column expressions.

The reference draws each sample as ``curve(h) x uniform(lo, hi)``; here the draw becomes a band:
``expected`` is the curve at the midpoint factor 1, and [band_lo, band_hi] the curve times the two
ends of the noise range.  A reading outside the band is implausible (V14).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's): climate factors of the generation profiles,
# with the defaults used for a climate missing from a table.
CLIMATE_SOLAR = {
    "desert": 1.1, "arid": 1.05, "tropical": 0.95, "arctic": 0.5, "mountain": 0.7,
    "monsoon": 0.75, "coastal": 0.85, "island": 0.9, "urban": 0.7, "plains": 0.9,
    "highland": 0.85, "temperate": 0.85, "rainy": 0.55,
}
CLIMATE_WIND = {
    "coastal": 1.3, "island": 1.25, "arctic": 1.4, "plains": 1.2, "mountain": 1.1,
    "desert": 0.7, "arid": 0.75, "monsoon": 1.0, "urban": 0.5, "tropical": 0.6,
    "highland": 1.0, "temperate": 0.9, "rainy": 1.1,
}
SOLAR_DEFAULT = 0.85
WIND_DEFAULT = 1.0

# Noise range of each source (the band), from the generation profiles.
BANDS = {
    "solar": (0.80, 0.98),
    "wind": (0.70, 1.08),
    "hydro": (0.85, 1.0),
    "geothermal": (0.93, 1.0),
    "tidal": (0.85, 1.0),
    "demand": (0.90, 1.10),
}


def lookup(table: dict[str, float], key: Column, default: float) -> Column:
    """Map lookup with a default: coalesce(map[key], default)."""
    m = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, key), F.lit(default))


def solar_factor(climate: Column) -> Column:
    return lookup(CLIMATE_SOLAR, climate, SOLAR_DEFAULT)


def wind_factor(climate: Column) -> Column:
    return lookup(CLIMATE_WIND, climate, WIND_DEFAULT)


def solar_curve(h: Column, climate: Column, boost: Column | float = 1.0) -> Column:
    """Gaussian around 13 h (sd 3.5 h), zero before 5 h and after 20 h, times climate and boost."""
    b = boost if isinstance(boost, Column) else F.lit(boost)
    g = F.exp(F.lit(-0.5) * F.pow((h - F.lit(13)) / F.lit(3.5), F.lit(2)))
    return F.when((h < 5) | (h > 20), F.lit(0.0)).otherwise(g * solar_factor(climate) * b)


def wind_curve(h: Column, climate: Column, boost: Column | float = 1.0) -> Column:
    """0.22 + 0.18 sin(2 pi h / 24), x1.3 at night (before 6 h, after 20 h) else x0.85."""
    b = boost if isinstance(boost, Column) else F.lit(boost)
    night = F.when((h < 6) | (h > 20), F.lit(1.3)).otherwise(F.lit(0.85))
    base = F.lit(0.22) + F.lit(0.18) * F.sin(h / F.lit(24.0) * F.lit(2 * math.pi))
    return base * night * wind_factor(climate) * b


def hydro_curve(h: Column, seasonal_var: float = 0.2, boost: float = 1.0) -> Column:
    return (F.lit(0.55) + F.lit(seasonal_var) * F.sin((h - F.lit(8)) / F.lit(24.0) * F.lit(2 * math.pi))) * F.lit(boost)


def geothermal_curve(boost: float = 1.0) -> Column:
    return F.lit(0.9 * boost)


def tidal_curve(h: Column, boost: float = 1.0) -> Column:
    return (F.lit(0.4) + F.lit(0.3) * F.abs(F.sin(h / F.lit(12.42) * F.lit(2 * math.pi)))) * F.lit(boost)


def source_curve(source: Column, h: Column, climate: Column) -> Column:
    """Curve of the row's source type; unknown sources have no expectation (NULL)."""
    return (F.when(source == "solar", solar_curve(h, climate))
            .when(source == "wind", wind_curve(h, climate))
            .when(source == "hydro", hydro_curve(h))
            .when(source == "geothermal", geothermal_curve())
            .when(source == "tidal", tidal_curve(h)))


def band_factor(source: Column, end: int) -> Column:
    """Low (end=0) or high (end=1) noise factor of a source type."""
    expr = None
    for s, lohi in BANDS.items():
        expr = (F.when(source == s, F.lit(lohi[end])) if expr is None
                else expr.when(source == s, F.lit(lohi[end])))
    return expr


def demand_curve(h: Column, base: Column, peak_mult: Column,
                 night_boost: Column | None = None, evening_spike: Column | None = None,
                 morning_spike: Column | None = None, heating: Column | None = None) -> Column:
    """P20: base x (0.58 + morning bump + evening bump) x peak/1.4, then the trait multipliers.

    The evening spike applies from 18 h to 2 h (x0.8 after midnight); the reference's condition for
    it can never hold, the note beside it states this intent."""
    m = F.exp(F.lit(-0.5) * F.pow((h - F.lit(9)) / F.lit(2.0), F.lit(2))) * F.lit(0.3)
    e = F.exp(F.lit(-0.5) * F.pow((h - F.lit(20)) / F.lit(2.5), F.lit(2))) * F.lit(0.5)
    load = base * (F.lit(0.58) + m + e) * (peak_mult / F.lit(1.4))

    def mult(trait: Column | None, cond: Column, factor: Column | None = None) -> Column:
        if trait is None:
            return F.lit(1.0)
        f = factor if factor is not None else trait
        return F.when(trait.isNotNull() & (trait != 0) & cond, f).otherwise(F.lit(1.0))

    load = load * mult(night_boost, (h >= 22) | (h <= 5))
    if evening_spike is not None:
        load = load * mult(evening_spike, (h >= 18) | (h <= 2),
                           F.when(h >= 18, evening_spike).otherwise(evening_spike * F.lit(0.8)))
    load = load * mult(morning_spike, (h >= 7) & (h <= 10))
    load = load * mult(heating, (h <= 7) | (h >= 20))
    return load


# Fixed values (must equal the reference's): season and latitude factors of the grid widget.
# Season is meteorological for the southern hemisphere: Dec-Feb summer, Jun-Aug winter.
SOLAR_SEASON_EFF = {"summer": 1.0, "winter": 0.6, "other": 0.85}
SOLAR_SEASON_PEAK = {"summer": 13.5, "winter": 12.5, "other": 13.0}
SOLAR_SEASON_SPREAD = {"summer": 4.0, "winter": 3.0, "other": 3.5}
WIND_SEASON = {"summer": 0.8, "winter": 1.2, "other": 1.0}
HYDRO_SEASON = {"summer": 0.75, "winter": 1.15, "other": 0.95}
DEMAND_SEASON = {"summer": 0.9, "winter": 1.15, "other": 1.0}
WIND_LATITUDE = [(35.0, 1.25), (30.0, 1.0)]   # |lat| above 35 -> 1.25, above 30 -> 1.0, else 0.75
WIND_LATITUDE_LOW = 0.75


def southern_season(month: Column) -> Column:
    return (F.when(month.isin(12, 1, 2), F.lit("summer")).when(month.isin(6, 7, 8), F.lit("winter"))
            .otherwise(F.lit("other")))


def season_factor(table: dict[str, float], season: Column) -> Column:
    return lookup(table, season, table["other"])


def wind_latitude_factor(lat: Column) -> Column:
    (t1, f1), (t2, f2) = WIND_LATITUDE
    a = F.abs(lat)
    return F.when(a > t1, F.lit(f1)).when(a > t2, F.lit(f2)).otherwise(F.lit(WIND_LATITUDE_LOW))
