"""Column expressions shared by the operators. All of them stay inside the JVM."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlens import schema as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_name(c="magnitude_name") -> Column:
    return F.upper(F.trim(col(c)))


def starts_with_any(name: Column, prefixes) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | name.startswith(p)
    return out


def is_pollutant(c="magnitude_name") -> Column:
    return upper_name(c).isin(S.POLLUTANTS)


def is_traffic(c="magnitude_name") -> Column:
    return starts_with_any(upper_name(c), S.TRAFFIC_PREFIXES)


def variable_type(c="magnitude_name") -> Column:
    """pollutant, weather, traffic or unknown, from the name alone."""
    name = upper_name(c)
    return (
        F.when(name.isin(S.POLLUTANTS), "pollutant")
        .when(name.isin(S.WEATHER), "weather")
        .when(starts_with_any(name, S.TRAFFIC_PREFIXES), "traffic")
        .otherwise("unknown")
    )


def ratio(num, den) -> Column:
    """num / den as double; null when den is 0 or null."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def mean_flag(c) -> Column:
    """Mean of a three-valued flag over its known rows."""
    return F.avg(col(c).cast("int"))


def count_true(cond) -> Column:
    return F.count_if(F.coalesce(col(cond), F.lit(False)))


def null_if_nan(c) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def pearson(a, b) -> Column:
    """Pearson correlation over rows where both sides are known; null for constant sides."""
    a, b = col(a), col(b)
    x = F.when(b.isNotNull(), a)
    y = F.when(a.isNotNull(), b)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    # greatest and least skip nulls, so a null must not reach them.
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


# Rational approximation of the normal CDF (Hart 1968, West 2005), highest power first.
_HART_P = [
    3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
_HART_Q = [
    8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]
_HART_SWITCH = 7.07106781186547
_HART_ROOT_2PI = 2.506628274631


def _horner(coefficients, x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_cdf(x) -> Column:
    """Standard normal distribution function in double precision."""
    x = col(x)
    a = F.abs(x)
    e = F.exp(-a * a / 2)
    fraction = a + F.lit(0.65)
    for k in (4, 3, 2, 1):
        fraction = a + F.lit(float(k)) / fraction
    lower = (
        F.when(a > 37, F.lit(0.0))
        .when(a < _HART_SWITCH, e * _horner(_HART_P, a) / _horner(_HART_Q, a))
        .otherwise(e / fraction / F.lit(_HART_ROOT_2PI))
    )
    return F.when(x > 0, 1 - lower).otherwise(lower)


# WGS84 ellipsoid and UTM zone 30N.
_WGS84_A = 6378137.0
_WGS84_F = 1 / 298.257223563
_UTM_K0 = 0.9996
_UTM_E0 = 500000.0
_UTM_ZONE30_LON = -3.0


def utm30_to_lonlat(x, y):
    """(lon, lat) in degrees from UTM 30N metres, by the inverse Krüger series."""
    n = _WGS84_F / (2 - _WGS84_F)
    big_a = _WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    xi = col(y) / (_UTM_K0 * big_a)
    eta = (col(x) - _UTM_E0) / (_UTM_K0 * big_a)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, start=1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.atan2(F.sinh(eta1), F.cos(xi1))
    return lon * (180 / math.pi) + _UTM_ZONE30_LON, lat * (180 / math.pi)
