"""Column functions on scores, labels, vectors and pixels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_label(label: Column) -> Column:
    return F.trim(F.lower(label))


def platt(score: Column, a: float, b: float) -> Column:
    z = F.least(F.greatest(score * a + b, F.lit(-15.0)), F.lit(15.0))
    return F.bround(1 / (1 + F.exp(-z)), 4)


def length_normalised(log_likelihood: Column, length: Column, power: float = 0.6) -> Column:
    return F.when(length > 0, F.exp(log_likelihood / F.pow(length.cast("double"), F.lit(power)))).otherwise(F.exp(log_likelihood))


def severity(change: Column) -> Column:
    return F.when(change >= 0.70, 3).when(change >= 0.50, 2).when(change >= 0.30, 1).otherwise(0)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-12))


def unit(a: Column) -> Column:
    n = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(a, lambda x: x.cast("double") / n)


def similarity(a: Column, b: Column, metric: str = "cosine") -> Column:
    """Similarity in [0, 1]: (cos + 1) / 2, or 1 / (1 + distance)."""
    if metric == "cosine":
        return (cosine(a, b) + 1) / 2
    if metric not in ("euclidean", "manhattan"):
        raise ValueError(f"unknown metric {metric}")
    p = 2 if metric == "euclidean" else 1
    powers = F.zip_with(a, b, lambda x, y: F.pow(F.abs(x.cast("double") - y.cast("double")), F.lit(float(p))))
    total = F.aggregate(powers, F.lit(0.0), lambda s, x: s + x)
    return 1 / (1 + (F.sqrt(total) if p == 2 else total))


def stretched(value: Column, low: Column, high: Column) -> Column:
    """Value between two percentiles as 0 to 255, truncated; 0 where they are equal."""
    share = (value - low) / (high - low)
    return F.when(high == low, 0).otherwise((F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * 255).cast("int"))


def decibel(dn: Column, factor: float = 1.0) -> Column:
    """Calibrated backscatter, clipped to -30 to 5 dB."""
    return F.least(F.greatest(10 * F.log10(dn * dn * factor + 1e-10), F.lit(-30.0)), F.lit(5.0))


def entropy_bin(value: Column) -> Column:
    """Number of the bin of 256 over 0 to 255, the last closed; null outside."""
    return F.when((value >= 0) & (value <= 255), F.least(F.floor(value * 256 / 255), F.lit(255)).cast("int"))


def utm_zone(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone of a point, by longitude alone and the hemisphere."""
    return F.when(lat >= 0, 32600).otherwise(32700) + ((lon + 180) / 6).cast("int") + 1


def rounded(x: Column, digits: int) -> Column:
    """A double to so many digits by its exact binary value, ties to even: 136.575, which is stored a little below, gives 136.57."""
    scale = 10.0**digits
    p = x * scale
    high = x * 134217729.0 - (x * 134217729.0 - x)
    lost = (high * scale - p) + (x - high) * scale
    tie = p - F.floor(p) == 0.5
    return F.when(tie & (lost > 0), F.ceil(p)).when(tie & (lost < 0), F.floor(p)).otherwise(F.rint(p)) / scale
