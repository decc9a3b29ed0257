"""Colour arithmetic as column expressions (sRGB, D65)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: sRGB to XYZ by rows, the D65 white, and the CIE constants.
TO_XYZ = [[0.4124564, 0.3575761, 0.1804375], [0.2126729, 0.7151522, 0.0721750], [0.0193339, 0.1191920, 0.9503041]]
WHITE = [0.95047, 1.0, 1.08883]
EPS, KAPPA = 216 / 24389, 24389 / 27


def hex_channels(hx: Column) -> list[Column]:
    bare = F.ltrim(hx, F.lit("#"))
    return [F.conv(F.substring(bare, i, 2), 16, 10).cast("double") for i in (1, 3, 5)]


def _linear(c: Column) -> Column:
    x = c / 255
    return F.when(x > 0.04045, F.pow((x + 0.055) / 1.055, F.lit(2.4))).otherwise(x / 12.92)


def rgb_lab(r: Column, g: Column, b: Column) -> list[Column]:
    rgb = [_linear(r), _linear(g), _linear(b)]
    f = []
    for row, white in zip(TO_XYZ, WHITE, strict=True):
        v = (rgb[0] * row[0] + rgb[1] * row[1] + rgb[2] * row[2]) / white
        f.append(F.when(v > EPS, F.cbrt(v)).otherwise((KAPPA * v + 16) / 116))
    return [116 * f[1] - 16, 500 * (f[0] - f[1]), 200 * (f[1] - f[2])]


def delta_e(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(F.pow(a[0] - b[0], F.lit(2.0)) + F.pow(a[1] - b[1], F.lit(2.0)) + F.pow(a[2] - b[2], F.lit(2.0)))


def chroma(a: Column, b: Column) -> Column:
    return F.sqrt(a * a + b * b)


def hue(a: Column, b: Column) -> Column:
    h = F.degrees(F.atan2(b, a))
    return F.when(h < 0, h + 360).otherwise(h)


def hue_distance(x: Column, y: Column) -> Column:
    d = F.abs(x - y)
    return F.least(d, 360 - d)


def family(lightness: Column, a: Column, b: Column) -> Column:
    """Colour family by an ordered cascade over lightness and chroma."""
    c = chroma(a, b)
    return (
        F.when((c < 12) & (lightness > 85), "white_on_white")
        .when(c < 12, "neutral")
        .when((lightness > 70) & (c <= 55), "pastel")
        .when((lightness > 25) & (lightness < 65) & (a > 0) & (b > 10) & (c <= 55), "earth")
        .when((lightness <= 45) & (c >= 20), "jewel")
        .when(c > 55, "bright")
        .otherwise("jewel")
    )


def is_skin(lightness: Column, a: Column, b: Column) -> Column:
    """A broad box of skin tones."""
    return lightness.between(20, 90) & a.between(5, 30) & b.between(8, 40)
