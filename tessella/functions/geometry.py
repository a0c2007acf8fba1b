"""Column builders for boxes, points and paths. Boxes are structs (y1, x1, y2, x2), points (x, y)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(y1, x1, y2, x2) -> Column:
    return F.struct(*(F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for c, n in zip((y1, x1, y2, x2), ("y1", "x1", "y2", "x2"), strict=True)))


def area(b: Column) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def common_area(a: Column, b: Column) -> Column:
    """Area that two boxes share, 0 if they only touch or are apart."""
    wide = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    high = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.when((wide > 0) & (high > 0), wide * high).otherwise(F.lit(0))


def overlap_of_smaller(a: Column, b: Column) -> Column:
    """Shared area as a part of the smaller box; 0 if either has no area."""
    least = F.least(area(a), area(b))
    return F.when(least > 0, common_area(a, b).cast("double") / least).otherwise(F.lit(0.0))


def overlap_of_first(a: Column, b: Column) -> Column:
    """Shared area as a part of the first box (not symmetric)."""
    return F.when(area(a) > 0, common_area(a, b).cast("double") / area(a)).otherwise(F.lit(0.0))


def rectangles_meet(a: Column, b: Column, tolerance: float = 0.05) -> Column:
    """Whether both extents of what the boxes share exceed the tolerance."""
    wide = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    high = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return (wide > tolerance) & (high > tolerance)


def rectangle_overlap(a: Column, b: Column, tolerance: float = 0.05) -> Column:
    """Shared area rounded to 2 places where both extents exceed the tolerance, else null.

    Hundredths are rounded, as SQL engines do on doubles: 0.1 x 1.15 comes out as 0.11499999999999999 and is 0.12.
    Spark's own rounding goes through a decimal for every value; a positive value less its floor is exact.
    """
    wide = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    high = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    cents = wide * high * 100
    return F.when(rectangles_meet(a, b, tolerance), (F.floor(cents) + F.when(cents - F.floor(cents) >= 0.5, 1).otherwise(0)) / 100)


def centre_distance(a: Column, b: Column) -> Column:
    """Distance of the box centres, rounded to 2 places."""
    dx = (a["x1"] + a["x2"] - b["x1"] - b["x2"]) / 2.0
    dy = (a["y1"] + a["y2"] - b["y1"] - b["y2"]) / 2.0
    return F.round(F.sqrt(dx * dx + dy * dy), 2)


def to_global(local: Column, low: Column, high: Column, scale: float = 1000.0) -> Column:
    """A 0..scale coordinate of a tile in the page's grid, cut toward zero."""
    return (low + local / F.lit(scale) * (high - low)).cast("int")


def to_grid(pixel: Column, size: Column, scale: int = 1000) -> Column:
    """Pixels to 0..scale, cut toward zero."""
    return (pixel / size * F.lit(scale)).cast("int")


def from_grid(place: Column, size: Column, scale: int = 1000) -> Column:
    return (place / F.lit(scale) * size).cast("int")


def grid_size(width: Column, height: Column, most: Column) -> Column:
    """(rows, cols) of tiles no larger than `most`."""
    return F.struct(F.ceil(height / most).cast("int").alias("rows"), F.ceil(width / most).cast("int").alias("cols"))


def path_to_global(path: Column, low_x: Column, high_x: Column, low_y: Column, high_y: Column) -> Column:
    return F.transform(path, lambda p: F.struct(to_global(p["x"], low_x, high_x).alias("x"), to_global(p["y"], low_y, high_y).alias("y")))


def path_similarity(a: Column, b: Column, tolerance: float = 50.0) -> Column:
    """From the mean, over the first path's points, of the distance to the second path's nearest point.

    Up to the tolerance it falls from 1 to 0.5, then in a straight line to 0 at five tolerances. An empty path gives 0.
    """
    nearest = F.transform(a, lambda p: F.array_min(F.transform(b, lambda q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])))))
    mean = F.aggregate(nearest, F.lit(0.0), lambda s, d: s + d) / F.size(a)
    near, far = F.lit(tolerance), F.lit(5 * tolerance)
    return F.when((F.size(a) < 1) | (F.size(b) < 1), F.lit(0.0)).when(mean <= near, 1 - mean / (2 * near)).when(mean <= far, F.greatest(F.lit(0.0), 0.5 * (far - mean) / (far - near))).otherwise(F.lit(0.0))


def segment_angle(p: Column, q: Column) -> Column:
    """Degrees of the segment's slope, from 0 to 90."""
    return F.degrees(F.atan2(F.abs(q["y"] - p["y"]).cast("double"), F.abs(q["x"] - p["x"]).cast("double")))


def skewed_segments(path: Column, tolerance: float = 5.0) -> Column:
    """(position, angle) of segments that are neither level nor upright within the tolerance; angles rounded to 1 place."""
    pairs = F.zip_with(F.slice(path, 1, F.greatest(F.size(path) - 1, F.lit(0))), F.slice(path, 2, F.greatest(F.size(path) - 1, F.lit(0))), lambda p, q: segment_angle(p, q))
    angles = F.transform(pairs, lambda a, i: F.struct(i.alias("pos"), a.alias("angle")))
    return F.transform(F.filter(angles, lambda s: (s["angle"] > tolerance) & (s["angle"] < 90 - tolerance)), lambda s: F.struct(s["pos"].alias("pos"), F.round(s["angle"], 1).alias("angle")))


def orientation(dx: Column, dy: Column, tolerance: float = 15.0) -> Column:
    """horizontal, vertical, diagonal or point."""
    angle = F.degrees(F.atan2(F.abs(dy).cast("double"), F.abs(dx).cast("double")))
    return F.when((dx == 0) & (dy == 0), "point").when(angle <= tolerance, "horizontal").when(angle >= 90 - tolerance, "vertical").otherwise("diagonal")


def near_boundary(p: Column, threshold: int = 20, size: int = 1000) -> Column:
    low, high = F.lit(threshold), F.lit(size - threshold)
    return (p["x"] <= low) | (p["x"] >= high) | (p["y"] <= low) | (p["y"] >= high)


def emu_to_inches(emu: Column) -> Column:
    return emu / F.lit(914400.0)


def inches_to_pixels(inches: Column, dpi: int = 96) -> Column:
    return (inches * F.lit(dpi)).cast("int")


def pixels_to_inches(px: Column) -> Column:
    return px / F.lit(96.0)


def pixels_to_points(px: Column) -> Column:
    return px * F.lit(0.75)
