"""Boxes as Column expressions: x, y, w, h in pixels from the top left, or YOLO centres in fractions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def clamp(x: Column, low, high) -> Column:
    low, high = (v if isinstance(v, Column) else F.lit(v) for v in (low, high))
    return F.greatest(low, F.least(x, high))


def clip_keeping_size(box: Box, width, height) -> Box:
    """Moves a box into the page, then cuts what still stands out."""
    x, y, w, h = box
    w, h = F.greatest(F.lit(0), w), F.greatest(F.lit(0), h)
    x, y = F.greatest(F.lit(0), F.least(x, F.lit(width) - w)), F.greatest(F.lit(0), F.least(y, F.lit(height) - h))
    return x, y, F.least(w, F.lit(width) - x), F.least(h, F.lit(height) - y)


def clamp_origin(box: Box, width, height, least: int = 1) -> Box:
    """Clamps the corner into the page, then shrinks the size to fit, not below `least`."""
    x, y, w, h = box
    x, y = clamp(x, 0, F.lit(width) - 1), clamp(y, 0, F.lit(height) - 1)
    return x, y, clamp(w, least, F.lit(width) - x), clamp(h, least, F.lit(height) - y)


def to_yolo(box: Box, width, height) -> Box:
    x, y, w, h = box
    return (x + w / 2) / width, (y + h / 2) / height, w / F.lit(width), h / F.lit(height)


def from_yolo(box: Box, width, height) -> Box:
    xc, yc, w, h = box
    return (xc - w / 2) * width, (yc - h / 2) * height, w * width, h * height


def repair_yolo(box: Box) -> Box:
    """x, y into [0, 1]; w, h into [.001, 1] and then to the border. A box survives where w and h stay over .001."""
    x, y, w, h = box
    x, y = clamp(x, 0.0, 1.0), clamp(y, 0.0, 1.0)
    w, h = clamp(w, 0.001, 1.0), clamp(h, 0.001, 1.0)
    return x, y, F.least(w, 1 - x), F.least(h, 1 - y)


def intersection(a: Box, b: Box) -> Column:
    iw = F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0])
    ih = F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1])
    return F.when((iw > 0) & (ih > 0), iw * ih).otherwise(F.lit(0))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 when disjoint, touching or of no area."""
    i = intersection(a, b)
    u = a[2] * a[3] + b[2] * b[3] - i
    return F.when((i > 0) & (u > 0), i / u).otherwise(F.lit(0.0))


def quad_to_box(quad: Column) -> Box:
    """Smallest upright box of four [x, y] points."""
    xs, ys = F.transform(quad, lambda p: p[0]), F.transform(quad, lambda p: p[1])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys)
