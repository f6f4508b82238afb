"""Lines of page images: gradient edges, votes for (angle, offset), and peaks among the votes.

A line of direction d (degrees; level is 0, falling to the right above it) and offset o holds the points with
o = y cos d - x sin d. Every edge point votes once for each direction. A tile sums its own votes, tiles' sums are added
up by an aggregate, and a cell that none nearby outdoes is a line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Directions in half a turn.
STEPS = 720


def edge_points(pixels: np.ndarray, least: float = 60.0) -> tuple[np.ndarray, np.ndarray]:
    """Places of a tile, without its border of two, whose gradient is at least `least` and larger than that of one of the
    two neighbours along it, and not smaller than the other's: ridges of the gradient, one pixel wide."""
    p = pixels.astype(float)
    dy, dx = np.zeros_like(p), np.zeros_like(p)
    dy[1:-1, 1:-1] = (p[2:, 1:-1] - p[:-2, 1:-1]) / 2 + (p[2:, 2:] + p[2:, :-2] - p[:-2, 2:] - p[:-2, :-2]) / 4
    dx[1:-1, 1:-1] = (p[1:-1, 2:] - p[1:-1, :-2]) / 2 + (p[2:, 2:] + p[:-2, 2:] - p[2:, :-2] - p[:-2, :-2]) / 4
    size = np.hypot(dx, dy)
    inner = (slice(2, -2), slice(2, -2))
    steep = np.abs(dy) >= np.abs(dx)
    up, down, left, right = size[1:-3, 2:-2], size[3:-1, 2:-2], size[2:-2, 1:-3], size[2:-2, 3:-1]
    s = size[inner]
    ridge = np.where(steep[inner], (s > up) & (s >= down), (s > left) & (s >= right))
    return np.nonzero(ridge & (s >= least))


def votes_of(x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(step, offset, votes): for each direction, how many points have each offset (whole pixels)."""
    out: list[list[np.ndarray]] = [[], [], []]
    for k in range(steps):
        d = np.radians(k * 180 / steps - 90)
        o = np.rint(y * np.cos(d) - x * np.sin(d)).astype(np.int64)
        low = o.min()
        n = np.bincount(o - low)
        at = np.flatnonzero(n)
        for c, v in zip(out, (np.full(len(at), k), at + low, n[at]), strict=True):
            c.append(v)
    return tuple(np.concatenate(c) for c in out)


def hough(tiles: DataFrame, steps: int = STEPS, least: float = 60.0) -> DataFrame:
    """(page, step, offset, votes) of tiles (page, x, y, width, height, pixels with a border of two)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for t in b.itertuples():
                y, x = edge_points(np.frombuffer(t.pixels, np.uint8).reshape(t.height + 4, t.width + 4), least)
                if len(x):
                    k, o, n = votes_of(x + t.x, y + t.y, steps)
                    yield pd.DataFrame({"page": t.page, "step": k, "offset": o, "votes": n})

    kind = tiles.schema["page"].dataType.simpleString()
    return tiles.mapInPandas(run, f"page {kind}, step long, offset long, votes long").groupBy("page", "step", "offset").agg(F.sum("votes").alias("votes"))


def peaks(votes: DataFrame, least: int = 50, share: float = 0.3, near: tuple[int, int] = (12, 6), steps: int = STEPS) -> DataFrame:
    """(page, angle, offset, votes) of cells with at least `least` votes and `share` of the page's most, that no cell within
    `near` steps and pixels outdoes; of equals the one of smallest offset and step stays. Directions go round: a half turn
    on, the same line has the opposite offset."""
    top = votes.groupBy("page").agg(F.max("votes").alias("top"))
    strong = votes.where(F.col("votes") >= least).join(top, "page").where(F.col("votes") >= share * F.col("top")).drop("top")
    turned = strong.where((F.col("step") < near[0]) | (F.col("step") >= steps - near[0]))
    turned = turned.select("page", F.when(F.col("step") < near[0], F.col("step") + steps).otherwise(F.col("step") - steps).alias("step"), (-F.col("offset")).alias("offset"), "votes", F.col("step").alias("s0"), F.col("offset").alias("o0"))
    others = strong.withColumns({"s0": F.col("step"), "o0": F.col("offset")}).unionByName(turned)
    cell = lambda c, n: F.floor(F.col(c) / n)
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    asked = strong.select("page", "step", "offset", "votes", around.alias("g")).select("page", "step", "offset", "votes", (cell("step", near[0]) + F.col("g.i")).alias("cs"), (cell("offset", near[1]) + F.col("g.j")).alias("co"))
    there = others.select("page", cell("step", near[0]).alias("cs"), cell("offset", near[1]).alias("co"), F.col("step").alias("s1"), F.col("offset").alias("o1"), F.col("votes").alias("v1"), "s0", "o0")
    close = (F.abs(F.col("s1") - F.col("step")) <= near[0]) & (F.abs(F.col("o1") - F.col("offset")) <= near[1])
    first = F.struct(-F.col("v1"), F.col("o0"), F.col("s0")) < F.struct(-F.col("votes"), F.col("offset"), F.col("step"))
    beaten = asked.join(there, ["page", "cs", "co"]).where(close & first).select("page", "step", "offset").distinct()
    return strong.join(beaten, ["page", "step", "offset"], "left_anti").select("page", (F.col("step") * 180 / steps - 90).alias("angle"), "offset", "votes")


def as_segments(lines: DataFrame, length: float = 1000.0) -> DataFrame:
    """page, angle, offset, votes with the two ends (x1, y1, x2, y2) of a piece of each line, as the audits of angles take."""
    d = F.radians("angle")
    x, y = -F.col("offset") * F.sin(d), F.col("offset") * F.cos(d)
    return lines.select("*", x.alias("x1"), y.alias("y1"), (x + length * F.cos(d)).alias("x2"), (y + length * F.sin(d)).alias("y2"))
