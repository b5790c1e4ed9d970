"""Geometry of layout boxes, arrays of STRUCT<x1, y1, x2, y2 INT>."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from vellumine.functions.text import Text, _c

BOX = "struct<x1:int,y1:int,x2:int,y2:int>"


def area(b: Column) -> Column:
    """Area of a box, 0 if it is inside out."""
    return F.greatest(b["x2"] - b["x1"], F.lit(0)).cast("bigint") * F.greatest(b["y2"] - b["y1"], F.lit(0))


def shared(a: Column, b: Column) -> Column:
    """Area that two boxes share."""
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(w, F.lit(0)).cast("bigint") * F.greatest(h, F.lit(0))


def size(b: Column) -> Column:
    """Width and height of a box, 0 where it is inside out."""
    return F.struct(F.greatest(b["x2"] - b["x1"], F.lit(0)).alias("width"), F.greatest(b["y2"] - b["y1"], F.lit(0)).alias("height"))


def inner(b: Column, share: float) -> Column:
    """The box without a margin of ``share`` of its width and height on each side, never empty."""
    mx, my = ((F.lit(share) * (b[f"{d}2"] - b[f"{d}1"])).cast("int") for d in "xy")
    x1, y1 = F.least(b["x2"] - 1, b["x1"] + mx), F.least(b["y2"] - 1, b["y1"] + my)
    return F.struct(x1.alias("x1"), y1.alias("y1"), F.greatest(x1 + 1, b["x2"] - mx).alias("x2"), F.greatest(y1 + 1, b["y2"] - my).alias("y2"))


def median_skew(angles: Text, most: float, least: int = 5) -> Column:
    """Median of the angles of at most ``most`` degrees; 0 for fewer than ``least`` of them.

    Angles of one page, from its line segments.
    """
    near = F.array_sort(F.filter(_c(angles), lambda a: F.abs(a) <= most))
    n = F.size(near)
    middle = (F.get(near, F.floor((n - 1) / 2).cast("int")) + F.get(near, F.floor(n / 2).cast("int"))) / 2
    return F.when(n >= least, middle).otherwise(0.0)


def title_and_columns(b: Column, ink: Column, title: float = 0.22, least: int = 60, valley: float = 0.75, margin: float = 0.1) -> Column:
    """A dominant box as a title band and what is below it, in two columns where the ink has a valley.

    ink: dark pixels of each column of the part below the title. The valley is the first
    least inked column between the margins; it must have less than ``valley`` of the most.
    """
    height, width = b["y2"] - b["y1"], b["x2"] - b["x1"]
    cut = b["y1"] + F.least(F.greatest(F.lit(least), (F.lit(title) * height).cast("int")), height - least)
    edge = F.greatest(F.lit(5), (F.lit(margin) * width).cast("int"))
    middle = F.slice(ink, edge + 1, F.greatest(width - 2 * edge, F.lit(0)))
    low, high = F.array_min(middle), F.array_max(middle)
    at = b["x1"] + edge + F.array_position(middle, low).cast("int") - 1

    def box(x1, y1, x2, y2):
        return F.struct(*[v.cast("int").alias(n) for v, n in ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2"))])

    head, body = box(b["x1"], b["y1"], b["x2"], cut), box(b["x1"], cut, b["x2"], b["y2"])
    two = F.coalesce((high > 0) & (low / high < valley), F.lit(False))
    return F.when(two, F.array(head, box(b["x1"], cut, at, b["y2"]), box(at, cut, b["x2"], b["y2"]))).otherwise(F.array(head, body))


def without_nested(boxes: Text, share: float = 0.7) -> Column:
    """Boxes not lying for more than ``share`` of their area in a larger one."""
    bs = _c(boxes)
    return F.filter(bs, lambda a: ~F.exists(bs, lambda b: (area(a) < area(b)) & (shared(a, b) > area(a) * share)))


def _same_band(a: Column, b: Column, least: float) -> Column:
    """Vertical overlap in proportion to the lower box."""
    over = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    lower = F.greatest(F.least(a["y2"] - a["y1"], b["y2"] - b["y1"]), F.lit(1))
    return over / lower >= least


def bands(boxes: Text, least: float) -> Column:
    """Boxes from top to bottom in groups: each joins the first group with a box in its band."""
    by_top = F.array_sort(F.transform(_c(boxes), lambda b: F.struct(b["y1"].alias("y1"), b["x1"].alias("x1"), b["x2"].alias("x2"), b["y2"].alias("y2"))))

    def place(groups: Column, b: Column) -> Column:
        fits = F.transform(groups, lambda g: F.exists(g, lambda m: _same_band(m, b, least)))
        at = F.array_position(fits, F.lit(True))
        return F.when(at > 0, F.transform(groups, lambda g, i: F.when(i + 1 == at, F.concat(g, F.array(b))).otherwise(g))).otherwise(F.concat(groups, F.array(F.array(b))))

    return F.aggregate(by_top, F.array().cast("array<array<struct<y1:int,x1:int,x2:int,y2:int>>>"), place)


def reading_order(boxes: Text, least: float = 0.3) -> Column:
    """Boxes line by line, from left to right within a line."""
    ordered = F.flatten(F.transform(bands(boxes, least), lambda g: F.array_sort(F.transform(g, lambda b: F.struct(b["x1"].alias("x1"), b["y1"].alias("y1"), b["x2"].alias("x2"), b["y2"].alias("y2"))))))
    return ordered


def band_boxes(boxes: Text, least: float = 0.2) -> Column:
    """One enclosing box a band."""
    def around(g: Column) -> Column:
        pick = lambda f, name: f(F.transform(g, lambda b: b[name])).alias(name)
        return F.struct(pick(F.array_min, "x1"), pick(F.array_min, "y1"), pick(F.array_max, "x2"), pick(F.array_max, "y2"))

    return F.transform(bands(boxes, least), around)


def needs_split(boxes: Text, width: Text, height: Text, share: float = 0.55) -> Column:
    """Whether the page came out as a single box over more than ``share`` of it."""
    bs = _c(boxes)
    return F.coalesce((F.size(bs) == 1) & (area(F.get(bs, F.lit(0))) > _c(width) * _c(height) * share), F.lit(False))


def _fuse(boxes: list[tuple[int, int, int, int]], overlap: float, near: int) -> list[tuple[int, int, int, int]]:
    """Merge pairs in order until none touches another."""
    todo = list(boxes)
    again = True
    while again:
        again = False
        done: list[tuple[int, int, int, int]] = []
        while todo:
            a = todo.pop(0)
            rest = []
            for b in todo:
                w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
                inter = max(w, 0) * max(h, 0)
                small = min((a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1]))
                if inter > overlap * max(small, 1) or abs(a[3] - b[1]) < near or abs(b[3] - a[1]) < near:
                    a = min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])
                    again = True
                else:
                    rest.append(b)
            todo = rest
            done.append(a)
        todo = done
    return todo


def _outer(page: list[tuple[int, int, int, int]], share: float) -> list[tuple[int, int, int, int]]:
    """As without_nested."""
    def own(b):
        return max(b[2] - b[0], 0) * max(b[3] - b[1], 0)

    def both(a, b):
        return max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)

    return [a for a in page if not any(own(a) < own(b) and both(a, b) > own(a) * share for b in page)]


def fused(boxes: Text, overlap: float = 0.15, near: int = 20, nested: float | None = None) -> Column:
    """Boxes merged to a fixed point where they overlap or nearly touch from above.

    The result depends on the order, so it can't be an aggregate; an Arrow batch a page.
    nested: leave out nested boxes first, as without_nested does with this share (the argument
    of a Python stage must not hold a lambda, so it can't be called before).
    """

    @F.pandas_udf(f"array<{BOX}>")
    def run(pages: pd.Series) -> pd.Series:
        out = []
        for page in pages:
            if page is None:
                out.append(None)
                continue
            all_ = [(b["x1"], b["y1"], b["x2"], b["y2"]) for b in page]
            merged = _fuse(all_ if nested is None else _outer(all_, nested), overlap, near)
            out.append([dict(zip(("x1", "y1", "x2", "y2"), map(int, b))) for b in merged])
        return pd.Series(out)

    return run(_c(boxes))


def resized(width: Text, height: Text, longest: int) -> Column:
    """Width and height scaled down so that the longer edge is at most ``longest``."""
    w, h = _c(width), _c(height)
    scale = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(w, h))
    return F.struct(F.bround(w * scale).cast("int").alias("width"), F.bround(h * scale).cast("int").alias("height"))


def segmented(df: DataFrame, candidates: str, width: Text, height: Text, ink: Column | None = None, out: str = "boxes") -> DataFrame:
    """df with the boxes of each page from candidates: nested ones out, fused, one a band, and a single dominant box split by its ink."""
    step = df.withColumn("_fused", fused(candidates, nested=0.7)).withColumn("_bands", band_boxes("_fused"))
    done = F.col("_bands")
    if ink is not None:
        done = F.when(needs_split(done, width, height), title_and_columns(F.get(done, F.lit(0)), ink)).otherwise(done)
    return step.withColumn(out, done).drop("_fused", "_bands")
