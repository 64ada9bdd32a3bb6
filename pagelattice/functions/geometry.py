"""Box arithmetic as Spark columns. Boxes are structs (x0, y0, x1, y1) of integers, null as a whole."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0, y0, x1, y1) -> Column:
    as_int = lambda c: (c if isinstance(c, Column) else F.col(c)).cast("int")
    return F.struct(as_int(x0).alias("x0"), as_int(y0).alias("y0"), as_int(x1).alias("x1"), as_int(y1).alias("y1"))


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def area(b: Column) -> Column:
    return width(b).cast("bigint") * height(b)


def overlap_x(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))


def overlap_y(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))


def intersection(a: Column, b: Column) -> Column:
    return overlap_x(a, b).cast("bigint") * overlap_y(a, b)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union, the union at least 1."""
    inter = intersection(a, b)
    return inter / F.greatest(F.lit(1), area(a) + area(b) - inter)


def containment(a: Column, b: Column) -> Column:
    """Intersection over the smaller area, areas at least 1."""
    return intersection(a, b) / F.least(F.greatest(F.lit(1), area(a)), F.greatest(F.lit(1), area(b)))


def center_inside(inner: Column, outer: Column) -> Column:
    """Whether the inner box's centre lies in the outer one, edges included."""
    cx, cy = (inner["x0"] + inner["x1"]) / 2, (inner["y0"] + inner["y1"]) / 2
    return (cx >= outer["x0"]) & (cx <= outer["x1"]) & (cy >= outer["y0"]) & (cy <= outer["y1"])


def vertical_gap(a: Column, b: Column) -> Column:
    """Empty rows between two boxes, 0 where they overlap."""
    return F.greatest(F.lit(0), a["y0"] - b["y1"], b["y0"] - a["y1"])


def column_overlap(line: Column, region: Column) -> Column:
    """Share of the line's width that lies within the region's columns."""
    return overlap_x(line, region) / F.greatest(F.lit(1), width(line))


def row_overlap(a: Column, b: Column) -> Column:
    """Shared rows over the lower height."""
    return overlap_y(a, b) / F.greatest(F.lit(1), F.least(height(a), height(b)))


def union(a: Column, b: Column) -> Column:
    return box(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def shifted(b: Column, dx: Column, dy: Column) -> Column:
    """A tile's box in the coordinates of its canvas."""
    return box(b["x0"] + dx, b["y0"] + dy, b["x1"] + dx, b["y1"] + dy)


def from_points(numbers: Column, canvas_w: Column, canvas_h: Column) -> Column:
    """Box of a flat list, clamped to the canvas: four numbers are the box itself, eight are the corners of a
    quadrilateral; null for any other length, and where right isn't beyond left or bottom beyond top."""
    corner = lambda k: F.get(numbers, F.lit(k))
    xs = F.filter(numbers, lambda v, k: k % 2 == 0)
    ys = F.filter(numbers, lambda v, k: k % 2 == 1)
    four = F.size(numbers) == 4
    edges = [F.when(four, corner(k)).otherwise(f(v)) for k, (f, v) in enumerate(((F.array_min, xs), (F.array_min, ys), (F.array_max, xs), (F.array_max, ys)))]
    return _on_canvas(edges, F.size(numbers).isin(4, 8), canvas_w, canvas_h)


def around(points: Column, canvas_w: Column, canvas_h: Column) -> Column:
    """Box around a list of points [[x, y], ...], clamped to the canvas; null if degenerate."""
    xs, ys = F.transform(points, lambda p: F.get(p, F.lit(0))), F.transform(points, lambda p: F.get(p, F.lit(1)))
    return _on_canvas([F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)], F.size(points) > 0, canvas_w, canvas_h)


def _on_canvas(edges: list[Column], known: Column, canvas_w: Column, canvas_h: Column) -> Column:
    clamp = lambda v, top: F.greatest(F.lit(0), F.least(v.cast("int"), top))
    b = box(clamp(edges[0], canvas_w), clamp(edges[1], canvas_h), clamp(edges[2], canvas_w), clamp(edges[3], canvas_h))
    return F.when(known & (b["x1"] > b["x0"]) & (b["y1"] > b["y0"]), b)


def percent_box(b: Column, canvas_w: Column, canvas_h: Column) -> Column:
    """Left, top, width and height in percent of the canvas."""
    part = lambda v, whole: 100.0 * v / F.greatest(F.lit(1), whole)
    return F.struct(part(b["x0"], canvas_w).alias("left"), part(b["y0"], canvas_h).alias("top"), part(width(b), canvas_w).alias("width"), part(height(b), canvas_h).alias("height"))
