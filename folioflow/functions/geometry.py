"""Column functions on boxes, given as array<double> [x0, y0, x1, y1]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def corner(box: Column | str, i: int) -> Column:
    """One coordinate, with the corners put in order; null for boxes that aren't four numbers."""
    b = F.col(box) if isinstance(box, str) else box
    whole = (F.size(b) == 4) & ~F.exists(b, lambda x: x.isNull())
    low, high = F.get(b, F.lit(i % 2)), F.get(b, F.lit(i % 2 + 2))
    return F.when(whole, F.least(low, high) if i < 2 else F.greatest(low, high))


def with_corners(df, box: str = "bbox"):
    """df with x0, y0, x1 and y1."""
    return df.withColumns({n: corner(box, i) for i, n in enumerate(("x0", "y0", "x1", "y1"))})


def area(p: str = "") -> Column:
    """Area of a box of columns with a prefix; null without a box."""
    x0, y0, x1, y1 = (F.col(f"{p}{n}") for n in ("x0", "y0", "x1", "y1"))
    # greatest() passes over nulls, so a missing corner has to be looked at first
    return F.when(x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull(), F.greatest(F.lit(0.0), x1 - x0) * F.greatest(F.lit(0.0), y1 - y0))


def iou(a: str, b: str) -> Column:
    """Intersection over union of two boxes of columns with prefixes a and b."""
    w = F.least(f"{a}x1", f"{b}x1") - F.greatest(f"{a}x0", f"{b}x0")
    h = F.least(f"{a}y1", f"{b}y1") - F.greatest(f"{a}y0", f"{b}y0")
    common = F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)
    union = area(a) + area(b) - common
    return F.when(union > 0, common / union).otherwise(F.lit(0.0))


def clamped(width: Column, height: Column) -> dict[str, Column]:
    """x0, y0, x1 and y1 inside the page."""
    zero = F.lit(0.0)
    return {n: F.greatest(zero, F.least(F.col(n), (width if n[0] == "x" else height).cast("double"))) for n in ("x0", "y0", "x1", "y1")}
