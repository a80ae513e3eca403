"""Column functions on boxes (struct<x1,y1,x2,y2: double>) and run-length masks (array<struct<y,x0,x1>>, x1 exclusive)."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F




def box(x1, y1, x2, y2) -> Column:
    named = zip(("x1", "y1", "x2", "y2"), (x1, y1, x2, y2))
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).cast("double").alias(n) for n, c in named])


def let(value: Column, f) -> Column:
    """f(value) with the value computed once, however often f uses it; keeps nested box expressions from growing."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def width(b: Column) -> Column:
    return b["x2"] - b["x1"]


def height(b: Column) -> Column:
    return b["y2"] - b["y1"]


def center(b: Column) -> Column:
    return F.struct(((b["x1"] + b["x2"]) / 2).alias("cx"), ((b["y1"] + b["y2"]) / 2).alias("cy"))


def is_valid(b: Column) -> Column:
    """Both sides positive; false when a coordinate is null."""
    return F.coalesce((b["x2"] > b["x1"]) & (b["y2"] > b["y1"]), F.lit(False))


def shifted(b: Column, dx, dy) -> Column:
    dx, dy = F.lit(dx), F.lit(dy)
    return box(b["x1"] + dx, b["y1"] + dy, b["x2"] + dx, b["y2"] + dy)


def area(b: Column) -> Column:
    """Sides clamped at zero."""
    return F.greatest(width(b), F.lit(0.0)) * F.greatest(height(b), F.lit(0.0))


def intersection_area(a: Column, b: Column) -> Column:
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def union_area(a: Column, b: Column) -> Column:
    return area(a) + area(b) - intersection_area(a, b)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when whole is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    return ratio(intersection_area(a, b), union_area(a, b))


def containment(inner: Column, outer: Column) -> Column:
    """Share of ``inner`` that ``outer`` covers."""
    return ratio(intersection_area(inner, outer), area(inner))


def edge_deltas(reference: Column, other: Column) -> Column:
    return F.struct(*[(other[k] - reference[k]).alias(k) for k in ("x1", "y1", "x2", "y2")])


def clip(b: Column, w, h) -> Column:
    def within(v: Column, top) -> Column:
        return F.least(F.greatest(v, F.lit(0.0)), F.lit(top).cast("double"))

    return box(within(b["x1"], w), within(b["y1"], h), within(b["x2"], w), within(b["y2"], h))


def from_xywh(a: Column) -> Column:
    """Array [x, y, width, height] to a box; null unless it has four numbers."""
    v = [F.get(a, i).cast("double") for i in range(4)]
    full = (F.size(a) == 4) & reduce(lambda p, q: p & q, [x.isNotNull() for x in v])
    return F.when(full, box(v[0], v[1], v[0] + v[2], v[1] + v[3]))


def from_cxcywh(a: Column) -> Column:
    v = [F.get(a, i).cast("double") for i in range(4)]
    return F.when(F.size(a) == 4, box(v[0] - v[2] / 2, v[1] - v[3] / 2, v[0] + v[2] / 2, v[1] + v[3] / 2))


def from_xyxy(a: Column) -> Column:
    return F.when(F.size(a) == 4, box(*[F.get(a, i) for i in range(4)]))


def to_xywh(b: Column) -> Column:
    return F.array(b["x1"], b["y1"], width(b), height(b))


def to_cxcywh(b: Column) -> Column:
    return F.array((b["x1"] + b["x2"]) / 2, (b["y1"] + b["y2"]) / 2, width(b), height(b))


def scaled(b: Column, w, h) -> Column:
    """Normalized to pixels; null for sizes that are not positive."""
    w, h = F.lit(w), F.lit(h)
    return F.when((w > 0) & (h > 0), box(b["x1"] * w, b["y1"] * h, b["x2"] * w, b["y2"] * h))


def normalized(b: Column, w, h) -> Column:
    w, h = F.lit(w), F.lit(h)
    return F.when((w > 0) & (h > 0), box(b["x1"] / w, b["y1"] / h, b["x2"] / w, b["y2"] / h))


def checked_normalized(b: Column, w, h) -> tuple[Column, Column]:
    """(normalized box, reject reason) of a pixel box: all four edges must lie in the image, and both sides be positive."""
    w, h = F.lit(w), F.lit(h)
    inside = b["x1"].between(0, w) & b["x2"].between(0, w) & b["y1"].between(0, h) & b["y2"].between(0, h)
    reason = F.when(~F.coalesce((w > 0) & (h > 0), F.lit(False)), "bad_size").when(~F.coalesce(inside, F.lit(False)), "out_of_range").when(~is_valid(b), "degenerate_box")
    return F.when(reason.isNull(), normalized(b, w, h)), reason


def frame_to_crop(b: Column, ox, oy) -> Column:
    return shifted(b, -F.lit(ox), -F.lit(oy))


def is_sane(b: Column, slack: float = 0.0) -> Column:
    """Ordered and within the unit square, with an allowance for rounding."""
    inside = (b["x1"] >= -slack) & (b["y1"] >= -slack) & (b["x2"] <= 1 + slack) & (b["y2"] <= 1 + slack)
    return F.coalesce(inside & (b["x1"] < b["x2"]) & (b["y1"] < b["y2"]), F.lit(False))


def stored_box(b: Column, w, h) -> tuple[Column, Column]:
    """(pixel box, skip reason) of a stored normalized box: missing, degenerate, or empty once clipped."""
    whole = reduce(lambda p, q: p & q, [b[k].isNotNull() for k in ("x1", "y1", "x2", "y2")])
    px = let(scaled(b, w, h), lambda s: clip(s, w, h))
    reason = F.when(~whole, "missing_box").when(~is_valid(b), "degenerate_box").when(~let(px, is_valid), "outside_image")
    return F.when(reason.isNull(), px), reason


def declared_box(raw: Column, fmt: Column, norm: Column, space: Column, w, h, origin: Column, frame: Column) -> tuple[Column, Column]:
    """(clipped pixel box, reject reason) of four numbers in a declared convention.

    fmt is xyxy, xywh or cxcywh; norm tells normalized numbers; space is image or frame. Frame boxes need the crop's origin
    (struct x, y), normalized frame boxes the frame's size (struct w, h).
    """
    four = (F.size(raw) == 4) & ~F.exists(raw, lambda v: v.isNull())
    b = F.when(fmt == "xyxy", from_xyxy(raw)).when(fmt == "xywh", from_xywh(raw)).when(fmt == "cxcywh", from_cxcywh(raw))
    sized = let(b, lambda x: F.when(~norm, x).when(space == "frame", scaled(x, frame["w"], frame["h"])).otherwise(scaled(x, w, h)))
    placed = let(sized, lambda x: F.when(space == "frame", frame_to_crop(x, origin["x"], origin["y"])).otherwise(x))
    out = let(placed, lambda x: clip(x, w, h))
    reason = (
        F.when(~F.coalesce(four, F.lit(False)), "bad_bbox")
        .when(~F.coalesce(fmt.isin("xyxy", "xywh", "cxcywh"), F.lit(False)), "unknown_format")
        .when(~F.coalesce(space.isin("image", "frame"), F.lit(False)), "unknown_space")
        .when((space == "frame") & origin["x"].isNull(), "no_crop_origin")
        .when((space == "frame") & norm & frame["w"].isNull(), "no_frame_size")
        .when(~let(out, is_valid), "empty_box")
    )
    return F.when(reason.isNull(), out), reason


def coco_box(xywh: Column, w: Column, h: Column) -> Column:
    """Pixel xywh to a clipped normalized box; null when sizes are not positive or nothing is left."""
    ok = (w > 0) & (h > 0) & (F.size(xywh) == 4) & (F.get(xywh, 2) > 0) & (F.get(xywh, 3) > 0)
    b = let(let(from_xywh(xywh), lambda x: normalized(x, w, h)), lambda x: clip(x, 1, 1))
    return F.when(ok, let(b, lambda x: F.when(is_valid(x), x)))


def clamped_model_box(b: Column) -> Column:
    """Clipped to the unit square, at least 1e-4 wide; null if degenerate."""
    def widened(c: Column) -> Column:
        return F.when(is_valid(c), box(c["x1"], c["y1"], F.when(width(c) < 1e-4, c["x1"] + 1e-4).otherwise(c["x2"]), c["y2"]))

    return let(let(b, lambda x: clip(x, 1, 1)), widened)


@lru_cache(maxsize=1)
def _mask_udfs(context):
    """(area, pixels in a box, tight box) of masks, over Arrow arrays of many masks at once; made once per context, so that one plan computes each only once."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def column(values: pa.Array, absent: float) -> np.ndarray:
        return values.cast(pa.float64()).fill_null(absent).to_numpy(zero_copy_only=False)

    def runs_of(masks: pa.Array):
        """(mask of every run, y, x0, x1); a run's missing fields are NaN."""
        flat = masks.flatten()
        fields = dict(zip([f.name for f in flat.type], flat.flatten()))
        return pc.list_parent_indices(masks).to_numpy(), *[column(fields[n], np.nan) for n in ("y", "x0", "x1")]

    def summed(masks: pa.Array, of: np.ndarray, wide: np.ndarray) -> pa.Array:
        wide = np.where(wide > 0, wide, 0)  # NaN as well
        return pa.array(np.bincount(of, weights=wide, minlength=len(masks)).astype(np.int64), mask=masks.is_null().to_numpy(zero_copy_only=False))

    def area_(masks):
        of, _, x0, x1 = runs_of(masks)
        return summed(masks, of, x1 - x0)

    def pixels(masks, bx1, by1, bx2, by2):
        of, y, x0, x1 = runs_of(masks)
        inside = (y >= column(by1, np.nan)[of]) & (y < column(by2, np.nan)[of])
        of, x0, x1 = of[inside], x0[inside], x1[inside]
        return summed(masks, of, np.fmin(x1, column(bx2, np.nan)[of]) - np.fmax(x0, column(bx1, np.nan)[of]))

    def tight(masks):
        of, y, x0, x1 = runs_of(masks)
        live = x1 > x0
        of, y, x0, x1 = of[live], y[live], x0[live], x1[live]
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        own = of[starts]
        out = np.full((4, len(masks)), np.nan)
        if len(own):
            for n, (f, v) in enumerate(((np.fmin, x0), (np.fmin, y), (np.fmax, x1), (np.fmax, y + 1))):
                out[n, own] = f.reduceat(v, starts)
        empty = np.ones(len(masks), bool)
        empty[own] = False
        return pa.StructArray.from_arrays([pa.array(v, mask=np.isnan(v)) for v in out], ["x1", "y1", "x2", "y2"], mask=pa.array(empty))

    def in_parts(f):
        """A batch by 512 masks, whose arrays stay in the caches."""
        return lambda masks, *others: pa.concat_arrays([f(masks[i : i + 512], *[o[i : i + 512] for o in others]) for i in range(0, max(1, len(masks)), 512)])

    return [F.arrow_udf(in_parts(f), t) for f, t in ((area_, "long"), (pixels, "long"), (tight, "x1 double, y1 double, x2 double, y2 double"))]


def _masks(n: int):
    return _mask_udfs(SparkContext._active_spark_context)[n]


def mask_area(runs: Column) -> Column:
    return _masks(0)(runs)


def tight_box(runs: Column) -> Column:
    """Smallest box around a mask, right and bottom exclusive; null if the mask is empty."""
    return _masks(2)(runs)


def mask_pixels_in(runs: Column, b: Column) -> Column:
    """Pixels with x1 <= x < x2 and y1 <= y < y2."""
    return _masks(1)(runs, *[F.ceil(b[k]) for k in ("x1", "y1", "x2", "y2")])


def mask_box_ratio(runs: Column, b: Column) -> Column:
    return ratio(mask_area(runs).cast("double"), area(b))


def mask_containment(runs: Column, b: Column) -> Column:
    return ratio(mask_pixels_in(runs, b).cast("double"), mask_area(runs).cast("double"))


def object_geometry(feed: Column, segment: Column, runs: Column) -> Column:
    """All agreement measures of a feed box, a segment box and a mask."""
    return F.struct(
        iou(feed, segment).alias("bbox_iou"),
        edge_deltas(feed, segment).alias("edge_deltas"),
        mask_area(runs).alias("mask_area"),
        area(feed).alias("feed_area"),
        area(segment).alias("segment_area"),
        mask_box_ratio(runs, segment).alias("mask_bbox_ratio"),
        mask_containment(runs, feed).alias("mask_feed_containment"),
        containment(segment, feed).alias("segment_feed_containment"),
    )
