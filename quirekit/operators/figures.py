"""Figure boxes on page images given as grey-value arrays."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirekit.operators.assets import FIGURE_TOKEN, number_tokens


def components(mask: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """Four-connected regions: x0, y0, x1, y1 (exclusive) and the number of pixels."""
    left = mask.copy()
    for y, x in zip(*np.nonzero(mask)):
        if not left[y, x]:
            continue
        todo, n, x0, y0, x1, y1 = deque([(y, x)]), 0, x, y, x, y
        left[y, x] = False
        while todo:
            b, a = todo.popleft()
            n, x0, y0, x1, y1 = n + 1, min(x0, a), min(y0, b), max(x1, a), max(y1, b)
            for d, c in ((b - 1, a), (b + 1, a), (b, a - 1), (b, a + 1)):
                if 0 <= d < left.shape[0] and 0 <= c < left.shape[1] and left[d, c]:
                    left[d, c] = False
                    todo.append((d, c))
        yield int(x0), int(y0), int(x1) + 1, int(y1) + 1, n


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    """Each set pixel grown to a square of 2 * radius + 1."""
    p = np.pad(mask, radius)
    rows = np.lib.stride_tricks.sliding_window_view(p, 2 * radius + 1, axis=0).any(-1)
    return np.lib.stride_tricks.sliding_window_view(rows, 2 * radius + 1, axis=1).any(-1)


def overlap(a: tuple, b: tuple) -> float:
    """Shared area over joint area of two boxes."""
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(0, w) * max(0, h)
    area = lambda r: (r[2] - r[0]) * (r[3] - r[1])
    return both / (area(a) + area(b) - both) if both else 0.0


def figure_boxes(grey: np.ndarray, *, dark: int = 200, grow: int = 3, least_h: float = 0.07, least_w: float = 0.18, most_area: float = 0.88, most: int = 3, tried: int = 20, shared: float = 0.45) -> list[tuple[int, int, int, int]]:
    """Up to ``most`` boxes of dark regions of figure-like size that hardly overlap, the best first.

    A region counts by its pixels and height. The ``tried`` best are then weighed by place: those above the middle
    count most, very high ones and thin ones at the top, which are headers, little.
    """
    h, w = grey.shape
    lo, hi = int(grey.min()), int(grey.max())
    flat = (grey.astype(np.float64) - lo) * (255 / (hi - lo)) if hi > lo else grey
    k = max(1, min(w, h) // 900)
    mask = dilate(flat[::k, ::k] < dark, max(1, grow // k))
    found = []
    rows, columns = mask.shape
    for x0, y0, x1, y1, pixels in components(mask):
        bw, bh = (x1 - x0) / columns, (y1 - y0) / rows
        if bh >= least_h and bw >= least_w and bw * bh <= most_area:
            found.append((pixels * (1 + bh), bh, (x0 * k, y0 * k, x1 * k, y1 * k)))
    best = sorted(found, key=lambda f: -f[0])[:tried]
    place = lambda box: 1.25 - abs((box[1] + box[3]) / 2 / h - 0.42)
    weight = lambda bh, box: (0.2 if bh > 0.72 else 1.0) * (0.4 if box[1] < 0.03 * h and bh < 0.12 else 1.0)
    chosen: list[tuple] = []
    for _, box in sorted(((s * place(box) * weight(bh, box), box) for s, bh, box in best), key=lambda f: -f[0]):
        if len(chosen) < most and all(overlap(box, c) <= shared for c in chosen):
            chosen.append(box)
    return chosen


def crops(boxes: DataFrame, key: str = "id", *, pad: int = 12, most_area: float = 0.9) -> DataFrame:
    """Boxes (key, w, h, box_no, x0, y0, x1, y1) grown by ``pad`` within the page; those of almost the whole page go.

    Adds the crop's file name, page and box number; the pixels are cut by ``cut``."""
    grown = boxes.select(
        key, "w", "h", "box_no", F.greatest(F.col("x0") - pad, F.lit(0)).alias("x0"), F.greatest(F.col("y0") - pad, F.lit(0)).alias("y0"),
        F.least(F.col("x1") + pad, F.col("w")).alias("x1"), F.least(F.col("y1") + pad, F.col("h")).alias("y1"),
    )
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / (F.col("w") * F.col("h"))
    return grown.where(area < most_area).withColumn("file", F.format_string("figures/%s-%d.jpg", F.col(key), F.col("box_no")))


def cut(px: Column, w: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Grey values of a box, by row, from those of the whole page."""
    return F.flatten(F.transform(F.sequence(y0, y1 - 1), lambda y: F.slice(px, y * w + x0 + 1, x1 - x0)))


def needs_crop(tokens: Column) -> Column:
    """Those of a page's figure names that don't name a crop yet: a bare number, a page image, or any path outside ``figures/``."""
    path = lambda t: F.replace(t, F.lit("\\"), F.lit("/"))
    return F.filter(tokens, lambda t: F.regexp_extract(path(t), "[^/]*$", 0).rlike(r"(?i)^[0-9]+(\.(jpg|jpeg|png|webp))?$") | ~path(t).contains("figures/"))


def crop_pages(pages: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages (page_no, md) whose figure tokens name crops of their images (page_no, w, h, px), and the crops with their grey values.

    Only images of pages with a token that needs a crop are looked at."""
    tokens = F.regexp_extract_all(F.col("md"), F.lit(FIGURE_TOKEN), F.lit(1))
    due = images.join(pages.where(F.size(needs_crop(tokens)) > 0).select("page_no"), "page_no", "left_semi")
    found = crops(find_figures(due, "page_no").join(images.select("page_no", "w", "h"), "page_no"), "page_no")
    pixels = found.join(images.select("page_no", "px"), "page_no").withColumn("px", cut(F.col("px"), *map(F.col, ("w", "x0", "y0", "x1", "y1"))))
    return place_crops(pages, found), pixels


def place_crops(pages: DataFrame, found: DataFrame, page: str = "page_no", text: str = "md") -> DataFrame:
    """Pages with their figure tokens naming the page's crops in order; tokens beyond the last crop name it again.

    ``found``: page, box_no, file. Pages without a token that needs a crop, and those without crops, stay; adds changed."""
    files = found.groupBy(page).agg(F.transform(F.array_sort(F.collect_list(F.struct("box_no", "file"))), lambda x: x["file"]).alias("_f"))
    both = pages.join(files, page, "left")
    tokens = F.regexp_extract_all(F.col(text), F.lit(FIGURE_TOKEN), F.lit(1))
    more = F.array_repeat(F.element_at("_f", -1), F.greatest(F.size(tokens) - F.size("_f"), F.lit(0)))
    due = F.col("_f").isNotNull() & (F.size(needs_crop(tokens)) > 0)
    done = F.when(due, number_tokens(F.col(text), F.concat("_f", more))).otherwise(F.col(text))
    return both.withColumn("changed", F.coalesce(done != F.col(text), F.lit(False))).withColumn(text, done).drop("_f")


def find_figures(images: DataFrame, key: str = "id") -> DataFrame:
    """Boxes of images (key, w, h, px: grey values by row): box_no, x0, y0, x1, y1. Images of wrong size have none."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, w, h, px in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if px and w and h and len(px) == w * h:
                    rows += [(i, n, *box) for n, box in enumerate(figure_boxes(np.array(px, np.int32).reshape(h, w)), 1)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [b.column(0).type] + [pa.int32()] * 5, strict=True)], names=[key, "box_no", "x0", "y0", "x1", "y1"])

    kind = dict(images.dtypes)[key]
    return images.select(key, "w", "h", "px").mapInArrow(find, f"{key} {kind}, box_no int, x0 int, y0 int, x1 int, y1 int")
