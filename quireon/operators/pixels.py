"""Pixels of a page: white masks, blurred boundary, connected components of ink."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RGB = ["r", "g", "b"]
#: A channel above this is almost white; radius of the box that the boundary is blurred over.
ALMOST, RADIUS = 200, 10


def is_white(channels: list[Column]) -> Column:
    return (channels[0] == 255) & (channels[1] == 255) & (channels[2] == 255)


def is_almost_white(channels: list[Column], threshold: int = ALMOST) -> Column:
    return (channels[0] > threshold) & (channels[1] > threshold) & (channels[2] > threshold)


def box_sums(v: np.ndarray, radius: int) -> np.ndarray:
    """Sums over the box of a radius around each place of an array of two dimensions, zeros outside."""
    for axis in (0, 1):
        upto = np.concatenate([np.zeros_like(v[:1]), np.cumsum(v, axis=0)])
        i = np.arange(len(v))
        v = (upto[np.minimum(i + radius + 1, len(v))] - upto[np.maximum(i - radius, 0)]).T
    return v


def blurred(channels: list[np.ndarray], known: list[np.ndarray], radius: int, threshold: int = ALMOST) -> tuple[list[np.ndarray], np.ndarray]:
    """(channels, where the boundary is near) of one page, from its channels by y and x, 0 where not known."""
    every = np.logical_and.reduce(known)
    white = np.where(every & np.logical_and.reduce([c == 255 for c in channels]), 1, np.where(np.logical_or.reduce([k & (c != 255) for c, k in zip(channels, known, strict=True)]), 0, -1))
    edge = np.zeros(white.shape, bool)
    for axis in (0, 1):
        one, other = (white[1:], white[:-1]) if axis == 0 else (white[:, 1:], white[:, :-1])
        at, to = (edge[1:], edge[:-1]) if axis == 0 else (edge[:, 1:], edge[:, :-1])
        at |= (one == 1) & (other == 0)
        to |= (other == 1) & (one == 0)
    almost = every & np.logical_and.reduce([c > threshold for c in channels])
    near = box_sums(edge.astype(np.int64), radius) > 0
    out = []
    for c, k in zip(channels, known, strict=True):
        plain = np.where(almost, int(c.sum()) // max(1, int(k.sum())), c)
        out.append(np.where(near, box_sums(plain, radius) // (2 * radius + 1) ** 2, plain))
    return out, near


def blurred_boundary(pixels: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(page_id, x, y, r, g, b): almost white pixels take the page's mean colour; near the edge of the white, a box mean.

    pixels has every pixel of a page once; it is an error if some are missing or there twice. An
    edge pixel is white and has a neighbour (of four; outside the page it is its own) that isn't.
    Pixels within radius of one, in both directions, become the mean of the box around them, with
    zeros outside the page; values are cut to whole numbers. A page's pixels are one group, so they
    are shuffled once at most, and not at all where they lie by pages already; box sums are
    differences of running sums.
    """

    def page(t: pa.Table) -> pa.Table:
        x, y = (t.column(c).to_numpy().astype(np.int64) for c in ("x", "y"))
        wide, high = int(x.max() - x.min()) + 1, int(y.max() - y.min()) + 1
        at = (y - y.min()) * wide + x - x.min()
        if wide * high != len(at) or len(np.unique(at)) != len(at):
            raise ValueError(f"page {t.column('page_id')[0]} has {len(at)} pixels, not each of {wide} x {high} once")
        channels, known = [], []
        for c in RGB:
            v, k = np.zeros((high, wide), np.int64), np.zeros((high, wide), bool)
            v.ravel()[at] = pc.fill_null(pc.cast(t.column(c), pa.int64()), 0).to_numpy()
            k.ravel()[at] = t.column(c).is_valid().to_numpy()
            channels.append(v)
            known.append(k)
        values, near = blurred(channels, known, radius)
        columns = {c: pa.array(v.ravel()[at].astype(np.int32), mask=~(k | near).ravel()[at]) for c, v, k in zip(RGB, values, known, strict=True)}
        return pa.table({"page_id": t.column("page_id"), "x": t.column("x"), "y": t.column("y"), **columns})

    of = {c: pixels.schema[c].dataType.simpleString() for c in ("page_id", "x", "y")}
    return pixels.select("page_id", "x", "y", *RGB).groupBy("page_id").applyInArrow(page, f"page_id {of['page_id']}, x {of['x']}, y {of['y']}, r int, g int, b int")


def runs(rows: DataFrame) -> DataFrame:
    """(page_id, y, x0, x1, ink): runs of black pixels (0) of each row, and of all others; rows has page_id, y and the array `row`. Null pixels are neither."""

    def batch(t: pa.RecordBatch) -> pa.RecordBatch:
        row, of = t.column("row"), pc.list_parent_indices(t.column("row")).to_numpy()
        pixels = row.flatten()
        kind = pc.fill_null(pc.cast(pc.equal(pixels, 0), "int8"), -1).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (kind[1:] != kind[:-1])])) if len(of) else np.zeros(0, int)
        last = np.append(first[1:], len(of)) - 1
        first, last = first[kind[first] >= 0], last[kind[first] >= 0]
        begin, mine = np.searchsorted(of, of[first]), pa.array(of[first])
        return pa.record_batch({"page_id": t.column("page_id").take(mine), "y": t.column("y").take(mine), "x0": pa.array(first - begin, "int32"), "x1": pa.array(last - begin, "int32"), "ink": pa.array(kind[first] == 1)})

    page = rows.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", F.col("y").cast("int").alias("y"), "row").mapInArrow(lambda ts: map(batch, ts), f"page_id {page}, y int, x0 int, x1 int, ink boolean")


def rooted(y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """The first run of the component of each of a page's runs, which are in order of y and x0; runs of neighbouring rows touch, corners included.

    Roots that touch take the lesser one, then each run its root's root, until nothing changes.
    """
    wide = int(x1.max(initial=0)) + 3
    at, upto = y * wide + x0 + 1, y * wide + x1 + 1
    low, high = np.searchsorted(upto, at + wide - 1), np.searchsorted(at, upto + wide + 1, side="right")
    n = np.maximum(high - low, 0)
    a = np.repeat(np.arange(len(y)), n)
    b = np.repeat(low, n) + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
    root = np.arange(len(y))
    while True:
        one, other = root[a], root[b]
        if (one == other).all():
            return root
        np.minimum.at(root, np.maximum(one, other), np.minimum(one, other))
        while ((far := root[root]) != root).any():
            root = far


def component_stats(rows: DataFrame) -> DataFrame:
    """(page_id, label, anchor_x, anchor_y, width, height, area) of the components of black pixels, eight neighbours each.

    Labels count from 1 in order of the components' first pixels, row by row; label 0 is the
    background, all that isn't black, where there is any. Rows may be missing; null pixels are
    neither. Pixels become runs, so what is shuffled and what a page's task holds follow the
    outlines, not the areas; runs are shuffled once.
    """

    def page(t: pa.Table) -> pa.Table:
        y, x0, x1 = (t.column(c).to_numpy().astype("int64") for c in ("y", "x0", "x1"))
        ink = np.lexsort((x0, y))
        ink = ink[t.column("ink").to_numpy()[ink]]
        root = np.full(len(y), -1)
        root[ink] = rooted(y[ink], x0[ink], x1[ink])
        by = np.argsort(root, kind="stable")
        roots, starts = np.unique(root[by], return_index=True)
        of = lambda f, v: f.reduceat(v[by], starts)
        x, top = of(np.minimum, x0), of(np.minimum, y)
        label = np.arange(len(roots)) + (0 if roots[0] < 0 else 1)
        out = {"label": label, "anchor_x": x, "anchor_y": top, "width": of(np.maximum, x1) - x + 1, "height": of(np.maximum, y) - top + 1}
        return pa.table({"page_id": t.column("page_id").slice(0, 1).take([0] * len(roots)), **{c: pa.array(v, "int32") for c, v in out.items()}, "area": of(np.add, x1 - x0 + 1)})

    of = rows.schema["page_id"].dataType.simpleString()
    return runs(rows).groupBy("page_id").applyInArrow(page, f"page_id {of}, label int, anchor_x int, anchor_y int, width int, height int, area long")
