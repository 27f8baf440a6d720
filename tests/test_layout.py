"""Page layout, fonts and pixels against plain Python on random pages, and their corner cases."""

import random
from collections import defaultdict
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireon.operators import fonts as T
from quireon.operators import layout as Y
from quireon.operators import pixels as P
from quireon.plans import layout as lay

BOX = "anchor_x int, anchor_y int, antipod_x int, antipod_y int"


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_words_of_chains(spark):
    """A chain of 300 boxes in shuffled numbers, box 0 in the middle of another, one-sided neighbours, a page of its own."""
    rng = random.Random(1)
    ids = list(range(10, 310))
    rng.shuffle(ids)
    beside = [(1, b, ids[k - 1] if k else None, ids[k + 1] if k < 299 else None) for k, b in enumerate(ids)]
    beside += [(1, 5, None, 0), (1, 0, 5, 6), (1, 6, 0, None), (1, 7, 6, None), (2, 0, None, 1), (2, 1, None, None), (2, 3, 4, None), (2, 4, None, 3)]
    got = Y.words(spark.createDataFrame(beside, "page_id long, box_id long, left_neighbor long, right_neighbor long"))
    want = [(1, b, 2, k) for k, b in enumerate(ids)] + [(1, 5, 0, 0), (1, 0, 0, 1), (1, 6, 0, 2), (1, 7, 1, 0), (2, 0, 0, 0), (2, 1, 1, 0), (2, 4, 2, 0), (2, 3, 2, 1)]
    assert rows_of(got, "page_id", "box_id", "word", "place") == sorted(want)
    assert Y.words(spark.createDataFrame([], "page_id long, box_id long, left_neighbor long, right_neighbor long")).count() == 0


def random_page(rng, n, seps=6):
    words, bars = [], []
    for k in range(n):
        x, y, h = rng.randrange(0, 900), rng.randrange(0, 700), rng.choice([8, 12, 15, 30, 70])
        words.append((k, x, y, x + rng.randrange(5, 120), y + h))
    for k in range(rng.randrange(seps + 1)):
        x, y = rng.randrange(0, 950), rng.randrange(0, 600)
        bars.append((k, x, y, x + rng.randrange(1, 9), y + rng.randrange(60, 400)))
    return words, bars


def test_rays_equal_all_pairs(spark):
    """Also in the largest band: a thousand words of one band, and separators over many bands."""
    rng = random.Random(3)
    pages = {p: random_page(rng, 60) for p in range(8)}
    pages[9] = ([(k, k % 40 * 20, 130 + k % 9, k % 40 * 20 + 9, 150 + k % 9) for k in range(1000)], [(k, 30 * k, 0, 30 * k + 3, 900) for k in range(30)])
    words = spark.createDataFrame([(p, *w) for p, (ws, _) in pages.items() for w in ws], f"page_id long, word int, {BOX}")
    bars = spark.createDataFrame([(p, *s) for p, (_, ss) in pages.items() for s in ss], f"page_id long, box_id long, {BOX}")
    want = []
    for p, (ws, ss) in pages.items():
        for w, _, y0, x1, y1 in ws:
            h = y1 - y0
            met = [(a, c, s) for s, a, b, c, d in ss if d > y0 + h / 4 and b < y1 - h / 4 and a < x1 + 2 * h and c > x1]
            if met:
                want.append((p, w, min(met)[2], min(met)[0]))
    assert rows_of(Y.ray_stops(words, bars), "page_id", "word", "separator", "stop_x") == sorted(want)


def lines_by_hand(words, bars):
    """The rule word by word, over all words each time."""
    line, n = {}, 0
    while free := [w for w in words if w[0] not in line]:
        cur = min(free, key=lambda w: (w[1], w[0]))
        end, top, bottom, gaps = cur[3], cur[2], cur[4], []
        while True:
            line[cur[0]] = n
            end, top, bottom = max(end, cur[3]), min(top, cur[2]), max(bottom, cur[4])
            h = bottom - top
            reach = 2 if len(gaps) < 5 else median(gaps) * 2.5
            zone = lambda b: b[4] > top + h / 4 and b[2] < bottom - h / 4 and b[1] < end + reach * h  # noqa: B023, E731
            near = [w for w in words if w[0] not in line and zone(w) and w[4] - w[2] < 4 * h and 4 * (w[4] - w[2]) > h]
            stops = [s for s in bars if zone(s) and s[3] > end]
            if not near:
                break
            cur = min(near, key=lambda w: (w[1], w[0]))
            if stops and (min(s[1] for s in stops) < cur[1] or min(s[3] for s in stops) < cur[1]):
                break
            if cur[1] > end:
                gaps.append((cur[1] - end) / h)
        n += 1
    return line


def printed_page(rng):
    """Rows of words with narrow gaps, so that lines of many words and medians of gaps occur."""
    words, y = [], 10
    for _ in range(14):
        x = rng.randrange(0, 60)
        for _ in range(rng.randrange(1, 14)):
            w = rng.randrange(8, 60)
            words.append((len(words), x, y + rng.randrange(-3, 4), x + w, y + 14 + rng.randrange(-3, 4)))
            x += w + rng.choice([3, 5, 8, 9, 25, 40])
        y += rng.choice([12, 18, 24])
    return words, [(0, 300, 0, 304, 500)] if rng.random() < 0.5 else []


def test_lines_equal_brute_force(spark):
    rng = random.Random(5)
    pages = {p: (random_page(rng, 50) if p % 2 else printed_page(rng)) for p in range(40)}
    words = spark.createDataFrame([(p, *w) for p, (ws, _) in pages.items() for w in ws], f"page_id long, word int, {BOX}")
    bars = spark.createDataFrame([(p, *s[1:]) for p, (_, ss) in pages.items() for s in ss], f"page_id long, {BOX}")
    want = sorted((p, w, n) for p, page in pages.items() for w, n in lines_by_hand(*page).items())
    assert rows_of(Y.lines(words, bars), "page_id", "word", "line") == want
    assert max(len([1 for x in want if x[:1] == (p,) and x[2] == n]) for p in pages for n in range(3)) > 6


def test_valid_lines(spark):
    words = [(1, 0, 0, 0, 30, 10, 1), (1, 1, 0, 50, 40, 60, 4), (1, 2, 50, 50, 90, 61, 1), (1, 3, 0, 100, 10, 190, 3), (1, 4, 30, 100, 60, 130, 2)]
    w = spark.createDataFrame(words, f"page_id long, word int, {BOX}, length long")
    got = Y.line_boxes(w, spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 2, 1), (1, 3, 2), (1, 4, 3)], "page_id long, word int, line int"))
    assert rows_of(got, "line", "antipod_x", "antipod_y", "words_len", "valid") == [(0, 30, 10, [1], False), (1, 90, 61, [4, 1], True), (2, 10, 190, [3], False), (3, 60, 130, [2], False)]


def test_columns_in_reading_order(spark):
    """A title over two columns, the left one read first; a separator that overlaps lines on both its sides; a line that reaches into the next column."""
    title, left, right = (0, 0, 100, 12), [(0, y, 45, y + 12) for y in (20, 40, 60, 80)], [(55, y, 100, y + 12) for y in (20, 40, 60, 80)]
    boxes = [title, *left, *right]
    assert Y.numbered(boxes, []) == list(range(9))
    assert Y.numbered(boxes, [(0, 50, 120, 62)]) == [0, 1, 2, 5, 6, 3, 4, 7, 8]
    wide = [title, *left, *right, (0, 100, 70, 112), (0, 120, 45, 132), (55, 120, 100, 132)]
    assert Y.numbered(wide, []) == [*range(9), 9, 10, 11]
    assert Y.numbered([], []) == []
    df = spark.createDataFrame([(p, k, *b) for p in (1, 2) for k, b in enumerate(boxes)], f"page_id long, line int, {BOX}")
    rule = spark.createDataFrame([(2, 0, 50, 120, 62)], f"page_id long, {BOX}")
    want = [(1, k, k) for k in range(9)] + [(2, k, n) for k, n in enumerate([0, 1, 2, 5, 6, 3, 4, 7, 8])]
    assert rows_of(Y.reading_order(df, rule), "page_id", "line", "num") == want
    text = {r.page_id: r.segments for r in Y.segments(df, Y.reading_order(df, rule)).collect()}
    assert text[1].startswith('{"text_direction": "horizontal-lr", "boxes": [[0, 0, 100, 12], [0, 20, 45, 32], ') and text[1].endswith('], "script_detection": false}')


def test_every_line_is_read_once():
    """On random pages, where columns may be all of the page (the rule by itself would never end)."""
    rng = random.Random(11)
    for _ in range(300):
        boxes = [(x, y, x + rng.randrange(5, 400), y + rng.randrange(4, 60)) for x, y in ((rng.randrange(0, 500), rng.randrange(0, 300)) for _ in range(rng.randrange(1, 25)))]
        assert sorted(Y.numbered(boxes, [(0, 150, 600, 153)] if rng.random() < 0.3 else [])) == list(range(len(boxes)))


def merged_by_hand(p):
    p = sorted(map(float, p))
    while True:
        close = [(b - a) * 10 < (a + b) / 2 for a, b in zip(p, p[1:], strict=False)]
        if not any(close):
            return [int(x) for x in p]
        out = []
        for i, x in enumerate(p):
            if i < len(close) and close[i]:
                out.append((x + p[i + 1]) / 2)
            elif i == 0 or not close[i - 1]:
                out.append(x)
        p = out


def test_peaks_merge_to_a_fixpoint(spark):
    rng = random.Random(2)
    lists = [[51, 52, 53, 100, 200, 201], [], [7], [10, 10, 11], list(range(40, 60))] + [sorted(rng.sample(range(5, 120), rng.randrange(1, 12))) for _ in range(60)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lists)], "k int, v array<int>").select("k", T.merged_peaks(F.col("v")).alias("m"))
    assert {r.k: r.m for r in df.collect()} == {k: merged_by_hand(v) for k, v in enumerate(lists)}
    assert merged_by_hand(lists[0]) == [52, 100, 200]


def test_peaks_and_plateaus(spark):
    """Against the definition on random histograms; a flat top counts once, at its middle; ends don't count."""
    rng = random.Random(6)
    pages = {p: [rng.choice([8, 9, 12, 20, 21, 40]) + rng.randrange(3) for _ in range(80)] for p in range(10)}
    pages[20] = [12] * 5 + [20] * 5
    want = {}
    for p, hs in pages.items():
        n = np.bincount(hs).astype(float)
        w = T.half_disc(7)
        s = [round(sum(n[h - i] * w[i + 3] for i in range(-3, 4) if 0 <= h - i < len(n)), 9) for h in range(len(n))]
        found, h = [], 1
        while h < len(s) - 1:
            end = h
            while end + 1 < len(s) and s[end + 1] == s[h]:
                end += 1
            if s[h] > s[h - 1] and end + 1 < len(s) and s[end + 1] < s[h]:
                found.append((h + end) // 2)
            h = end + 1
        want[p] = found
    df = spark.createDataFrame([(p, h) for p, hs in pages.items() for h in hs], "page_id long, height int")
    got = {r.page_id: r.peaks for r in T.peaks(df).collect()}
    assert got == {p: v for p, v in want.items() if v} and any(len(v) > 2 for v in got.values())
    assert T.half_disc(3) == pytest.approx([3**0.5 / 2, 1, 3**0.5 / 2])


def test_font_sizes(spark):
    """Frequent pairs first; pairs with a jump are left out; a pair joins every group whose anchor it holds."""
    peaks = spark.createDataFrame([(1, [9, 12, 16, 30, 40])], "page_id long, peaks array<int>")
    words = spark.createDataFrame([(1, h) for h in [[12, 16, 12, 16, 12], [9, 12, 12], [30, 40, 30, 40], [16, 40, 16], [16, 30, 16], [9, 12]]], "page_id long, heights array<int>")
    got = {(r.a, r.b): r.n for r in T.pairs(words).collect()}
    assert got == {(12, 16): 4, (9, 12): 1, (12, 12): 1, (30, 40): 3, (16, 40): 2, (16, 30): 2}
    assert [r.sizes for r in T.font_sizes(T.pairs(words), peaks).collect()] == [[16, 40]]
    near = spark.createDataFrame([(1, [10, 20], 15), (1, [], 3), (1, [10, 20], 16)], "page_id long, peaks array<int>, h int").select(T.closest(F.col("h"), F.col("peaks")).alias("c"))
    assert [r.c for r in near.collect()] == [10, None, 20]


def flood(grid):
    seen, out = np.zeros(grid.shape, bool), []
    for y, x in zip(*np.nonzero(grid == 0), strict=True):
        if seen[y, x]:
            continue
        todo, cells = [(y, x)], []
        seen[y, x] = True
        while todo:
            b, a = todo.pop()
            cells.append((a, b))
            for d in range(max(0, b - 1), min(grid.shape[0], b + 2)):
                for c in range(max(0, a - 1), min(grid.shape[1], a + 2)):
                    if grid[d, c] == 0 and not seen[d, c]:
                        seen[d, c] = True
                        todo.append((d, c))
        xs, ys = zip(*cells, strict=True)
        out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(cells)))
    return out


def test_components_equal_flood_fill(spark):
    """Random grids of several densities, a spiral, a comb wider than a band, an all-white and an all-black page."""
    rng = np.random.default_rng(4)
    grids = {p: (rng.random((18, 22)) > d).astype(int) * 255 for p, d in enumerate([0.1, 0.3, 0.45, 0.6])}
    spiral = np.full((15, 15), 255)
    x = y = 0
    dx, dy, left, turn = 1, 0, 15, 15
    spiral[0, 0] = 0
    for length in [14, 14, 14, 12, 12, 10, 10, 8, 8, 6, 6, 4, 4, 2, 2]:
        for _ in range(length):
            x, y = x + dx, y + dy
            spiral[y, x] = 0
        dx, dy = -dy, dx
    comb = np.full((4, 400), 255)
    comb[0], comb[1:, ::3] = 0, 0
    grids |= {10: spiral, 11: comb, 12: np.full((3, 4), 255), 13: np.zeros((3, 4), int)}
    rows = spark.createDataFrame([(p, k, r.tolist()) for p, g in grids.items() for k, r in enumerate(g)], "page_id long, y int, row array<int>")
    got = defaultdict(list)
    for r in sorted(map(tuple, P.component_stats(rows).collect())):
        got[r[0]].append(r[1:])
    for p, g in grids.items():
        found = [s for s in got[p] if s[0] > 0]
        assert [s[1:] for s in found] == flood(g) and [s[0] for s in found] == list(range(1, len(found) + 1))
        ys, xs = np.nonzero(g)
        assert [s[1:] for s in got[p] if s[0] == 0] == ([(xs.min(), ys.min(), np.ptp(xs) + 1, np.ptp(ys) + 1, len(xs))] if len(xs) else [])


def test_blur_equals_numpy(spark):
    rng = np.random.default_rng(9)
    images = {1: rng.choice([255, 255, 230, 201, 200, 90, 0], (30, 34, 3)), 2: np.full((25, 25, 3), 255), 3: rng.integers(0, 256, (12, 40, 3))}
    images[1][:, :9] = images[1][:7] = 255
    images[2][12, 12] = [255, 254, 255]
    rows = [(p, x, y, *map(int, im[y, x])) for p, im in images.items() for y in range(im.shape[0]) for x in range(im.shape[1])]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in P.blurred_boundary(spark.createDataFrame(rows, "page_id long, x int, y int, r int, g int, b int")).collect()}
    for p, im in images.items():
        white = (im == 255).all(2)
        padded = np.pad(white, 1, mode="edge")
        edge = white & ~(padded[1:-1, :-2] & padded[1:-1, 2:] & padded[:-2, 1:-1] & padded[2:, 1:-1])
        plain = np.where((im > 200).all(2)[..., None], im.reshape(-1, 3).mean(0).astype(int), im)
        for y in range(im.shape[0]):
            for x in range(im.shape[1]):
                box = np.s_[max(0, y - 10) : y + 11, max(0, x - 10) : x + 11]
                want = plain[box].sum((0, 1)) // 441 if edge[box].any() else plain[y, x]
                assert got[p, x, y] == tuple(int(v) for v in want)


def test_photographs_are_shuffled_once(spark):
    """Pixels lie by pages as the boxes do: one shuffle, of boxes, no join and no windows."""
    plan = lay.q_blurred_boundary(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan


def test_a_page_with_holes_is_refused(spark):
    rows = [(1, x, y, 255, 255, 255) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    with pytest.raises(Exception, match="not each of 3 x 3 once"):
        P.blurred_boundary(spark.createDataFrame(rows, "page_id long, x int, y int, r int, g int, b int")).collect()
