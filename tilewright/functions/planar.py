"""Planar kernels over numpy arrays: clipping, even-odd areas, and unions of polygons, lines and points.

A ring or line is an (n, 2) array, a polygon a list of rings, its shell first. Areas are
even-odd within one polygon, of self-crossing rings too; noding takes such rings apart. Tasks call these on one
part or on the pieces of some cells; Spark deals out the rows.
"""

from __future__ import annotations

import numpy as np

#: Edges up to which all pairs are compared at once.
FEW = 400
#: Pairs of an edge and a slab held at a time.
PAIRS = 1 << 21


# --- clipping --------------------------------------------------------------------------------


def _clip_side(ring: np.ndarray, axis: int, bound: float, above: bool) -> np.ndarray:
    v = ring[:, axis]
    inside = v >= bound if above else v <= bound
    if inside.all():
        return ring
    if not inside.any():
        return ring[:0]
    following = np.roll(ring, -1, axis=0)
    crosses = inside != np.roll(inside, -1)
    step = following[:, axis] - v
    t = np.where(crosses, (bound - v) / np.where(step == 0, 1, step), 0)
    cut = ring + t[:, None] * (following - ring)
    cut[:, axis] = bound
    both = np.stack((ring, cut), axis=1).reshape(-1, 2)
    return both[np.stack((inside, crosses), axis=1).reshape(-1)]


def clip_ring(ring: np.ndarray, box: tuple) -> np.ndarray:
    """A ring cut to a box side by side; pieces stay joined along the box, which changes no area."""
    for axis, bound, above in ((0, box[0], True), (0, box[2], False), (1, box[1], True), (1, box[3], False)):
        if not len(ring):
            break
        ring = _clip_side(ring, axis, bound, above)
    return ring


def clip_many(points: np.ndarray, ring: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """clip_ring for many rings at once: points with the number of their ring, in order, and a box for each ring."""
    for axis, column, above in ((0, 0, True), (0, 2, False), (1, 1, True), (1, 3, False)):
        v, bound = points[:, axis], boxes[ring, column]
        inside = v >= bound if above else v <= bound
        if inside.all():
            continue
        sizes = np.bincount(ring, minlength=len(boxes))
        starts = np.cumsum(sizes) - sizes
        after = np.arange(1, len(points) + 1)
        after[(starts + sizes - 1)[sizes > 0]] = starts[sizes > 0]
        crosses = inside != inside[after]
        k = np.flatnonzero(crosses)
        p, d = points[k], points[after[k]] - points[k]
        cut = p + ((bound[k] - p[:, axis]) / d[:, axis])[:, None] * d
        cut[:, axis] = bound[k]
        counts = inside.astype(np.int64) + crosses
        at = np.cumsum(counts) - counts
        made = np.empty((int(counts.sum()), 2))
        made[at[inside]] = points[inside]
        made[(at + inside)[k]] = cut
        points, ring = made, np.repeat(ring, counts)
    return points, ring


def ring_areas(points: np.ndarray, ring: np.ndarray, n: int) -> np.ndarray:
    """The signed area of each of n rings of points with the number of their ring, in order."""
    sizes = np.bincount(ring, minlength=n)
    starts = np.cumsum(sizes) - sizes
    after = np.arange(1, len(points) + 1)
    after[(starts + sizes - 1)[sizes > 0]] = starts[sizes > 0]
    p = points - points[starts[ring]]
    return np.bincount(ring, p[:, 0] * p[after, 1] - p[after, 0] * p[:, 1], n) / 2


def run_round(points: np.ndarray, ring: np.ndarray, n: int) -> np.ndarray:
    """Which of n rings turn one way throughout and go round once, so that they are simple."""
    sizes = np.bincount(ring, minlength=n)
    starts = np.cumsum(sizes) - sizes
    after = np.arange(1, len(points) + 1)
    after[(starts + sizes - 1)[sizes > 0]] = starts[sizes > 0]
    d = points[after] - points
    turn = d[:, 0] * d[after, 1] - d[:, 1] * d[after, 0]
    largest = np.zeros(n)
    np.maximum.at(largest, ring, np.abs(d).max(axis=1))
    least = 1e-12 * largest[ring] ** 2
    up = d[:, 1] > 0
    one_way = (np.bincount(ring, turn > least, n) == sizes) | (np.bincount(ring, turn < -least, n) == sizes)
    return (sizes >= 3) & one_way & (np.bincount(ring, up != up[after], n) == 2)


def clip_polygon(rings: list[np.ndarray], box: tuple) -> list[np.ndarray]:
    kept = [clip_ring(r, box) for r in rings]
    return [r for r in kept if len(r) >= 3] if len(kept[0]) >= 3 else []


def oriented(rings: list[np.ndarray]) -> list[np.ndarray]:
    """The shell counter-clockwise and the holes clockwise."""
    return [r if (ring_area(r) >= 0) == (i == 0) else r[::-1] for i, r in enumerate(rings)]


def _split_side(rings: list[np.ndarray], axis: int, bound: float, above: bool) -> list[np.ndarray] | None:
    """Oriented rings of the part of a polygon on one side of a line; None where touching points leave the order open.

    The line enters and leaves the polygon by turns, so its crossings, in order, bound the new
    edges two by two.
    """
    whole, chains = [], []
    for ring in rings:
        v = ring[:, axis]
        inside = v > bound if above else v < bound
        if inside.all():
            whole.append(ring)
        elif inside.any():
            begin = int(np.flatnonzero(~inside & np.roll(inside, -1))[0])
            ring, inside = np.roll(ring, -begin, axis=0), np.roll(inside, -begin)
            chain: list | None = None
            for i in range(len(ring)):
                p, q = ring[i], ring[(i + 1) % len(ring)]
                if inside[i]:
                    chain.append(p)
                if inside[i] != inside[(i + 1) % len(ring)]:
                    cut = p + (bound - p[axis]) / (q[axis] - p[axis]) * (q - p)
                    cut[axis] = bound
                    if inside[i]:
                        chains.append([*chain, cut])
                    else:
                        chain = [cut]
    ends = sorted((float(c[at][1 - axis]), at, k) for k, c in enumerate(chains) for at in (0, -1))
    follows = {}
    for i in range(0, len(ends), 2):
        a, b = ends[i], ends[i + 1]
        if a[1] == b[1] and i + 2 < len(ends) and ends[i + 2][0] == b[0]:
            ends[i + 1], ends[i + 2] = ends[i + 2], ends[i + 1]
            b = ends[i + 1]
        if a[1] == b[1]:
            return None
        leaves, enters = (a, b) if a[1] == -1 else (b, a)
        follows[leaves[2]] = enters[2]
    while follows:
        first, ring = next(iter(follows)), []
        k = first
        while k in follows:
            ring += chains[k]
            k = follows.pop(k)
        whole.append(np.array(ring))
    return whole


def split_polygon(rings: list[np.ndarray], box: tuple) -> list[list[np.ndarray]]:
    """The polygons of which the part of a polygon within a box consists, each with its holes.

    Where touching points leave it open what belongs together, pieces stay joined along the box.
    """
    found: list[np.ndarray] | None = oriented(rings)
    for axis, bound, above in ((0, box[0], True), (0, box[2], False), (1, box[1], True), (1, box[3], False)):
        found = _split_side(found, axis, bound, above)
        if found is None:
            joined = clip_polygon(rings, box)
            return [joined] if joined else []
    least = 1e-15 * max([abs(ring_area(r)) for r in rings], default=0)
    shells = [[r] for r in found if ring_area(r) > least]
    for hole in (r for r in found if ring_area(r) < -least):
        home = min((s for s in shells if holds(s[0], tuple(hole[0]))), key=lambda s: ring_area(s[0]), default=None)
        if home is not None:
            home.append(hole)
    return shells


def clip_band(rings: list[np.ndarray], axis: int, low: float, high: float) -> list[np.ndarray]:
    """A polygon between two lines across an axis; without its shell nothing is left."""
    kept = []
    for i, ring in enumerate(rings):
        v = ring[:, axis]
        if v.min() < low:
            ring = _clip_side(ring, axis, low, True)
        if len(ring) and v.max() > high:
            ring = _clip_side(ring, axis, high, False)
        if len(ring) >= 3:
            kept.append(ring)
        elif i == 0:
            return []
    return kept


def clip_line(line: np.ndarray, box: tuple) -> np.ndarray:
    """(m, 4) segments x1, y1, x2, y2 of a line within a box, its border included; none without length."""
    a, b = line[:-1], line[1:]
    d = b - a
    low, high = np.zeros(len(a)), np.ones(len(a))
    for axis, least, most in ((0, box[0], box[2]), (1, box[1], box[3])):
        v, s = a[:, axis], d[:, axis]
        flat = s == 0
        with np.errstate(divide="ignore", invalid="ignore"):
            p, q = (least - v) / s, (most - v) / s
        low = np.where(flat, low, np.maximum(low, np.minimum(p, q)))
        high = np.where(flat, np.where((v < least) | (v > most), -1.0, high), np.minimum(high, np.maximum(p, q)))
    keep = high > low
    return np.hstack((a[keep] + low[keep, None] * d[keep], np.where(high[keep, None] == 1, b[keep], a[keep] + high[keep, None] * d[keep])))


def clip_half(ring: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A ring's part to the left of the line p -> q; pieces stay joined along it."""
    d = q - p
    v = d[0] * (ring[:, 1] - p[1]) - d[1] * (ring[:, 0] - p[0])
    inside = v >= 0
    if inside.all():
        return ring
    if not inside.any():
        return ring[:0]
    after, crosses = np.roll(v, -1), inside != np.roll(inside, -1)
    t = np.where(crosses, v / np.where(v == after, 1, v - after), 0)
    cut = ring + t[:, None] * (np.roll(ring, -1, axis=0) - ring)
    return np.stack((ring, cut), axis=1).reshape(-1, 2)[np.stack((inside, crosses), axis=1).reshape(-1)]


def clip_convex(rings: list[np.ndarray], cell: np.ndarray) -> list[np.ndarray]:
    """A polygon's part within a convex ring that runs counter-clockwise; without its shell nothing is left."""
    kept = []
    for k, ring in enumerate(rings):
        for p, q in zip(cell, np.roll(cell, -1, axis=0)):
            if len(ring):
                ring = clip_half(ring, p, q)
        if len(ring) >= 3:
            kept.append(ring)
        elif k == 0:
            return []
    return kept


def clip_many_convex(points: np.ndarray, ring: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """clip_half by all sides of a convex ring for many rings at once: points with the number of their ring, in order, and for each ring its cell's sides (m, 4): a corner and the way to the next, 0 for none."""
    for k in range(sides.shape[1]):
        at = sides[ring, k]
        v = at[:, 2] * (points[:, 1] - at[:, 1]) - at[:, 3] * (points[:, 0] - at[:, 0])
        inside = v >= 0
        if inside.all():
            continue
        sizes = np.bincount(ring, minlength=len(sides))
        starts = np.cumsum(sizes) - sizes
        after = np.arange(1, len(points) + 1)
        after[(starts + sizes - 1)[sizes > 0]] = starts[sizes > 0]
        crosses = inside != inside[after]
        i = np.flatnonzero(crosses)
        cut = points[i] + (v[i] / (v[i] - v[after[i]]))[:, None] * (points[after[i]] - points[i])
        counts = inside.astype(np.int64) + crosses
        place = np.cumsum(counts) - counts
        made = np.empty((int(counts.sum()), 2))
        made[place[inside]] = points[inside]
        made[(place + inside)[i]] = cut
        points, ring = made, np.repeat(ring, counts)
    return points, ring


def clip_line_convex(line: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """(m, 4) segments of a line within a convex ring that runs counter-clockwise, its border included; none without length."""
    a, b = line[:-1], line[1:]
    low, high = np.zeros(len(a)), np.ones(len(a))
    for p, q in zip(cell, np.roll(cell, -1, axis=0)):
        d = q - p
        u, v = (d[0] * (x[:, 1] - p[1]) - d[1] * (x[:, 0] - p[0]) for x in (a, b))
        with np.errstate(divide="ignore", invalid="ignore"):
            t = u / (u - v)
        low = np.where((u < 0) & (v >= 0), np.maximum(low, t), low)
        high = np.where((u >= 0) & (v < 0), np.minimum(high, t), high)
        high = np.where((u < 0) & (v < 0), -1.0, high)
    keep = high > low
    d = b - a
    return np.hstack((a[keep] + low[keep, None] * d[keep], np.where(high[keep, None] == 1, b[keep], a[keep] + high[keep, None] * d[keep])))


def in_convex(points: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Which points lie within a convex ring that runs counter-clockwise, its border included."""
    d = np.roll(cell, -1, axis=0) - cell
    return ((d[:, 0] * (points[:, None, 1] - cell[:, 1]) - d[:, 1] * (points[:, None, 0] - cell[:, 0])) >= 0).all(axis=1)


def convex(ring: np.ndarray) -> np.ndarray:
    """The ring counter-clockwise; raises if it is not convex."""
    ring = ring if ring_area(ring) >= 0 else ring[::-1]
    d = np.roll(ring, -1, axis=0) - ring
    f = np.roll(d, -1, axis=0)
    turns = d[:, 0] * f[:, 1] - d[:, 1] * f[:, 0]
    way = np.unwrap(np.arctan2(d[:, 1], d[:, 0]))
    if len(ring) < 3 or ring_area(ring) == 0 or (turns < -1e-12 * np.abs(d).max() ** 2).any() or way[-1] - way[0] > 2 * np.pi + 1e-9:
        raise ValueError("a cell must be a convex polygon")
    return ring


# --- areas -----------------------------------------------------------------------------------


def ring_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y)) / 2


def holds(ring: np.ndarray, point: tuple) -> bool:
    """Whether a point lies within a ring (on its border: either)."""
    x, y = point
    following = np.roll(ring, -1, axis=0)
    across = (ring[:, 1] > y) != (following[:, 1] > y)
    a, b = ring[across], following[across]
    return bool(np.count_nonzero(x < a[:, 0] + (y - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0])) % 2)


def edges_of(rings: list[np.ndarray]) -> np.ndarray:
    """(n, 4) edges from left to right, without vertical ones."""
    e = np.vstack([np.hstack((r, np.roll(r, -1, axis=0))) for r in rings])
    e = e[e[:, 0] != e[:, 2]]
    back = e[:, 0] > e[:, 2]
    e[back] = e[back][:, [2, 3, 0, 1]]
    return e


def crossings(e: np.ndarray, depth: int = 0) -> np.ndarray:
    """x of all places where two edges cross within both."""
    if len(e) < 2:
        return np.zeros(0)
    if len(e) > FEW and depth < 40:  # halves by turns in x and y; edges over the middle go to both
        low, high = (e[:, 0], e[:, 2]) if depth % 2 == 0 else (np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3]))
        middle = np.median((low + high) / 2)
        first, second = e[low <= middle], e[high >= middle]
        if max(len(first), len(second)) < 0.9 * len(e):
            return np.concatenate((crossings(first, depth + 1), crossings(second, depth + 1)))
        if depth % 2 == 0:
            return crossings(e, depth + 1)
    found = []
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    for lo in range(0, len(e), FEW):
        i = slice(lo, lo + FEW)
        ex, ey = e[None, :, 0] - e[i, None, 0], e[None, :, 1] - e[i, None, 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            den = dx[i, None] * dy[None] - dy[i, None] * dx[None]
            t = (ex * dy[None] - ey * dx[None]) / den
            s = (ex * dy[i, None] - ey * dx[i, None]) / den
            a, b = np.nonzero((den != 0) & (t > 0) & (t < 1) & (s > 0) & (s < 1))
        found.append(e[i][a, 0] + t[a, b] * dx[i][a])
    return np.concatenate(found)


def _crossings_by_key(e: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, x) of all places where two edges of one key cross within both; first and last rank the edges' ends by key and x."""
    order = np.argsort(first, kind="stable")
    begin = first[order]
    more = np.maximum(0, np.searchsorted(begin, last[order], "left") - np.arange(len(order)) - 1)
    keys, xs, lo, total = [], [], 0, np.concatenate(([0], np.cumsum(more)))
    while lo < len(order):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PAIRS, "right")) - 1)
        n = more[lo:hi]
        i = np.repeat(np.arange(lo, hi), n)
        j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p, q = e[order[i]], e[order[j]]
        near = (np.minimum(p[:, 1], p[:, 3]) <= np.maximum(q[:, 1], q[:, 3])) & (np.maximum(p[:, 1], p[:, 3]) >= np.minimum(q[:, 1], q[:, 3]))
        p, q, i = p[near], q[near], i[near]
        d, f, g = p[:, 2:] - p[:, :2], q[:, 2:] - q[:, :2], q[:, :2] - p[:, :2]
        with np.errstate(divide="ignore", invalid="ignore"):
            den = d[:, 0] * f[:, 1] - d[:, 1] * f[:, 0]
            t, s = (g[:, 0] * f[:, 1] - g[:, 1] * f[:, 0]) / den, (g[:, 0] * d[:, 1] - g[:, 1] * d[:, 0]) / den
            hit = (den != 0) & (t > 0) & (t < 1) & (s > 0) & (s < 1)
        keys.append(key[order[i[hit]]])
        xs.append(p[hit, 0] + t[hit] * d[hit, 0])
        lo = hi
    return np.concatenate([*keys, np.zeros(0, int)]), np.concatenate([*xs, np.zeros(0)])


def covered_areas(groups: list[list[list[np.ndarray]]], at_least: int = 1) -> np.ndarray:
    """For each group of polygons the area that lies in at least so many of them: 1 gives the union, the group's size the intersection.

    Vertical slabs between all ends and crossings of edges of a group; within a slab no two
    edges cross, so their order along the middle line holds throughout and trapezoids add up
    exactly. An edge meets only the slabs under it. All groups are swept at once, in runs of
    slabs of bounded size.
    """
    totals = np.zeros(len(groups))
    polygons = [(g, p) for g, some in enumerate(groups) for p in some if p]
    rings = [r for _, p in polygons for r in p]
    if not rings:
        return totals
    sizes = np.array([len(r) for r in rings])
    owner = np.repeat(np.repeat(np.arange(len(polygons)), [len(p) for _, p in polygons]), sizes)
    points, starts = np.vstack(rings), np.cumsum(sizes) - sizes
    after = np.arange(1, len(points) + 1)
    after[(starts + sizes - 1)[sizes > 0]] = starts[sizes > 0]
    e = np.hstack((points, points[after]))
    level = e[:, 0] != e[:, 2]
    e, owner = e[level], owner[level]
    if not len(e):
        return totals
    back = e[:, 0] > e[:, 2]
    e[back] = e[back][:, [2, 3, 0, 1]]
    key = np.array([g for g, _ in polygons])[owner]

    def ranked(x: np.ndarray, of: np.ndarray):
        order = np.lexsort((x, of))
        x, of = x[order], of[order]
        new = np.concatenate(([True], (x[1:] != x[:-1]) | (of[1:] != of[:-1])))
        rank = np.empty(len(x), np.int64)
        rank[order] = np.cumsum(new) - 1
        return rank, x[new], of[new]

    n = len(e)
    rank, _, _ = ranked(np.concatenate((e[:, 0], e[:, 2])), np.concatenate((key, key)))
    many = np.bincount(key, minlength=len(groups))
    few = many[key] <= FEW
    at, cut = _crossings_by_key(e[few], key[few], rank[:n][few], rank[n:][few])
    for g in np.flatnonzero(many > FEW):
        found = crossings(e[key == g])
        at, cut = np.concatenate((at, np.full(len(found), g))), np.concatenate((cut, found))
    rank, xs, of = ranked(np.concatenate((e[:, 0], e[:, 2], cut)), np.concatenate((key, key, at)))
    first, last = rank[:n], rank[n : 2 * n]
    load = np.cumsum(np.bincount(first, minlength=len(xs)) - np.bincount(last, minlength=len(xs)))
    lo = 0
    while lo < len(xs) - 1:
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(load[lo:-1]), PAIRS, "right")) + lo)
        here = np.flatnonzero((first < hi) & (last > lo))
        begin, end = np.maximum(first[here], lo), np.minimum(last[here], hi)
        n = end - begin
        edge = np.repeat(here, n)
        slab = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
        middle = (xs[slab] + xs[slab + 1]) / 2
        k = e[edge]
        y = k[:, 1] + (middle - k[:, 0]) / (k[:, 2] - k[:, 0]) * (k[:, 3] - k[:, 1])
        who = owner[edge]
        order = np.lexsort((y, who, slab))  # within a slab and polygon, edges enter and leave by turns
        new = np.ones(len(order), bool)
        new[1:] = (slab[order][1:] != slab[order][:-1]) | (who[order][1:] != who[order][:-1])
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        step = np.empty(len(order), np.int64)
        step[order] = np.where(place % 2 == 0, 1, -1)
        order = np.lexsort((y, slab))
        depth, slab, y = np.cumsum(step[order]), slab[order], y[order]
        inner = np.flatnonzero((slab[1:] == slab[:-1]) & (depth[:-1] >= at_least))
        totals += np.bincount(of[slab[inner]], (y[inner + 1] - y[inner]) * (xs[slab[inner] + 1] - xs[slab[inner]]), len(groups))
        lo = hi
    return totals


def covered_area(polygons: list[list[np.ndarray]], at_least: int = 1) -> float:
    """covered_areas of one group."""
    return float(covered_areas([polygons], at_least)[0])


def boxes_area(b: np.ndarray):
    """Area that boxes (n, 4: x1, y1, x2, y2) cover together, in their own kind of number.

    Between neighbouring x a box counts +1 at its bottom and -1 at its top; sorted, their running
    sum tells what is covered.
    """
    b = np.unique(b, axis=0)
    b = b[(b[:, 2] > b[:, 0]) & (b[:, 3] > b[:, 1])]
    xs = np.unique(b[:, [0, 2]])
    first, last = np.searchsorted(xs, b[:, 0]), np.searchsorted(xs, b[:, 2])
    load = np.cumsum(np.bincount(first, minlength=len(xs)) - np.bincount(last, minlength=len(xs)))
    total, lo = b.dtype.type(0), 0
    while lo < len(xs) - 1:
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(load[lo:-1]), PAIRS, "right")) + lo)
        here = np.flatnonzero((first < hi) & (last > lo))
        begin = np.maximum(first[here], lo)
        n = np.minimum(last[here], hi) - begin
        box = np.repeat(here, n)
        slab = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
        y, slab = np.concatenate((b[box, 1], b[box, 3])), np.concatenate((slab, slab))
        step = np.repeat([1, -1], len(box))
        order = np.lexsort((-step, y, slab))
        y, slab, depth = y[order], slab[order], np.cumsum(step[order])
        inner = depth[:-1] > 0
        total += ((y[1:] - y[:-1])[inner] * (xs[slab + 1] - xs[slab])[:-1][inner]).sum()
        lo = hi
    return total


def _runs_round(ring: np.ndarray) -> bool:
    """Whether a ring turns one way throughout and goes round once."""
    d = np.empty_like(ring)
    d[:-1], d[-1] = ring[1:] - ring[:-1], ring[0] - ring[-1]
    x, y = d[:, 0], d[:, 1]
    turn = x * np.roll(y, -1) - y * np.roll(x, -1)
    least = 1e-12 * float(np.abs(d).max()) ** 2
    if not ((turn > least).all() or (turn < -least).all()):
        return False
    up = y > 0
    return int(np.count_nonzero(up != np.roll(up, -1))) == 2


def is_simple(rings: list[np.ndarray]) -> bool:
    """Whether it is certain that edges of a polygon meet at the corners they share and nowhere else, so that its area is that of its shell less its holes.

    Touching rings, repeated corners and whatever round-off leaves open count as not simple.
    """
    if len(rings) == 1 and (len(rings[0]) <= 3 or _runs_round(rings[0])):
        return True
    rings = [r[(r != np.roll(r, -1, axis=0)).any(axis=1)] for r in rings]
    if any(len(r) < 3 for r in rings):
        return False
    a, b = np.vstack(rings), np.vstack([np.roll(r, -1, axis=0) for r in rings])
    starts = np.cumsum([0, *map(len, rings)])
    after = np.arange(1, len(a) + 1)
    after[starts[1:] - 1] = starts[:-1]
    box = np.hstack((np.minimum(a, b), np.maximum(a, b)))
    if len(a) <= FEW:
        i, j = np.triu_indices(len(a), 1)
        near = (box[i, 0] <= box[j, 2]) & (box[i, 2] >= box[j, 0]) & (box[i, 1] <= box[j, 3]) & (box[i, 3] >= box[j, 1])
    else:
        from .noding import meeting

        i, j = meeting(box, box)
        near = i < j
    i, j = i[near], j[near]
    turn = lambda p, q, r: (q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0])
    least = 1e-14 * float(np.ptp(a, axis=0).max()) * float(np.abs(a).max())
    next_ = (after[i] == j) | (after[j] == i)
    apart = lambda x, y: (x > least) & (y > least) | (x < -least) & (y < -least)
    clear = apart(turn(a[i], b[i], a[j]), turn(a[i], b[i], b[j])) | apart(turn(a[j], b[j], a[i]), turn(a[j], b[j], b[i]))
    if not (clear | next_).all():
        return False
    i, j = i[next_], j[next_]
    d, f = b[i] - a[i], b[j] - a[j]
    back = (np.abs(d[:, 0] * f[:, 1] - d[:, 1] * f[:, 0]) <= least) & ((d * f).sum(axis=1) <= 0)
    return not back.any()


def polygon_area(rings: list[np.ndarray], simple: bool = False) -> float:
    if not rings:
        return 0.0
    if simple:
        return max(0.0, abs(ring_area(rings[0])) - sum(abs(ring_area(r)) for r in rings[1:]))
    return covered_area([rings])


# --- unions of lines and points --------------------------------------------------------------


def merged_segments(s: np.ndarray, digits: int = 9) -> np.ndarray:
    """(m, 4) segments that cover what s covers, each place once.

    Segments on one line (equal direction and distance from the middle of all, to so many
    digits) are merged along it; others share at most points. Parallel lines that lie closer
    than 10**-digits of the extent are taken for one.
    """
    if len(s) < 2:
        return s
    middle = (s[:, :2].mean(axis=0) + s[:, 2:].mean(axis=0)) / 2
    a, b = s[:, :2] - middle, s[:, 2:] - middle
    d = b - a
    length = np.hypot(d[:, 0], d[:, 1])
    a, b, d, length = a[length > 0], b[length > 0], d[length > 0], length[length > 0]
    back = (d[:, 0] < 0) | ((d[:, 0] == 0) & (d[:, 1] < 0))
    a[back], b[back], d[back] = b[back].copy(), a[back].copy(), -d[back]
    u = d / length[:, None]
    away = u[:, 0] * a[:, 1] - u[:, 1] * a[:, 0]
    scale = max(1e-300, np.abs(np.concatenate((a, b))).max())
    begin, end = np.sum(a * u, axis=1), np.sum(b * u, axis=1)
    line = np.round(np.column_stack((u, away / scale)), digits) + 0.0
    _, line = np.unique(line, axis=0, return_inverse=True)
    line = line.reshape(-1)
    order = np.lexsort((end, begin, line))
    kept: list[list] = []
    for i in order.tolist():
        if kept and kept[-1][0] == line[i] and begin[i] <= kept[-1][2]:
            if end[i] > kept[-1][2]:
                kept[-1][2], kept[-1][4] = end[i], b[i]
        else:
            kept.append([line[i], begin[i], end[i], a[i], b[i]])
    return np.array([[*(k[3] + middle), *(k[4] + middle)] for k in kept])


def distinct_points(p: np.ndarray) -> np.ndarray:
    return np.unique(p + 0.0, axis=0)


def simplified(line: np.ndarray, tolerance: float) -> np.ndarray:
    """The points of a line that keep it within tolerance of itself (Douglas and Peucker); its ends stay."""
    keep, todo = np.zeros(len(line), bool), [(0, len(line) - 1)]
    keep[[0, -1]] = True
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d, q = line[b] - line[a], line[a + 1 : b] - line[a]
        size = float(np.hypot(*d))
        t = np.clip(q @ d / size**2, 0, 1) if size else np.zeros(len(q))
        away = np.hypot(*(q - t[:, None] * d).T)
        k = int(away.argmax())
        if away[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return line[keep]
