"""Plain Python models of the operators, for small inputs."""

from __future__ import annotations

from collections import Counter

from starloom.functions.geometry import Box


def box_of(points):
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return Box(min(xs), max(xs), min(ys), max(ys))


def children(rect):
    x0, x1, y0, y1 = rect
    mx, my = (x0 + x1) / 2, (y0 + y1) / 2
    return [(x0, mx, y0, my), (mx, x1, y0, my), (mx, x1, my, y1), (x0, mx, my, y1)]


def holds(rect, point):
    return rect[0] <= point[0] <= rect[1] and rect[2] <= point[1] <= rect[3]


def descend(point, rect, depth):
    """Path of a point: the first closed child that holds it, ``depth`` times."""
    path = "_"
    for _ in range(depth):
        kids = children(rect)
        digit = next(i for i, kid in enumerate(kids) if holds(kid, point))
        path, rect = path + str(digit), kids[digit]
    return path


def leaf_counts(points, threshold, max_depth, max_heavy=None):
    """Round by round: count, find heavy cells, move their points one level down."""
    box = box_of(points)
    cells = ["_"] * len(points)
    for depth in range(max_depth):
        counts = Counter(cells)
        heavy = {c for c, n in counts.items() if n > threshold}
        if not heavy or (max_heavy is not None and len(heavy) > max_heavy):
            break
        cells = [descend(p, box, depth + 1) if c in heavy else c for p, c in zip(points, cells)]
    return cells


def merge_rule(cells, minimum):
    """Keep repairing the leftmost group that is too small."""
    groups = [((cell,), n) for cell, n in sorted(cells)]
    while len(groups) > 1:
        small = next((k for k, (_, n) in enumerate(groups) if n < minimum), None)
        if small is None:
            break
        has_left, has_right = small > 0, small + 1 < len(groups)
        to_left = has_left and (not has_right or groups[small - 1][1] < groups[small + 1][1])
        at = small - 1 if to_left else small
        (a, m), (b, n) = groups[at], groups[at + 1]
        groups[at : at + 2] = [(a + b, m + n)]
    return groups
