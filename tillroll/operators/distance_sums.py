"""Sums of Euclidean distances between all points of two groups, to the rounding of their own addition.

The points of a group are halved on the widest axis of their box until a box holds at most ``leaf``
points. Two boxes meet in one of two ways. Near ones bring all pairs of their points together. Between
boxes far enough apart the distance is so smooth that polynomials meet it to ``FAR`` of itself for each
axis at the worst place of the worst pair, and the sums to their own rounding (measured: 2e-15 of a sum):
each box's points are weighed into a grid of Chebyshev nodes, the grids meet as if they were points, and
what a grid's nodes feel is read off at its points. How far is far follows from the boxes alone, axis by axis (``LEAST``), so no pair is left
out, and the number of points decides only which of the two ways is cheaper.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What the polynomial of one axis may be off at most, as a share of the distance.
FAR = 1e-12
#: Nodes of a grid along an axis, and the least distance at which so many do, in half widths of the box:
#: where the worst direction's error, in 80-bit numbers, is ``FAR``. A distance along one axis is
#: sqrt((t - a)**2 + b**2), and as a share of its size the error falls with the distance of (a, b).
LEAST = {
    4: 353.6, 6: 35.4, 8: 11.5, 10: 5.91, 12: 3.83, 14: 2.84, 16: 2.3, 18: 1.97, 20: 1.75, 24: 1.48,
}
#: Squared distances come from one product of matrices; those below this share of the greatest square
#: lose digits there and are taken from differences.
CLOSE = 1e-3
#: Rows and columns of distances made at a time, to stay in a core's cache.
ROWS, COLUMNS = 64, 1024
#: What making and reading a grid takes a point for each node, in pairs.
READ = 0.2
#: Bytes of grids that a task keeps before it reads them off.
KEPT = 1 << 26
#: Points weighed into a grid, or read off one, at a time.
POINTS = 512
#: Up to so many labels, sums by label are a product with their weights.
FEW_LABELS = 16


class Box:
    """Points ``first`` to ``last`` of a group, their box, and the halves if it has been halved."""

    __slots__ = ("first", "half", "halves", "high", "labels", "last", "low", "middle")

    def __init__(self, first: int, last: int, low: np.ndarray, high: np.ndarray):
        self.first, self.last, self.halves, self.labels = first, last, (), None
        self.low, self.high = low.tolist(), high.tolist()
        self.middle = [a / 2 + b / 2 for a, b in zip(self.low, self.high, strict=True)]
        # From the rounded middle, so that it reaches both ends.
        self.half = [max(b - m, m - a) for a, b, m in zip(self.low, self.high, self.middle, strict=True)]

    def __len__(self) -> int:
        return self.last - self.first


class Group:
    """Points with labels, as numbers from 0 (-1 for none), and the sums found for them.

    ``order`` has the place that each point came in; all else is in the order of the boxes. A box's
    weights on a grid are kept, as is what a grid feels, until ``sums``.
    """

    def __init__(self, points: np.ndarray, marks: np.ndarray, labels: int, leaf: int):
        self.labels, self.leaf = labels, leaf
        self.order = np.arange(len(points))
        self.boxes: list[Box] = []
        whole = np.isfinite(points).all(axis=1)
        fine, odd = np.flatnonzero(whole), np.flatnonzero(~whole)
        self.order = np.concatenate([fine, odd])
        if len(fine):
            self.boxes.append(self._box(points, 0, len(fine)))
        # Points without a place meet all others one by one.
        for a in range(len(fine), len(points), leaf):
            b = min(a + leaf, len(points))
            nowhere = np.full(points.shape[1], np.nan)
            self.boxes.append(Box(a, b, nowhere, nowhere))
        self.points, self.marks = points[self.order], marks[self.order]
        self.total = np.zeros((len(points), labels))
        self._grids: dict = {}
        self.kept = 0

    def _box(self, points: np.ndarray, first: int, last: int) -> Box:
        own = points[self.order[first:last]]
        box = Box(first, last, own.min(axis=0), own.max(axis=0))
        if len(box) > self.leaf:
            axis = int(np.argmax(box.half))
            middle = len(box) // 2
            self.order[first:last] = self.order[first:last][np.argpartition(own[:, axis], middle)]
            box.halves = tuple(self._box(points, a, b) for a, b in ((first, first + middle), (first + middle, last)))
        return box

    def labels_of(self, box: Box) -> np.ndarray:
        """The labels of a box's points."""
        if box.labels is None:
            box.labels = np.unique(self.marks[box.first : box.last])
            box.labels = box.labels[box.labels >= 0]
        return box.labels

    def weights(self, box: Box) -> np.ndarray:
        """A row for each point, with a one at its label; a column for each label of the box."""
        return (self.marks[box.first : box.last, None] == self.labels_of(box)).astype(float)

    def grid(self, box: Box, counts: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nodes of a grid over a box, the weights of the box's labels there, and what is felt so far."""
        found = self._grids.get((box.first, box.last, counts))
        if found is None:
            turn = _turn(counts)
            axes = [box.middle[i] + box.half[i] * _nodes(counts[i]) for i in turn]
            nodes = np.empty((math.prod(counts), len(counts)))
            nodes[:, turn] = np.stack([x.ravel() for x in np.meshgrid(*axes, indexing="ij")], axis=1)
            labels = self.labels_of(box)
            weight = np.zeros((len(labels), len(nodes) // max(counts), max(counts)))
            for label, sums in zip(labels, weight, strict=True):
                own = box.first + np.flatnonzero(self.marks[box.first : box.last] == label)
                for a in range(0, len(own), POINTS):
                    rest, along = self._shares(box, counts, own[a : a + POINTS])
                    sums += rest.T @ along
            weight = np.ascontiguousarray(weight.reshape(len(labels), len(nodes)).T)
            felt = np.zeros((len(nodes), self.labels))
            found = self._grids[box.first, box.last, counts] = (nodes, weight, felt, box)
            self.kept += nodes.nbytes + weight.nbytes + felt.nbytes
        return found[:3]

    def _shares(self, box: Box, counts: tuple[int, ...], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each point has of each node: of all axes but the longest together, and of the longest."""
        own = self.points[places]
        by_axis = [
            _lagrange((own[:, i] - box.middle[i]) / (box.half[i] or 1.0), counts[i]) for i in _turn(counts)
        ]
        rest = np.ones((len(own), 1))
        for one in by_axis[:-1]:
            rest = (rest[:, :, None] * one[:, None, :]).reshape(len(own), -1)
        return rest, by_axis[-1]

    def read_grids(self) -> None:
        """Add to each point's sums what the grids over it have felt, and let the grids go."""
        for (_, _, counts), (_, _, felt, box) in self._grids.items():
            labels = np.flatnonzero(felt.any(axis=0))
            across = felt[:, labels].reshape(len(felt) // max(counts), max(counts) * len(labels))
            for a in range(box.first, box.last, POINTS):
                some = np.arange(a, min(a + POINTS, box.last))
                rest, along = self._shares(box, counts, some)
                read = (rest @ across).reshape(len(some), max(counts), len(labels))
                self.total[a : a + len(some), labels] += np.einsum("pnl,pn->pl", read, along)
        self._grids.clear()
        self.kept = 0

    def sums(self) -> np.ndarray:
        """For each point, in the order they came, its sum of distances to each label's points."""
        self.read_grids()
        out = np.empty_like(self.total)
        out[self.order] = self.total
        return out


def _turn(counts: Sequence[int]) -> list[int]:
    """The axes, the one with most nodes last."""
    return sorted(range(len(counts)), key=counts.__getitem__)


def _nodes(n: int) -> np.ndarray:
    return np.cos((2 * np.arange(n) + 1) * (math.pi / (2 * n)))


def _lagrange(t: np.ndarray, n: int) -> np.ndarray:
    """The value at ``t``, from -1 to 1, of the polynomial that is one at each node and zero at the others."""
    if n == 1:
        return np.ones((len(t), 1))
    away = t[:, None] - _nodes(n)
    hit = away == 0
    away[hit] = 1.0
    share = (-1.0) ** np.arange(n) * np.sin((2 * np.arange(n) + 1) * (math.pi / (2 * n))) / away
    on = hit.any(axis=1)
    share[on] = hit[on]
    return share / share.sum(axis=1, keepdims=True)


def meet(left: Group, right: Group) -> None:
    """Add to each group's sums the distances to the points of the other, or of itself."""
    pairs = [(a, b) for a in left.boxes for b in right.boxes]
    if left is right:
        pairs = [(a, b) for i, a in enumerate(left.boxes) for b in left.boxes[i:]]
    while pairs:
        a, b = pairs.pop()
        grids = _grids_between(a, b, left.labels)
        if grids is not None and a is not b:
            mine, weight, felt = left.grid(a, grids[0])
            others, other_weight, other_felt = right.grid(b, grids[1])
            here, there = _weighted(mine, weight, others, other_weight)
            felt[:, right.labels_of(b)] += here
            other_felt[:, left.labels_of(a)] += there
            for group in (left, right):
                if group.kept > KEPT:
                    group.read_grids()
        elif a is b and a.halves:
            one, other = a.halves
            pairs += [(one, one), (one, other), (other, other)]
        elif a.halves and (len(a) >= len(b) or not b.halves):
            pairs += [(half, b) for half in a.halves]
        elif b.halves:
            pairs += [(a, half) for half in b.halves]
        else:
            _meet_points(left, a, right, b)


def _plain(a: Box, b: Box) -> bool:
    """Whether all distances are numbers, which an infinite one by a weight of zero is not."""
    if math.isnan(a.low[0]) or math.isnan(b.low[0]):
        return False
    span = [max(ah, bh) - min(al, bl) for al, ah, bl, bh in zip(a.low, a.high, b.low, b.high, strict=True)]
    return sum(x * x for x in span) < math.inf


def _grids_between(a: Box, b: Box, labels: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """How many nodes each axis of each box's grid needs, if grids do and cost less than all pairs."""
    apart = [max(0.0, al - bh, bl - ah) for al, ah, bl, bh in zip(a.low, a.high, b.low, b.high, strict=True)]
    square = sum(x * x for x in apart)
    if not _plain(a, b):
        return None
    counts, sizes = [], []
    for box, other in ((a, b), (b, a)):
        own, size = [], 1
        for i, half in enumerate(box.half):
            if half == 0:
                own.append(1)
                continue
            # From the other box to this one's slice through the middle of the axis.
            middle = box.middle[i]
            along = max(0.0, other.low[i] - middle, middle - other.high[i])
            reach = math.sqrt(max(0.0, square - apart[i] * apart[i]) + along * along) / half
            n = next((n for n, least in LEAST.items() if reach >= least), 0)
            if not n:
                return None
            own.append(n)
            size *= n
        counts.append(tuple(own))
        sizes.append(size)
    # Making and reading a grid takes a point about a fifth of a pair for each node, once for many meetings.
    work = sizes[0] * sizes[1] * (1 + labels / 8) + (len(a) * sizes[0] + len(b) * sizes[1]) * READ
    return (counts[0], counts[1]) if work < len(a) * len(b) else None


def _meet_points(left: Group, a: Box, right: Group, b: Box) -> None:
    mine, others = left.points[a.first : a.last], right.points[b.first : b.last]
    total = left.total[a.first : a.last]
    other_total = None if a is b else right.total[b.first : b.last]
    if _plain(a, b) and max(len(left.labels_of(a)), len(right.labels_of(b))) <= FEW_LABELS:
        here, there = _weighted(mine, None if a is b else left.weights(a), others, right.weights(b))
        total[:, right.labels_of(b)] += here
        if other_total is not None:
            other_total[:, left.labels_of(a)] += there
        return
    # Label by label in turn, where weights would be mostly zeros.
    one, ones, firsts = _runs(left.marks[a.first : a.last])
    two, twos, seconds = _runs(right.marks[b.first : b.last])
    for rows, columns, away in _distances(mine[one], others[two]):
        known, starts, labels = _runs_within(seconds, twos, columns)
        if len(starts):
            total[one[rows, None], labels] += np.add.reduceat(away[:, known:], starts, axis=1)
        if other_total is not None:
            known, starts, labels = _runs_within(firsts, ones, rows)
            if len(starts):
                other_total[two[columns, None], labels] += np.add.reduceat(away[known:], starts, axis=0).T


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by label, the labels there are, and where each begins."""
    order = np.argsort(marks, kind="stable")
    labels, firsts = np.unique(marks[order], return_index=True)
    return order, labels, firsts


def _runs_within(firsts: np.ndarray, labels: np.ndarray, part: slice) -> tuple[int, np.ndarray, np.ndarray]:
    """Of ``part``: where points with a label begin, their runs from there, the labels."""
    a, b = part.start, part.stop
    some = np.arange(np.searchsorted(firsts, a, "right") - 1, np.searchsorted(firsts, b))
    some = some[labels[some] >= 0]
    starts = np.maximum(firsts[some], a) - a
    known = int(starts[0]) if len(starts) else b - a
    return known, starts - known, labels[some]


def _weighted(mine, weight, others, other_weight) -> tuple[np.ndarray, np.ndarray | None]:
    """What either side feels of the other's weights; nothing for the second without the first's."""
    here = np.zeros((len(mine), other_weight.shape[1]))
    there = None if weight is None else np.zeros((len(others), weight.shape[1]))
    for rows, columns, away in _distances(mine, others):
        here[rows] += away @ other_weight[columns]
        if there is not None:
            there[columns] += away.T @ weight[rows]
    return here, there


def _distances(mine: np.ndarray, others: np.ndarray):
    """Places of rows and of columns, and the distances between them, part by part."""
    (low, high), (other_low, other_high) = [(x.min(axis=0), x.max(axis=0)) for x in (mine, others)]
    apart = np.maximum(0.0, np.maximum(low - other_high, other_low - high))
    low, high = np.minimum(low, other_low), np.maximum(high, other_high)
    middle = low + (high - low) / 2
    one, two = mine - middle, others - middle
    here, there = (one * one).sum(axis=1), (two * two).sum(axis=1)
    close = CLOSE * max(here.max(), there.max())
    touch = not (apart * apart).sum() >= close
    left = np.column_stack([-2 * one, np.ones(len(one)), here])
    right = np.vstack([two.T, there, np.ones(len(two))])
    space = np.empty(ROWS * COLUMNS)
    for a in range(0, len(mine), ROWS):
        rows = slice(a, min(a + ROWS, len(mine)))
        for b in range(0, len(others), COLUMNS):
            columns = slice(b, min(b + COLUMNS, len(others)))
            size = (rows.stop - a, columns.stop - b)
            away = space[: size[0] * size[1]].reshape(size)
            if math.isfinite(close):
                np.matmul(left[rows], right[:, columns], out=away)
                if touch and away.min() < close:
                    i, j = np.nonzero(away < close)
                    away[i, j] = ((mine[a + i] - others[b + j]) ** 2).sum(axis=1)
            else:
                away[:] = 0.0
                for axis in range(mine.shape[1]):
                    away += (mine[rows, axis, None] - others[None, columns, axis]) ** 2
            yield rows, columns, np.sqrt(away, out=away)


def distance_sums(
    points: Sequence[np.ndarray], marks: Sequence[np.ndarray], labels: int, leaf: int
) -> list[np.ndarray]:
    """For one group, or each of two, every point's sum of distances to the points of each label: of the
    group itself, or of the other one. Labels are numbers from 0, or -1 for none. A point with a NaN is
    NaN away from all."""
    lost = [np.isnan(x).any(axis=1) for x in points]
    groups = [Group(x[~no], mark[~no], labels, leaf) for x, mark, no in zip(points, marks, lost, strict=True)]
    meet(groups[0], groups[-1])
    out = []
    for i, group in enumerate(groups):
        total = np.zeros((len(points[i]), labels))
        total[~lost[i]] = group.sums()
        others, away = marks[len(groups) - 1 - i], lost[len(groups) - 1 - i]
        total[:, np.unique(others[away & (others >= 0)])] = np.nan
        total[np.ix_(lost[i], np.unique(others[others >= 0]))] = np.nan
        out.append(total)
    return out
