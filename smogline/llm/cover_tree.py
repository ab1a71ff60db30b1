"""Largest inner products, exactly, by best-first descent of a cover tree.

*Norm augmentation.* A point x gets one more coordinate, sqrt(M**2 - |x|**2), with M the largest norm
of the tree; a query gets 0 there. All points then have norm M, and the inner product of query and
point follows from their distance d: q.x = (|q|**2 + M**2 - d**2) / 2.

*Tree.* The children of a node are a farthest-first net of its points: each centre lies farther from
those before it than the covering radius they leave, until that is at most half of the parent's or
``FAN_OUT`` centres are taken. The first child keeps the parent's centre, every point goes to its
nearest centre, and each node stores the measured covering radius of its own points. Points that are
all equal (radius 0) are cut into leaves in the order of their ids.

*Descent.* With d the distance of query and centre and r the covering radius, inner products in a node
lie between those at distance d + r and max(0, d - r). Nodes come off a heap, the largest upper bound
first. A node outside of the windows, or that cannot beat what is kept, is left out; ties count, as a
node knows its smallest id. The points of leaves are verified with their exact inner products.

Queries go down in blocks, so a step costs a few array operations for all queries that it still
concerns; each has its own bounds.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

FAN_OUT = 16
LEAF = 128
_NO_ID = np.iinfo(np.int64).max


def exact_type(largest: float) -> np.dtype:
    """The float type in which integer inner products of at most this size are exact."""
    if largest < 2**24:
        return np.dtype(np.float32)
    if largest < 2**53:
        return np.dtype(np.float64)
    raise ValueError(f"inner products up to {largest:.3g} are not exact in 64-bit floats; scale the vectors down")


class CoverTree:
    """A cover tree over integer points with ids and labels."""

    def __init__(self, points: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        norms = np.einsum("ij,ij->i", points, points)
        self.top = float(norms.max())
        self._lifted = np.column_stack([points, np.sqrt(self.top - norms)])
        self._ids = ids
        self.centre, self.radius, self.smallest = [], [], []
        self.children: list[range] = []
        self.leaf: list[np.ndarray | None] = []
        root = self._node(int(ids.argmin()), np.argsort(ids, kind="stable"))
        open_ = [root]
        while open_:
            node = open_.pop()
            parts = self._net(node)
            first = len(self.centre)
            for centre, part in parts:
                open_.append(self._node(centre, part))
            if parts:
                self.children[node], self.leaf[node] = range(first, first + len(parts)), None
        del self._lifted
        self.points, self.rows, self.ids, self.labels = points, rows, ids, labels
        self.centres = points[self.centre]
        self.radii = np.array(self.radius)
        self.least = np.array(self.smallest)

    def _far(self, part: np.ndarray, centre: int) -> np.ndarray:
        away = self._lifted[part] - self._lifted[centre]
        return np.sqrt(np.einsum("ij,ij->i", away, away))

    def _node(self, centre: int, part: np.ndarray) -> int:
        reach = float(self._far(part, centre).max())
        self.centre.append(centre)
        self.radius.append(reach * (1 + 1e-9))
        self.smallest.append(int(self._ids[part].min()))
        self.children.append(range(0))
        self.leaf.append(part)
        return len(self.centre) - 1

    def _net(self, node: int) -> list[tuple[int, np.ndarray]]:
        """Centres and points of the children; none for a leaf."""
        part = self.leaf[node]
        if len(part) <= LEAF:
            return []
        if self.radius[node] == 0:
            return [(int(part[i]), part[i : i + LEAF]) for i in range(0, len(part), LEAF)]
        centres = [self.centre[node]]
        near, owner = self._far(part, centres[0]), np.zeros(len(part), np.int32)
        while len(centres) < FAN_OUT and near.max() > self.radius[node] / 2:
            centres.append(int(part[near.argmax()]))
            away = self._far(part, centres[-1])
            closer = away < near
            owner[closer] = len(centres) - 1
            near = np.minimum(near, away)
        return [(c, part[owner == i]) for i, c in enumerate(centres)]


@dataclass
class Search:
    """The best ``keep`` candidates of each (query, window), over all trees it is given.

    ``same``: candidates with the label of the query, the query's own row left out; else those with
    another label. Windows are inclusive; one whose low end is above its high end holds nothing.
    """

    queries: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    keep: int
    same: bool

    def __post_init__(self):
        shape = (*self.low.shape, self.keep)
        self.squared = np.einsum("ij,ij->i", self.queries, self.queries)
        self.score = np.full(shape, -np.inf)
        self.ident = np.full(shape, _NO_ID)
        self.least = np.where(self.low <= self.high, self.low, np.inf)  # what a candidate has to reach
        self.least_id = np.full(self.low.shape, _NO_ID)

    def _concerned(self, who: np.ndarray, upper: np.ndarray, lower: np.ndarray, smallest: int) -> np.ndarray:
        least, upper = self.least[who], upper[:, None]
        better = (upper > least) | ((upper == least) & (smallest < self.least_id[who]))
        return (better & (lower[:, None] <= self.high[who])).any(axis=1)

    def descend(self, tree: CoverTree) -> int:
        """Take in what a tree holds; the number of points that were verified is returned."""
        if not len(self.queries):
            return 0
        kind = exact_type(float(np.sqrt(self.squared.max() * tree.top)) + 1)
        queries, centres = self.queries.astype(kind), tree.centres.astype(kind)
        points = tree.points.astype(kind)
        everyone = np.arange(len(queries))
        heap, verified = [], 0

        def push(nodes: range, who: np.ndarray, above: np.ndarray, below: np.ndarray) -> None:
            at = queries[who] @ centres[nodes.start : nodes.stop].T
            at = at.astype(np.float64)
            radii = tree.radii[nodes.start : nodes.stop]
            both = self.squared[who][:, None] + tree.top
            away = np.sqrt(np.maximum(both - 2 * at, 0))
            slack = 1e-9 * both + 1e-6
            upper = np.floor((both - np.maximum(away - radii, 0) ** 2) / 2 + slack)
            lower = np.ceil((both - (away + radii) ** 2) / 2 - slack)
            upper = np.minimum(np.where(radii == 0, at, upper), above[:, None])
            lower = np.maximum(np.where(radii == 0, at, lower), below[:, None])
            for i, node in enumerate(nodes):
                left = self._concerned(who, upper[:, i], lower[:, i], tree.least[node])
                if left.any():
                    bound = upper[left, i]
                    heapq.heappush(heap, (-bound.max(), node, who[left], bound, lower[left, i]))

        push(range(1), everyone, np.full(len(queries), np.inf), np.full(len(queries), -np.inf))
        while heap:
            _, node, who, upper, lower = heapq.heappop(heap)
            left = self._concerned(who, upper, lower, tree.least[node])
            if not left.any():
                continue
            who = who[left]
            if tree.children[node]:
                push(tree.children[node], who, upper[left], lower[left])
            else:
                part = tree.leaf[node]
                verified += len(who) * len(part)
                self._verify(who, (queries[who] @ points[part].T), tree, part)
        return verified

    def _verify(self, who: np.ndarray, scores: np.ndarray, tree: CoverTree, part: np.ndarray) -> None:
        fits = tree.labels[part][None, :] == self.labels[who][:, None]
        if self.same:
            fits &= tree.rows[part][None, :] != self.rows[who][:, None]
        else:
            fits = ~fits
        found = []
        windows = self.low.shape[1]
        for w in range(windows):
            least, high = self.least[who, w][:, None], self.high[who, w][:, None]
            at, point = np.nonzero(fits & (scores >= least) & (scores <= high))
            if len(at):
                found.append((who[at] * windows + w, scores[at, point].astype(np.float64), tree.ids[part][point]))
        if found:
            self._take(*(np.concatenate(x) for x in zip(*found)))

    def _take(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """Merge candidates into what is kept of their (query, window)."""
        kept_score, kept_id = self.score.reshape(-1, self.keep), self.ident.reshape(-1, self.keep)
        touched = np.unique(slot)
        slot = np.concatenate([slot, np.repeat(touched, self.keep)])
        score = np.concatenate([score, kept_score[touched].ravel()])
        ident = np.concatenate([ident, kept_id[touched].ravel()])
        order = np.lexsort((ident, -score, slot))
        slot, score, ident = slot[order], score[order], ident[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        best = rank < self.keep
        kept_score[slot[best], rank[best]], kept_id[slot[best], rank[best]] = score[best], ident[best]
        last, last_id = kept_score[touched, -1], kept_id[touched, -1]
        full = last > -np.inf
        self.least.ravel()[touched[full]] = last[full]
        self.least_id.ravel()[touched[full]] = last_id[full]
