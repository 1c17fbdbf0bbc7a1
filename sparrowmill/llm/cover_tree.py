"""Cover tree over norm-augmented vectors, searched best first for inner products inside windows."""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np

LEAF_ROWS = 256
FANOUT = 32
#: Radii grow by this share of the largest norm, far more than rounding can take from them.
SLACK = 1e-6
EXACT = 1 << 53
LONG = 1 << 62


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exactly: in doubles while every sum fits, else in Python numbers.

    What a long cannot hold becomes the nearest of -2**62 and 2**62.
    """
    if np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m] for m in (a, b)]
    sums = [[sum(x * y for x, y in zip(p, q)) for q in whole[1]] for p in whole[0]]
    return np.array([[max(-LONG, min(LONG, s)) for s in row] for row in sums], np.int64).reshape(len(a), len(b))


class CoverTree:
    """Rows of whole numbers, in the order of their ties: of equal scores the earlier row comes first.

    With one more component, sqrt(M * M - |x| * |x|) for the largest norm M, all vectors are equally long and a larger
    inner product means a smaller distance. A node holds its centre and the largest distance of its rows, so
    q * x lies within |q| times that radius of q * centre. Children are centres further than half the node's
    radius apart, found farthest first; where FANOUT of them do not cover the rows at that distance, a
    child keeps its larger radius and is divided below.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        with np.errstate(over="ignore"):
            self.squares = np.einsum("ij,ij->i", vectors, vectors)
        self.most = most = self.squares.max(initial=0.0)
        self.added = np.sqrt(np.maximum(most - np.where(np.isfinite(self.squares), self.squares, 0.0), 0.0))
        self.slack = SLACK * np.sqrt(most)
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.rows: list[np.ndarray | None] = []
        if len(vectors):
            self._build()

    def distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            plain = self.squares[rows] + self.squares[centre] - 2.0 * (self.vectors[rows] @ self.vectors[centre])
            far = np.sqrt(np.maximum(plain, 0.0) + (self.added[rows] - self.added[centre]) ** 2)
        far[rows == centre] = 0.0
        return np.where(np.isnan(far), np.inf, far)

    def _node(self, centre: int, far: np.ndarray) -> int:
        self.centre.append(centre)
        self.radius.append(far.max())
        self.children.append(None)
        self.rows.append(None)
        return len(self.centre) - 1

    def _build(self) -> None:
        rows = np.arange(len(self.vectors))
        far = self.distances(rows, 0)
        waiting = [(self._node(0, far), rows, far)]
        while waiting:
            node, rows, far = waiting.pop()
            if len(rows) <= LEAF_ROWS or not 0 < far.max() < np.inf:
                self.rows[node] = rows
                continue
            centres, near, owner = [self.centre[node]], far.copy(), np.zeros(len(rows), np.int32)
            while near.max() > far.max() / 2 and len(centres) < FANOUT:
                centres.append(int(rows[near.argmax()]))
                now = self.distances(rows, centres[-1])
                closer = now < near
                near[closer], owner[closer] = now[closer], len(centres) - 1
            made = []
            for n, centre in enumerate(centres):
                mine = owner == n
                made.append(self._node(centre, near[mine]))
                waiting.append((made[-1], rows[mine], near[mine]))
            self.children[node] = np.array(made)

    def reach(self, centres, radius: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible inner product of each query with the rows within a radius of each centre."""
        with np.errstate(over="ignore", invalid="ignore"):
            norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))
            middle = queries @ self.vectors[centres].T
            far = norms[:, None] * (radius + self.slack) + SLACK * np.abs(middle)
            least, largest = middle - far, middle + far
        return np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(largest), np.inf, largest)

    def bounds(self, nodes, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.reach([self.centre[n] for n in nodes], np.array([self.radius[n] for n in nodes]), queries)

    def search(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray, allowed, k: int):
        """The first k allowed rows of each query in each of its windows `low` to `high` (queries x windows).

        `allowed(active, rows)` tells which of these rows each active query may meet. Nodes are visited by
        their largest bound; a query skips a node when no window of its meets the bounds, or the k rows
        found there are all better. Returns query, window, row and score of what was found, four arrays.
        """
        m, windows = low.shape
        if not len(self.vectors) or not m:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        # the k best of each window, best first; unfilled places lie just below the window
        score = np.repeat((low - 1)[:, :, None], k, axis=2)
        place = np.full((m, windows, k), -1)
        with np.errstate(over="ignore"):
            norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))

        def meets(active, least, largest):
            wanted = np.maximum(score[active, :, -1], low[active])
            inside = (largest[:, None] >= wanted) & (least[:, None] <= high[active])
            return (inside & (low[active] <= high[active])).any(axis=1)

        order = count()
        least, largest = self.bounds([0], queries)
        waiting = [(-np.inf, next(order), 0, np.arange(m), least[:, 0], largest[:, 0])]
        while waiting:
            _, _, node, active, least, largest = heapq.heappop(waiting)
            active = active[meets(active, least, largest)]
            if not len(active):
                continue
            if self.children[node] is not None:
                nodes = self.children[node]
                least, largest = self.bounds(nodes, queries[active])
                for at, child in enumerate(nodes):
                    go = meets(active, least[:, at], largest[:, at])
                    if go.any():
                        reached = largest[go, at]
                        first = -(reached / np.maximum(norms[active[go]], 1.0)).max()
                        heapq.heappush(waiting, (first, next(order), child, active[go], least[go, at], reached))
                continue
            rows = self.rows[node]
            scores, may = inner(queries[active], self.vectors[rows]), allowed(active, rows)
            for w in range(windows):
                last, tie = score[active, w, -1][:, None], place[active, w, -1][:, None]
                found = may & (scores <= high[active, w][:, None]) & ((scores > last) | (scores == last) & (rows < tie))
                some, which = found.any(axis=1), found.any(axis=0)
                if some.any():
                    mine, found = active[some], found[np.ix_(some, which)]
                    merged = np.concatenate([score[mine, w], np.where(found, scores[np.ix_(some, which)], 1 - 2 * LONG)], axis=1)
                    places = np.concatenate([place[mine, w], np.broadcast_to(rows[which], found.shape)], axis=1)
                    best = np.lexsort((places, -merged), axis=-1)[:, :k]
                    score[mine, w] = np.take_along_axis(merged, best, axis=1)
                    place[mine, w] = np.take_along_axis(places, best, axis=1)
        query, window, at = np.nonzero(place >= 0)
        return query, window, place[query, window, at], score[query, window, at]
