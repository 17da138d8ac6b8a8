"""Cover trees over blocks of vectors, their dual traversal, and the blocks themselves.

The nets of a tree have halving radii: centres of level i are more than 2**i apart, every point lies within
2**i of one, and each net holds the one above it. A node is a centre from its level on; its children are
the centres of the first finer net that divides what it holds, the first of them its own centre, all within
2**(i + 1). Dual traversal goes down two trees at once and compares the children of a pair of nodes
in one product of matrices; pairs that their covering radii keep apart are left out.

At the level of the cluster, vectors are dealt into cells around centres taken from a bounded sample,
and cells into blocks of bounded size. A task holds one block and lets visitors stream past it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtables.llm.common import hash_sample, mix64, row_pieces

SAMPLE_ROWS = 8_192
MAX_CENTRES = 1_024
BLOCK_ROWS = 4_096
VISITORS_PER_ROW = 16
VISITOR_ROWS = 1_024
NET_ROWS = 64
FEW = 32
SLACK = 1e-7


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, which rounding may leave a little below zero."""
    gram = a @ b.T
    gram *= -2
    gram += (a * a).sum(1)[:, None]
    gram += (b * b).sum(1)[None, :]
    return gram


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gram = squares(a, b)
    return np.sqrt(np.maximum(gram, 0, out=gram), out=gram)


class Tree:
    """``centre``, ``level``, ``radius``, ``members`` and ``children`` by node; node 0 is the root.

    ``members`` are the points below a node and ``radius`` is the largest distance of one of them from its
    centre. Points within ``stop`` of a centre that no finer net has to part stay with it in one leaf.
    """

    def __init__(self, points: np.ndarray, stop: float = 0.0):
        self.points = points
        self.half = (points * points).sum(1) / 2
        self.scale = float(np.sqrt(2 * self.half.max(initial=0)))
        self.centre: list[int] = []
        self.level: list[int] = []
        self.children: list[list[int]] = []
        self._build(max(stop, SLACK * self.scale))
        self.members: list = [None] * len(self.centre)
        self.radius = np.zeros(len(self.centre))
        for node in reversed(range(len(self.centre))):  # children come after their parents
            of = self.children[node]
            rows = np.concatenate([self.members[c] for c in of]) if of else self._held[node]
            self.members[node] = rows
            if len(rows) > 1:
                self.radius[node] = np.linalg.norm(points[rows] - points[self.centre[node]], axis=1).max()
        del self._held
        self.centre_of = np.array(self.centre)
        self.size = np.array([len(m) for m in self.members])
        self.single = self.size == 1
        self._below: dict[tuple, tuple] = {}

    def below(self, node: int, group: np.ndarray, reach: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Single points and larger nodes right below a node, or itself where it is a leaf; ``group`` if
        there is no node. Nodes of at most ``FEW`` points, wider than ``reach``, are given as their points."""
        if node < 0:
            return group, np.zeros(0, np.int64)
        if (node, reach) not in self._below:
            of = np.array(self.children[node] or [node])
            few = self.single[of] | ((self.size[of] <= FEW) & (self.radius[of] > reach))
            points = np.concatenate([self.members[c] for c in of[few]]) if few.any() else np.zeros(0, np.int64)
            self._below[node, reach] = points, of[~few]
        return self._below[node, reach]

    def _node(self, centre: int, level: int, held: np.ndarray) -> int:
        self.centre.append(centre)
        self.level.append(level)
        self.children.append([])
        self._held[len(self.centre) - 1] = held
        return len(self.centre) - 1

    def _build(self, stop: float) -> None:
        """Net by net from the root; ``live`` are the nodes of the current net."""
        points, self._held = self.points, {}
        far = np.linalg.norm(points - points[0], axis=1)
        level = int(np.ceil(np.log2(max(far.max(), 1e-300))))
        live = [self._node(0, level, np.arange(len(points)))]
        open_nodes = live if far.max() > stop else []
        while open_nodes:
            level -= 1
            parts, loose = self._claim(live, open_nodes, 2.0 ** level)
            fresh = self._new_centres(open_nodes, loose, 2.0 ** level)
            after, touched = [], []
            for node in live:
                held = parts.get(node, self._held[node])
                if fresh.get(node):
                    own = self._node(self.centre[node], level, held)
                    made = [own, *[self._node(c, level, rows) for c, rows in fresh[node]]]
                    self.children[node] = made
                    after += made
                    touched += made
                else:
                    if held is not self._held[node]:
                        self._held[node] = held
                        touched.append(node)
                    after.append(node)
            live = after
            open_nodes = [n for n in touched if len(self._held[n]) > 1 and np.linalg.norm(
                points[self._held[n]] - points[self.centre[n]], axis=1).max() > stop]

    def _claim(self, live: list[int], open_nodes: list[int], r: float) -> tuple[dict, dict]:
        """Points of open nodes by the node of the net within ``r`` of them, and those without one.

        A centre within r of a point has its parent within 3 r of that point, whose own parent is within 2 r.
        """
        points, centres = self.points, self.points[[self.centre[n] for n in live]]
        taken: dict[int, list] = {n: [np.array([self.centre[n]])] for n in open_nodes}
        loose = {}
        for node in open_nodes:
            held = self._held[node]
            held = held[held != self.centre[node]]
            near = np.nonzero(distances(points[[self.centre[node]]], centres)[0] <= 5 * r + SLACK * self.scale)[0]
            d = distances(points[held], centres[near])
            best = d.argmin(1)
            inside = d[np.arange(len(held)), best] <= r
            loose[node] = held[~inside]
            for k in np.unique(best[inside]):
                claimer = live[near[k]]
                if claimer not in taken:
                    taken[claimer] = [self._held[claimer]]
                taken[claimer].append(held[inside & (best == k)])
        return {n: np.concatenate(rows) for n, rows in taken.items()}, loose

    def _new_centres(self, open_nodes: list[int], loose: dict, r: float) -> dict[int, list]:
        """Centres more than ``r`` apart out of the points that no centre holds, by the node they come from."""
        points, made = self.points, {}
        free = np.zeros(len(points), bool)
        for rows in loose.values():
            free[rows] = True
        centres = points[[self.centre[n] for n in open_nodes]]
        for at, node in enumerate(open_nodes):
            if not free[loose[node]].any():
                continue
            near = at + np.nonzero(distances(centres[[at]], centres[at:])[0] <= 5 * r + SLACK * self.scale)[0]
            pool = np.concatenate([loose[open_nodes[k]] for k in near])
            while True:
                some = loose[node][free[loose[node]]][:NET_ROWS]
                if not len(some):
                    break
                pool = pool[free[pool]]
                inside = points[some] @ points[pool].T - self.half[pool]
                inside = inside >= (self.half[some] - r * r / 2)[:, None]
                alone = inside.sum(1) <= 1  # no free point but itself is near: a centre whatever the order
                if alone.any():
                    free[some[alone]] = False
                    made.setdefault(node, []).extend((int(p), np.array([p])) for p in some[alone])
                for point, near_it in zip(some[~alone], inside[~alone]):
                    if free[point]:
                        rows = pool[near_it & free[pool]]
                        rows = rows if (rows == point).any() else np.append(rows, point)
                        free[rows] = False
                        made.setdefault(node, []).append((int(point), rows))
        return made


def threshold_pairs(a: Tree, b: Tree, reach: float, exact: Callable[[np.ndarray, np.ndarray], np.ndarray],
                    seen: Counter | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows of a, rows of b, all): pairs of points within ``reach``, each exactly once.

    With ``all`` every row is paired with every other one: the node pair lies within reach as a whole.
    Node pairs that are apart by their covering radii are pruned; leaves are decided by ``exact``. A tree against
    itself is gone through once for both orders of a pair. ``seen`` counts the pairs of points that were pruned,
    taken as a whole and compared.
    """
    seen = Counter() if seen is None else seen
    for rows, others, whole, twice in _Dual(a, b, reach, exact, seen).run():
        yield rows, others, whole
        if twice:
            yield others, rows, whole


class _Dual:
    """One traversal of two trees. Results have a mark ``twice`` if they stand for both orders of a pair."""

    def __init__(self, a: Tree, b: Tree, reach: float, exact: Callable, seen: Counter):
        self.a, self.b, self.reach, self.exact, self.seen = a, b, reach, exact, seen
        self.slack = SLACK * max(a.scale, b.scale, reach)
        # |x - y|**2 <= r**2 as x.y - |y|**2 / 2 >= (|x|**2 - r**2) / 2. The left side is one product in single
        # precision, with a column more, of points shrunk to norm 1; what may pass by its rounding is looked at again
        shrink = max(a.scale, b.scale) or 1.0
        self.left = np.c_[a.points / shrink, np.ones(len(a.points))].astype(np.float32)
        self.right = np.c_[b.points / shrink, -b.half / shrink ** 2].astype(np.float32)
        error = (self.left.shape[1] + 4) * 2.0 ** -23
        self.least = ((a.half - (reach + self.slack) ** 2 / 2) / shrink ** 2 - error).astype(np.float32)
        self.nothing = np.zeros(0, np.int64)
        # a side is a node, or some single points (node -1)
        self.waiting: list[tuple] = [(0, self.nothing, 0, self.nothing, False)]

    def run(self) -> Iterator[tuple]:
        a, b, nothing = self.a, self.b, self.nothing
        while self.waiting:
            i, group, j, others, twice = self.waiting.pop()
            alone, nodes = a.below(i, group, self.reach)
            if a is b and i == j >= 0:
                for low, high in row_pieces(len(alone), NET_ROWS * 4):
                    yield from self._points(alone[low:high], alone[low:high], False)
                    yield from self._points(alone[low:high], alone[high:], True)
                yield from self._nodes_and_points(nodes, alone, True)
                for x, node in enumerate(nodes):
                    yield from self._nodes(nodes[x:x + 1], nodes[x:x + 1], False)
                    yield from self._nodes(nodes[x:x + 1], nodes[x + 1:], True)
                continue
            single, right = b.below(j, others, self.reach)
            for low, high in row_pieces(len(alone), NET_ROWS * 4):
                yield from self._points(alone[low:high], single, twice)
            yield from self._nodes_and_points(nodes, single, twice)
            if len(right) and len(alone):
                apart, inside = self._between(b, right, a.points[alone], np.zeros(len(alone)))
                for y, n in enumerate(right):
                    whole, open_ = self._shares(alone, apart[y], inside[y], len(b.members[n]), twice)
                    if len(whole):
                        yield whole, b.members[n], True, twice
                    if len(open_):
                        yield from self._next(-1, open_, n, nothing, twice)
            yield from self._nodes(nodes, right, twice)

    def _between(self, tree: Tree, nodes, points: np.ndarray, radius: np.ndarray) -> tuple:
        """(apart, inside): nodes by points of another tree with the radii around these."""
        gap = distances(tree.points[tree.centre_of[nodes]], points)
        both = tree.radius[nodes][:, None] + radius[None, :]
        return gap - both > self.reach + self.slack, gap + both < self.reach - self.slack

    def _shares(self, rows: np.ndarray, apart: np.ndarray, inside: np.ndarray, members: int, twice: bool) -> tuple:
        """Single points that lie within reach of a whole node, and those that its children decide about."""
        whole, open_ = rows[inside], rows[~apart & ~inside]
        self.seen["pruned"] += members * int(apart.sum()) * (1 + twice)
        self.seen["whole"] += members * len(whole) * (1 + twice)
        return whole, open_

    def _nodes_and_points(self, nodes: np.ndarray, single: np.ndarray, twice: bool) -> Iterator[tuple]:
        a = self.a
        if not len(nodes) or not len(single):
            return
        apart, inside = self._between(a, nodes, self.b.points[single], np.zeros(len(single)))
        for x, m in enumerate(nodes):
            whole, open_ = self._shares(single, apart[x], inside[x], len(a.members[m]), twice)
            if len(whole):
                yield a.members[m], whole, True, twice
            if len(open_):
                yield from self._next(m, self.nothing, -1, open_, twice)

    def _nodes(self, nodes: np.ndarray, right: np.ndarray, twice: bool) -> Iterator[tuple]:
        a, b = self.a, self.b
        if not len(nodes) or not len(right):
            return
        apart, inside = self._between(a, nodes, b.points[b.centre_of[right]], b.radius[right])
        for x, y in zip(*np.nonzero(apart)):
            self.seen["pruned"] += len(a.members[nodes[x]]) * len(b.members[right[y]]) * (1 + twice)
        for x, y in zip(*np.nonzero(inside)):
            rows, others = a.members[nodes[x]], b.members[right[y]]
            self.seen["whole"] += len(rows) * len(others) * (1 + twice)
            yield rows, others, True, twice
        for x, y in zip(*np.nonzero(~apart & ~inside)):
            yield from self._next(nodes[x], self.nothing, right[y], self.nothing, twice)

    def _next(self, i: int, group: np.ndarray, j: int, others: np.ndarray, twice: bool) -> Iterator[tuple]:
        """Let a pair of sides wait for its children, or decide it where both are leaves."""
        a, b = self.a, self.b
        if (i >= 0 and a.children[i]) or (j >= 0 and b.children[j]):
            self.waiting.append((int(i), group, int(j), others, twice))
            return
        rows, others = group if i < 0 else a.members[i], others if j < 0 else b.members[j]
        self.seen["compared"] += len(rows) * len(others) * (1 + twice)
        yield from self._decided(rows, others, twice)

    def _points(self, rows: np.ndarray, others: np.ndarray, twice: bool) -> Iterator[tuple]:
        """Pairs of single points: the distance decides but for its last digits."""
        if not len(rows) or not len(others):
            return
        self.seen["compared"] += len(rows) * len(others) * (1 + twice)
        gram, least = self.left[rows] @ self.right[others].T, self.least[rows]
        some = np.nonzero(gram.max(1) >= least)[0]
        if not len(some):
            return
        x, y = np.nonzero(gram[some] >= least[some][:, None])
        x, y = rows[some[x]], others[y]
        gap = np.linalg.norm(self.a.points[x] - self.b.points[y], axis=1)
        sure = gap < self.reach - self.slack
        if sure.any():
            yield x[sure], y[sure], False, twice
        for p, q in zip(*(z[~sure & (gap <= self.reach + self.slack)] for z in (x, y))):
            yield from self._decided(np.array([p]), np.array([q]), twice)

    def _decided(self, rows: np.ndarray, others: np.ndarray, twice: bool) -> Iterator[tuple]:
        x, y = np.nonzero(self.exact(self.a.points[rows], self.b.points[others]))
        if len(x):
            yield rows[x], others[y], False, twice


def top_products(queries: Tree, data: Tree, k: int, ids: np.ndarray, bounds: np.ndarray, skip: np.ndarray,
                 seen: Counter | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows of data, scores) of the k largest inner products of each query, ties to smaller ids.

    ``bounds`` are kth scores that the queries are known to reach elsewhere; lower ones are not wanted.
    ``skip`` is the id that a query does not compare with. A node pair is pruned when its largest possible
    product, from the product of the centres and the covering radii, is below the worst kth score of the
    node's queries. Node pairs with the largest bound are visited first; single points below a node are
    taken together. ``seen`` counts the pairs of points that were pruned and compared.
    """
    none = (np.zeros(0, np.int64), np.zeros(0))
    best = [none] * len(queries.points)
    worst = bounds.astype(float).copy()
    q_norm = np.linalg.norm(queries.points, axis=1)
    y_norm = np.linalg.norm(data.points, axis=1)
    slack = SLACK * queries.scale * data.scale
    seen = Counter() if seen is None else seen

    def score(group: np.ndarray, rows: np.ndarray) -> None:
        seen["compared"] += len(group) * len(rows)
        products = queries.points[group] @ data.points[rows].T
        for q, scores in zip(group, products):
            keep = (scores >= worst[q]) & (ids[rows] != skip[q])
            if not keep.any():
                continue
            found, got = np.r_[best[q][0], rows[keep]], np.r_[best[q][1], scores[keep]]
            order = np.lexsort((ids[found], -got))[:k]
            best[q] = (found[order], got[order])
            if len(order) == k:
                worst[q] = max(worst[q], got[order[-1]])

    order = count()
    waiting: list[tuple] = []

    def push(i: int | None, group: np.ndarray, j: int) -> None:
        """Wait with a pair: node ``i`` of the queries, or some queries alone, against node ``j``."""
        y, s = data.centre[j], data.radius[j]
        if i is None:
            most = queries.points[group] @ data.points[y] + s * q_norm[group]
            wanted = most + slack >= worst[group]
            seen["pruned"] += int((~wanted).sum()) * len(data.members[j])
            group, most = group[wanted], most[wanted]
            if not len(group):
                return
            top = float(most.max())
        else:
            q, r = queries.centre[i], queries.radius[i]
            top = float(queries.points[q] @ data.points[y]) + r * y_norm[y] + s * q_norm[q] + r * s
        heappush(waiting, (-top, next(order), i, group, j))

    push(0, queries.members[0], 0)
    while waiting:
        most, _, i, group, j = heappop(waiting)
        if -most + slack < worst[group].min():
            seen["pruned"] += len(group) * len(data.members[j])
        elif i is not None and queries.children[i] and (not data.children[j] or queries.radius[i] >= data.radius[j]):
            alone, below = queries.below(i, group)
            if len(alone):
                push(None, alone, j)
            for c in below:
                push(c, queries.members[c], j)
        elif not data.children[j]:
            score(group, data.members[j])
        else:
            alone, below = data.below(j, group)
            if len(alone):
                score(group, alone)
            for c in below:
                push(i if i is not None and queries.children[i] else None, group, c)
    return best


@dataclass(frozen=True)
class Cells:
    """Centres of the cells, the radius that covers each, its rows and the number of its blocks."""

    centres: np.ndarray
    radius: np.ndarray
    blocks: np.ndarray
    visits: int

    def distances(self, points: np.ndarray) -> np.ndarray:
        gram = (points * points).sum(1)[:, None] + (self.centres * self.centres).sum(1)[None, :]
        return np.sqrt(np.maximum(gram - 2 * (points @ self.centres.T), 0))


def vectors(batch: pa.RecordBatch, column: int) -> np.ndarray:
    values = batch.column(column)
    if not len(values):
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(values.to_pylist()), "<f8").reshape(len(values), -1)


def make_cells(rows: DataFrame, block: int = BLOCK_ROWS, most: int = MAX_CENTRES, sample: int = SAMPLE_ROWS) -> Cells:
    """Cells for rows (id, v) with v the bytes of doubles.

    Centres come from at most ``sample`` rows: a net whose radius is halved until there is a centre for
    every block, ``most`` of them at most. Radii and counts are taken over all rows, one row a cell.
    """
    taken = hash_sample(rows.select("id", "v"), "id", sample).collect()
    total = rows.count()
    if not taken:
        return Cells(np.zeros((0, 1)), np.zeros(0), np.zeros(0, np.int64), 1)
    points = np.array([np.frombuffer(r["v"], "<f8") for r in taken])
    wanted = min(most, max(1, -(-total // block)))
    chosen = [0]
    nearest = np.linalg.norm(points - points[0], axis=1)
    radius = nearest.max()
    while len(chosen) < wanted and radius > 0:
        radius /= 2
        for i in range(len(points)):
            if len(chosen) < wanted and nearest[i] > radius:
                chosen.append(i)
                nearest = np.minimum(nearest, np.linalg.norm(points - points[i], axis=1))
        if not nearest.any():
            break
    cells = Cells(points[chosen], np.zeros(len(chosen)), np.ones(len(chosen), np.int64), 1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, far = np.zeros(len(chosen), np.int64), np.zeros(len(chosen))
        for batch in batches:
            d = cells.distances(vectors(batch, 0))
            home = d.argmin(1)
            count += np.bincount(home, minlength=len(chosen))
            np.maximum.at(far, home, d.min(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(chosen)), pa.int32()), pa.array(count), pa.array(far)], names=["cell", "n", "far"]
        )

    found = rows.select("v").mapInArrow(measure, "cell int, n long, far double")
    found = found.groupBy("cell").agg(F.sum("n").alias("n"), F.max("far").alias("far")).collect()
    count, far = np.zeros(len(chosen), np.int64), np.zeros(len(chosen))
    for r in found:
        count[r["cell"]], far[r["cell"]] = r["n"], r["far"]
    visits = max(1, -(-total // (VISITORS_PER_ROW * block)))
    return Cells(points[chosen], far, np.maximum(1, -(-count // block)), visits)


def place(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)


PLACED = "cell int, block int, visit int, visitor boolean, id long, weight long, bound double, v binary"


def placed_batch(cell, block, visit, visitor: bool, ids, weights, bounds, raw: pa.Array, take) -> pa.RecordBatch:
    n = len(take)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(cell), pa.int32()), pa.array(np.asarray(block), pa.int32()),
         pa.array(np.asarray(visit), pa.int32()), pa.array([visitor] * n, pa.bool_()), pa.array(ids[take], pa.int64()),
         pa.array(weights[take], pa.int64()), pa.array(bounds[take], pa.float64()), raw.take(pa.array(take))],
        names=["cell", "block", "visit", "visitor", "id", "weight", "bound", "v"],
    )


def homes(batch_ids, weights, bounds, raw, home, cells: Cells) -> Iterator[pa.RecordBatch]:
    """Home rows of a batch, once for each group of visitors."""
    block = place(batch_ids, cells.blocks[home])
    for visit in range(cells.visits):
        take = np.arange(len(batch_ids))
        yield placed_batch(home, block, np.full(len(take), visit), False, batch_ids, weights, bounds, raw, take)


def over_blocks(placed: DataFrame, run: Callable, schema: str) -> DataFrame:
    """Run ``run(home, visitors)`` for each block; both are (ids, weights, bounds, points).

    ``visitors`` is a generator of batches, so a task holds its block and one batch.
    """
    dealt = placed.repartition("cell", "block", "visit").sortWithinPartitions("cell", "block", "visit", "visitor")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[tuple[tuple, tuple]]:
            for batch in batches:
                keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)
                points = vectors(batch, 7)
                rest = [batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 6)]
                cuts = np.r_[0, np.nonzero((keys[1:] != keys[:-1]).any(1))[0] + 1, len(keys)]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if b > a:
                        yield tuple(keys[a]), (*[r[a:b] for r in rest], points[a:b])

        source = slices()
        ahead = next(source, None)
        while ahead:
            group, home = ahead[0][:3], []
            while ahead and ahead[0] == (*group, 0):
                home.append(ahead[1])
                ahead = next(source, None)

            def visitors() -> Iterator[tuple]:
                nonlocal ahead
                while ahead and ahead[0][:3] == group:
                    for a, b in row_pieces(len(ahead[1][0]), VISITOR_ROWS):
                        yield tuple(x[a:b] for x in ahead[1])
                    ahead = next(source, None)

            guests = visitors()
            if home:
                yield from run(group, tuple(np.concatenate(x) for x in zip(*home)), guests)
            for _ in guests:
                pass

    return dealt.mapInArrow(each, schema)
