"""Hard negatives by a GNAT: a multiway hyperplane tree whose split points know their siblings' distances.

Scores are integer inner products. Every vector gets one more component that brings it to the length of
the longest one, and an anchor a zero; then ``distance^2 = |anchor|^2 + longest^2 - 2 * score``, so a
window of scores is an annulus around the anchor and the triangle inequality holds.

A node has up to 64 split points, rows of a bounded sample picked far from each other, and a row goes to
the nearest. For each split point and each sibling subtree the node stores the smallest and the largest
distance of *all* rows there. A subtree is left out where, for some split point, that range does not meet
what the anchor's annulus allows. The tree has two such levels; a leaf is dealt to blocks of about
``BLOCK`` rows, each of which is a third node with leaves that are compared exactly. The sample decides
the work, never the result.

The blocks lie in files of the shared folder, in the order of the leaves. A task searches for a block of
anchors: it starts with their own leaves, then goes through the others' files, a block at a time, and keeps
the best rows of each window, which narrow it. So neither rows nor anchors are sent to each other, and a
task holds its anchors and one file, whatever the number of leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import read_array, staged, write_file
from recordflow.session import scratch_path

#: Rows of a block of a leaf, on average.
BLOCK = 512
#: Vectors of a file of blocks, at most, and the files and blocks of anchors that there are at least, if there are as many rows.
FILE_BYTES = 16 << 20
LEAST_FILES = 64
LEAST_ANCHOR_BLOCKS = 16
#: Anchors that are compared with a block at once, at most.
MOST_ANCHORS = 4096
#: Scores that are sorted into the windows of a block of anchors at once.
MOST_ADDED = 1 << 17
#: Pairs of anchors and rows that blocks are put together for: of all labels, of the anchors' own, and of one label alone.
PAIRS = 1 << 20
PAIRS_OF_SAME = 1 << 22
PAIRS_A_LABEL = 1 << 14
#: Bytes of vectors that are put together, at most, and scores that are made at once.
QUEUE_BYTES = 1 << 20
SCORES = 1 << 18
#: Rows that split points are picked from.
SAMPLE = 16_384
MOST_FAN = 64
#: Split points of a block.
LOCAL = 8
#: Components beyond this have scores that no long holds.
MOST_COMPONENT = float(1 << 18)
#: Rounding of squared distances, as a share of the largest one.
_SLACK = 1e-12
_NO_BOUND = -(1 << 62)


def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``floor(256 * x)`` of each component, as integers; rows with a component that takes no part go."""
    for batch in batches:
        vec = batch.column("vec")
        values = vec.flatten().to_numpy(zero_copy_only=False)  # null: not a number
        ends = np.concatenate([[0], np.cumsum(vec.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
        fits = np.abs(values) < MOST_COMPONENT
        good = np.diff(np.concatenate([[0], np.cumsum(~fits)])[ends]) == 0
        whole = np.floor(np.where(fits, values, 0) * 256).astype(np.int32)
        vec = pa.ListArray.from_arrays(pa.array(ends), pa.array(whole))
        out = pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), vec], ["vec_id", "label", "vec"])
        yield out.filter(pa.array(good))


def usable(vectors: DataFrame, vector: str, label: Column) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part."""
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull())
    vec = F.col(vector).cast("array<double>").alias("vec")
    rows = rows.select(F.col("vec_id").cast("long"), label.cast("int").alias("label"), vec)
    return rows.where(F.col("label").isNotNull()).mapInArrow(scaled, "vec_id long, label int, vec array<int>")


# -- geometry ---------------------------------------------------------------------------------------


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the component that makes them as long as the longest."""
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(0, longest - (x * x).sum(1)))[:, None]], 1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T))


def far_points(points: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` distinct rows, each far from the ones before."""
    if not len(points):
        return points
    out = [0]
    near = squared(points, points[:1])[:, 0]
    while len(out) < k and near.max() > 1e-6:
        out.append(int(near.argmax()))
        near = np.minimum(near, squared(points, points[out[-1:]])[:, 0])
    return points[out]


def spans(d2: np.ndarray, child: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest distance of each split point to the rows of each child."""
    low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    for j in np.unique(child):
        own = d2[child == j]
        low[:, j] = np.sqrt(np.maximum(0, own.min(0) - slack))
        high[:, j] = np.sqrt(own.max(0) + slack)
    return low, high


def alive(d: np.ndarray, inner: np.ndarray, outer: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which children (columns) may hold a point of each annulus. ``d``: distances to the split points."""
    out = np.repeat((low <= high).all(0)[None], len(d), 0)
    least, most = np.maximum(d - outer[:, None], inner[:, None] - d), d + outer[:, None]
    for i in range(len(low)):
        out &= (low[i][None] <= most[:, i, None]) & (high[i][None] >= least[:, i, None])
    return out


class Annuli:
    """Windows of scores around anchors, as distances. ``low`` and ``high`` may be narrowed later."""

    def __init__(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, longest: float):
        x = anchors.astype(np.float64)
        self.norm = (x * x).sum(1)
        self.top = self.norm + longest
        self.slack = _SLACK * float(self.top.max(initial=1.0))
        self.points = np.concatenate([x, np.zeros((len(x), 1))], 1)
        self.low, self.high = low, high

    def alive(self, splits: np.ndarray, low: np.ndarray, high: np.ndarray, rows=slice(None)) -> np.ndarray:
        d2 = self.norm[rows][:, None] + (splits * splits).sum(1)[None] - 2 * (self.points[rows] @ splits.T)
        inner = np.sqrt(np.maximum(0, self.top[rows] - 2.0 * self.high[rows] - self.slack))
        outer = np.sqrt(np.maximum(0, self.top[rows] - 2.0 * self.low[rows]) + self.slack)
        outer = np.where(self.low[rows] <= _NO_BOUND, np.inf, outer)
        give = math.sqrt(self.slack)  # d is off by no more than this, however small it is
        return alive(np.sqrt(np.maximum(0, d2)), inner - 2 * give, outer + 2 * give, low, high)


def exact_kind(longest: float) -> type:
    """The numbers that hold every sum of an inner product exactly: floats as long as none can pass their digits."""
    return np.float32 if longest < 2.0**24 else np.float64 if longest < 2.0**52 else np.int64


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact."""
    squares = [(x.astype(np.float64) ** 2).sum(1).max(initial=0) for x in (anchors, rows)]
    kind = exact_kind(math.sqrt(squares[0]) * math.sqrt(squares[1]))
    return (anchors.astype(kind) @ rows.astype(kind).T).astype(np.int64)


# -- the tree ---------------------------------------------------------------------------------------


class Tree:
    """Two levels of split points, with the ranges of all rows once ``ranges`` is filled."""

    def __init__(self, sample: np.ndarray, fan: int, longest: float):
        self.fan, self.longest = fan, longest
        points = lifted(sample, longest)
        self.root = far_points(points, fan)
        home = squared(points, self.root).argmin(1)
        self.inner = [far_points(points[home == c], fan) for c in range(len(self.root))]
        none = np.full((fan, fan), np.inf), np.full((fan, fan), -np.inf)
        self.ranges = {node: (none[0].copy(), none[1].copy()) for node in range(-1, len(self.root))}

    def points_of(self, node: int) -> np.ndarray:
        return self.root if node < 0 else self.inner[node]

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        points = lifted(rows, self.longest)
        first = squared(points, self.root).argmin(1) if len(points) else np.zeros(0, np.int64)
        leaf = first * self.fan
        for c in np.unique(first):
            own = first == c
            leaf[own] += squared(points[own], self.inner[c]).argmin(1)
        return leaf.astype(np.int32)

    def measure(self, rows: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The ranges of some rows: (node, low, high)."""
        points, slack = lifted(rows, self.longest), _SLACK * 4 * max(1.0, self.longest)
        for node in [-1, *np.unique(leaf // self.fan)]:
            own = np.ones(len(leaf), bool) if node < 0 else leaf // self.fan == node
            splits = self.points_of(node)
            child = (leaf[own] // self.fan) if node < 0 else leaf[own] % self.fan
            low, high = spans(squared(points[own], splits), child, len(splits), slack)
            yield int(node), low, high

    def _cut(self, node: int) -> list[np.ndarray]:
        k = len(self.points_of(node))
        return [x[:k, :k] for x in self.ranges[node]]

    def below(self, rings: Annuli, c: int, rows: np.ndarray) -> dict[int, np.ndarray]:
        """Which of some windows may have a row in each leaf below a child of the root."""
        low, high = self._cut(-1)
        rows = rows[rings.alive(self.root, low[:, [c]], high[:, [c]], rows)[:, 0]]
        if not len(rows):
            return {}
        below = rings.alive(self.inner[c], *self._cut(c), rows)
        return {c * self.fan + int(j): rows[below[:, j]] for j in np.flatnonzero(below.any(0))}

    def visits(self, rings: Annuli) -> dict[int, np.ndarray]:
        """The windows that may have a row in each leaf."""
        out: dict[int, np.ndarray] = {}
        for c in range(len(self.root)):
            out |= self.below(rings, c, np.arange(len(rings.top)))
        return out


# -- jobs in tasks ----------------------------------------------------------------------------------


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as rows, shorter ones filled with zeros."""
    sizes = np.asarray(column.value_lengths().fill_null(0))
    values = np.asarray(column.flatten()).astype(np.int32)
    out = np.zeros((len(sizes), dim), np.int32)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = values
    return out


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, components and the largest square of a length, for each batch."""
    for batch in batches:
        if batch.num_rows:
            dim = int(np.asarray(batch.column("vec").value_lengths()).max())
            longest = (_matrix(batch.column("vec"), dim).astype(np.float64) ** 2).sum(1).max()
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "dim": pa.array([dim], pa.int32()), "longest": [float(longest)]})


def stored_kind(longest: float) -> type:
    """The narrowest integers that hold every component."""
    return np.int16 if longest < 2.0**30 else np.int32


def _unpack(blobs: pa.Array, dim: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), kind).reshape(len(blobs), dim)


def _assign(tree: Tree, dim: int):
    kind = stored_kind(tree.longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            rows = _matrix(batch.column("vec"), dim)
            deal = (np.arange(done, done + len(rows)) + part * 7919) % (1 << 30)
            done += len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([r.tobytes() for r in rows.astype(kind)], pa.binary()),
                    pa.array(tree.leaves(rows), pa.int32()),
                    pa.array(deal.astype(np.int32)),
                ],
                ["vec_id", "label", "vec", "leaf", "deal"],
            )

    return run


def _measure(tree: Tree, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if batch.num_rows:
                leaf = np.asarray(batch.column("leaf"))
                for node, low, high in tree.measure(_unpack(batch.column("vec"), dim, stored_kind(tree.longest)), leaf):
                    a, b = seen.get(node, (low, high))
                    seen[node] = np.minimum(a, low), np.maximum(b, high)
        for node, (low, high) in seen.items():
            i, j = np.nonzero(low <= high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), node, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))]
                + [pa.array(low[i, j]), pa.array(high[i, j])],
                ["node", "i", "j", "low", "high"],
            )

    return run


class Block:
    """Some rows of a leaf in the order of the children of a node of their own, as bytes of a file."""

    def __init__(self, ids, splits, low, high, labels, ends, rows):
        self.ids, self.splits, self.low, self.high = ids, splits, low, high
        self.labels, self.ends, self.rows = labels, ends, rows

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, longest: float) -> Block:
        points = lifted(rows, longest)
        splits = far_points(points, LOCAL)
        d2 = squared(points, splits)
        child = d2.argmin(1)
        low, high = spans(d2, child, len(splits), _SLACK * 4 * max(1.0, longest))
        order = np.argsort(child, kind="stable")
        ends = np.searchsorted(child[order], np.arange(len(splits) + 1))
        return cls(ids[order], splits, low, high, labels[order], ends, rows[order])

    @staticmethod
    def _parts(n: int, k: int, dim: int, kind: type) -> list[tuple]:
        shapes = (n,), (k, dim + 1), (k, k), (k, k), (n,), (k + 1,), (n, dim)
        return list(zip((np.int64, np.float64, np.float64, np.float64, np.int32, np.int32, kind), shapes))

    def to_bytes(self, kind: type) -> bytes:
        parts = [self.ids, self.splits, self.low, self.high, self.labels, self.ends, self.rows]
        kinds = self._parts(*self.rows.shape[:1], len(self.splits), self.rows.shape[1], kind)
        out = np.array([len(self.ids), len(self.splits)], np.int64).tobytes()
        out += b"".join(np.ascontiguousarray(x, k).tobytes() for x, (k, _) in zip(parts, kinds))
        return out + bytes(-len(out) % 8)

    @classmethod
    def read(cls, data: np.ndarray, dim: int, kind: type) -> Block:
        n, k = (int(x) for x in data[:16].view(np.int64))
        at, out = 16, []
        for part, shape in cls._parts(n, k, dim, kind):
            out.append(np.ndarray(shape, part, data, at))
            at += out[-1].nbytes
        return cls(*out)


def _write_blocks(folder: str, per_file: int, dim: int, longest: float):
    """A file with the blocks of a group: where each begins, then the blocks."""

    def run(table: pa.Table) -> pa.Table:
        kind = stored_kind(longest)
        ids, deal = np.asarray(table["vec_id"]).astype(np.int64), np.asarray(table["deal"])
        labels, block = np.asarray(table["label"]).astype(np.int32), np.asarray(table["block"])
        rows = _unpack(table["vec"].combine_chunks(), dim, kind)
        order = np.lexsort((deal, ids, block))
        file = int(block[0]) // per_file
        cuts = np.searchsorted(block[order], file * per_file + np.arange(per_file + 1))
        parts, starts = [], [8 * (per_file + 1)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            some = order[a:b]
            parts.append(Block.of(ids[some], labels[some], rows[some], longest).to_bytes(kind) if a < b else b"")
            starts.append(starts[-1] + len(parts[-1]))
        write_file(f"{folder}/{file:08d}", [np.array(starts, np.int64).tobytes(), *parts])
        return pa.table({"file": pa.array([file], pa.int32())})

    return run


def _pack_anchors(dim: int, longest: float):
    """One row with all anchors of a block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending"), ("deal", "ascending")])
        ids, labels = np.asarray(table["vec_id"]).astype(np.int64), np.asarray(table["label"]).astype(np.int32)
        homes, rows = np.asarray(table["leaf"]).astype(np.int32), table["vec"].to_pylist()
        cells = {"block": pa.array([table["block"][0].as_py()], pa.int32())}
        for name, x in {"ids": ids.tobytes(), "labels": labels.tobytes(), "homes": homes.tobytes(), "rows": b"".join(rows)}.items():
            cells[name] = pa.array([x], pa.binary())
        return pa.table(cells)

    return run


class Leaves:
    """The blocks of each leaf, in the files of the shared folder. Sent to tasks; each holds the file that it reads."""

    def __init__(self, folder: str, per_file: int, blocks: dict[int, tuple[int, int]], files: set[int], dim: int, kind: type):
        self.folder, self.per_file, self.places, self.files = folder, per_file, blocks, files
        self.dim, self.kind = dim, kind
        self.at, self.data = -1, None

    def blocks(self, leaf: int) -> Iterator[Block]:
        first, n = self.places.get(leaf, (0, 0))
        for block in range(first, first + n):
            file, slot = divmod(block, self.per_file)
            if file not in self.files:
                continue
            if file != self.at:
                self.at, self.data = file, np.asarray(read_array(f"{self.folder}/{file:08d}", np.uint8))
            a, b = self.data[8 * slot : 8 * slot + 16].view(np.int64)
            if a < b:
                yield Block.read(self.data[a:b], self.dim, self.kind)


class Best:
    """The best rows so far of some windows of each anchor (rows: anchors): by score, then by smaller id.

    ``low`` rises to the last of them once there are enough. A window without scores has ``low > high``.
    What is added counts from ``settle`` on, which follows by itself when as much waits as there are anchors.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.low, self.high, self.most = np.where(low <= high, low, -_NO_BOUND), high, most
        self.score = np.full((*low.shape, most), _NO_BOUND)
        self.ids = np.zeros((*low.shape, most), np.int64)
        self.found = np.zeros(low.shape, np.int64)
        self.top = np.where(low <= high, high, _NO_BOUND).max(1, initial=_NO_BOUND)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.due = 0

    def bounds(self, use, first_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The scores with which rows with ids from ``first_id`` on get into some window of some anchors."""
        tied = (self.found[use] == self.most) & (self.ids[use][..., -1] <= first_id)
        return (self.low[use] + tied).min(1, initial=-_NO_BOUND), self.top[use]

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.waiting.append((anchor, score, ids))
        self.due += len(anchor)
        if self.due >= len(self.low):
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        anchor, score, ids = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.due = [], 0
        wide = self.low.shape[1]
        at, got = [], []
        for w in range(wide):
            low, full = self.low[anchor, w], self.found[anchor, w] == self.most
            fits = (score >= low) & (score <= self.high[anchor, w])
            fits &= (score > low) | ~full | (ids < self.ids[anchor, w, -1])
            fits = np.flatnonzero(fits)
            at.append(anchor[fits] * wide + w)
            got.append(fits)
        at, got = np.concatenate(at), np.concatenate(got)
        if not len(at):
            return
        windows = np.unique(at)
        a, w = np.divmod(windows, wide)
        old = np.arange(self.most)[None] < self.found[a, w][:, None]
        at = np.concatenate([np.repeat(windows, self.found[a, w]), at])
        score = np.concatenate([self.score[a, w][old], score[got]])
        ids = np.concatenate([self.ids[a, w][old], ids[got]])
        order = np.lexsort((ids, -score, at))
        at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        order, at, rank = (x[rank < self.most] for x in (order, at, rank))
        self.score[at // wide, at % wide, rank] = score[order]
        self.ids[at // wide, at % wide, rank] = ids[order]
        self.found[a, w] = np.bincount(np.searchsorted(windows, at), minlength=len(windows))
        full = self.found[a, w] == self.most
        self.low[a[full], w[full]] = self.score[a[full], w[full], -1]


class Search:
    """Some anchors, in the order of their labels, and the rows that their windows are looked for in."""

    def __init__(self, tree: Tree, leaves: Leaves, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, homes: np.ndarray):
        self.tree, self.leaves, self.ids, self.labels, self.homes = tree, leaves, ids, labels, homes
        self.kind = exact_kind(tree.longest)
        self.points = rows.astype(self.kind)
        self.turn, self.pays = 0, True
        self.queue: list[tuple[np.ndarray, ...]] = []
        self.queued = np.zeros(0, np.int64)
        self.room = np.zeros(0, self.kind)
        low, high = np.zeros((2, len(rows)), np.int64)
        self.rings = Annuli(rows, low, high, tree.longest)

    def best(self, low: np.ndarray, high: np.ndarray, same: bool, most: int) -> Best:
        """The best rows of each window (rows: anchors). ``same``: of the anchor's label, else of other labels."""
        best = Best(low, high, most)
        if not best.low.size or not most:
            return best
        for leaf in np.unique(self.homes):
            self._scan(int(leaf), np.flatnonzero(self.homes == leaf), best, same, 0)
        for c in range(len(self.tree.root)):
            use = self._narrowed(best, np.arange(len(self.ids)), np.iinfo(np.int64).min)
            for leaf, rows in self.tree.below(self.rings, c, use).items():
                if len(rows) > 0.9 * len(use):
                    rows = use  # so that leaves can be put together
                self._scan(leaf, rows[self.homes[rows] != leaf], best, same, PAIRS_OF_SAME if same else PAIRS)
        self._compare_queued(best, same)
        best.settle()
        return best

    def _narrowed(self, best: Best, use: np.ndarray, first_id: int) -> np.ndarray:
        """The anchors that still look for scores of rows with such ids; their annuli are narrowed to these."""
        low, high = best.bounds(use, first_id)
        self.rings.low[use], self.rings.high[use] = low, high
        return use if (low <= high).all() else use[low <= high]

    def _scan(self, leaf: int, rows: np.ndarray, best: Best, same: bool, pairs: int) -> None:
        """Compare some anchors with the rows of a leaf, now or together with the next ones if these are few."""
        for block in self.leaves.blocks(leaf) if len(rows) else ():
            use, mine = self._below(block, rows, best)
            if not len(use):
                continue
            if self.queue and not np.array_equal(use, self.queued):
                self._compare_queued(best, same)
            self.queued = use
            parts = block.ids, block.labels, block.rows
            self.queue.append(parts if mine is None else tuple(x[mine] for x in parts))
            held = sum(len(x) for x, _, _ in self.queue)
            if held * len(use) >= pairs or held * block.rows[0].nbytes >= QUEUE_BYTES:
                self._compare_queued(best, same)

    def _compare_queued(self, best: Best, same: bool) -> None:
        if not self.queue:
            return
        ids, labels, rows = self.queue[0] if len(self.queue) == 1 else (np.concatenate(x) for x in zip(*self.queue))
        self.queue = []
        use = self._narrowed(best, self.queued, int(ids.min()))
        if not same:
            self._compare(use, ids, labels, rows, best, same)
            return
        own = np.unique(labels)
        if len(use) * len(ids) < PAIRS_A_LABEL * len(own):
            some = np.isin(labels, self.labels[use])
            self._compare(use[np.isin(self.labels[use], own)], ids[some], labels[some], rows[some], best, same)
            return
        order = np.argsort(labels, kind="stable")
        ids, labels, rows = ids[order], labels[order], rows[order].astype(self.kind)
        ends = [np.searchsorted(x, own, side) for x in (self.labels[use], labels) for side in ("left", "right")]
        for a, b, first, last in zip(*ends):
            if a < b:
                self._compare(use[a:b], ids[first:last], labels[first:last], rows[first:last], best, same)

    def _below(self, block: Block, use: np.ndarray, best: Best) -> tuple[np.ndarray, np.ndarray | None]:
        """The anchors with an annulus that meets a child of the block, and the rows of the children that any meets.

        Asked as long as that leaves out a quarter of the pairs, and now and then. No rows: all.
        """
        self.turn += 1
        if not self.pays and self.turn % 32:
            return use, None
        pairs = len(use) * len(block.ids)
        use = self._narrowed(best, use, int(block.ids.min()))
        meet = self.rings.alive(block.splits, block.low, block.high, slice(None) if len(use) == len(self.ids) else use)
        use, mine = use[meet.any(1)], np.flatnonzero(np.repeat(meet.any(0), np.diff(block.ends)))
        self.pays = len(use) * len(mine) <= 0.75 * pairs
        return use, None if len(mine) == len(block.ids) else mine

    def _compare(self, use: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, best: Best, same: bool) -> None:
        if not len(use) or not len(ids):
            return
        low, high = (x[use].astype(self.kind) for x in (self.rings.low, self.rings.high))
        points = self.points if len(use) == len(self.ids) else self.points[use]
        others = rows.astype(self.kind, copy=False).T
        step = max(1, SCORES // len(ids))
        if len(self.room) < step * len(ids):
            self.room = np.empty(step * len(ids), self.kind)
        for first in range(0, len(use), step):
            part = points[first : first + step]
            s = np.matmul(part, others, out=self.room[: len(part) * len(ids)].reshape(len(part), len(ids)))
            # few anchors have such a score in a block, once their windows are narrow
            some = np.flatnonzero(s.max(1) >= low[first : first + step])
            if not len(some):
                continue
            s, some = s[some], some + first
            fits = (s >= low[some, None]) & (s <= high[some, None])
            some = use[some]
            fits &= (self.labels[some][:, None] == labels[None]) == same
            fits &= self.ids[some][:, None] != ids[None]
            x, y = np.nonzero(fits)
            for at in range(0, len(x), MOST_ADDED):
                a, b = x[at : at + MOST_ADDED], y[at : at + MOST_ADDED]
                best.add(some[a], s[a, b].astype(np.int64), ids[b])


def _share(score: int, percent: int, up: bool) -> int:
    """That many percent of a score, rounded, as far as scores go."""
    return max(_NO_BOUND, min(-_NO_BOUND, -(-score * percent // 100) if up else score * percent // 100))


def _mine(tree: Tree, leaves: Leaves, positives: int, negatives: int, window: tuple[int, int]):
    """The hard negatives of blocks of anchors."""

    def found(search: Search) -> tuple[np.ndarray, ...]:
        n = len(search.ids)
        near = search.best(np.full((n, 1), _NO_BOUND), np.full((n, 1), -_NO_BOUND), True, positives)
        score, ids = near.score[:, 0], near.ids[:, 0]
        low, high = (
            np.array([_share(x, p, up) for x in score.ravel().tolist()], np.int64).reshape(score.shape)
            for p, up in zip(window, (True, False))
        )
        asked = (np.arange(positives)[None] < near.found) & (score >= 0)
        far = search.best(np.where(asked, low, 1), np.where(asked, high, 0), False, negatives)
        a, w, rank = np.nonzero(np.arange(negatives)[None, None] < far.found[..., None])
        return search.ids[a], ids[a, w], (rank + 1).astype(np.int32), far.ids[a, w, rank], score[a, w], far.score[a, w, rank]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        for batch in batches:
            for at in range(batch.num_rows):
                cell = lambda name, kind: np.frombuffer(batch.column(name)[at].as_py(), kind)  # noqa: B023, E731
                ids, labels, homes = cell("ids", np.int64), cell("labels", np.int32), cell("homes", np.int32)
                rows = cell("rows", leaves.kind).reshape(len(ids), leaves.dim)
                order = np.argsort(labels, kind="stable")
                for some in np.array_split(order, -(-len(order) // MOST_ANCHORS)):
                    got = found(Search(tree, leaves, rows[some], ids[some], labels[some], homes[some]))
                    if len(got[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names)

    return run


# -- the operator -----------------------------------------------------------------------------------


class Index:
    """All usable rows in blocks of the tree's leaves, and the anchors among them in blocks of their own."""

    def __init__(self, rows: DataFrame, anchor: Column):
        rows = staged(rows, "usable")
        sizes = rows.select("vec").mapInArrow(_sizes, "n long, dim int, longest double")
        n, dim, longest = sizes.agg(F.sum("n"), F.max("dim"), F.max("longest")).first()
        self.empty = not n
        if self.empty:
            return
        self.dim, self.longest = max(1, dim), float(longest)
        sample = np.unique(_matrix(_few(rows, n)["vec"].combine_chunks(), self.dim), axis=0)
        fan = min(max(2, math.ceil(math.sqrt(n / BLOCK))), MOST_FAN)
        self.tree = tree = Tree(sample, fan, self.longest)
        kinds = "vec_id long, label int, vec binary, leaf int, deal int"
        placed = staged(rows.mapInArrow(_assign(tree, self.dim), kinds), "vectors")
        kinds = "node int, i int, j int, low double, high double"
        measured = placed.select("vec", "leaf").mapInArrow(_measure(tree, self.dim), kinds)
        measured = measured.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        for r in measured.toLocalIterator():
            low, high = tree.ranges[r["node"]]
            low[r["i"], r["j"]], high[r["i"], r["j"]] = r["low"], r["high"]
        # A row for each leaf, 64 * 64 at most.
        counts = placed.groupBy("leaf").agg(F.count(F.lit(1)), F.count(F.when(anchor, 1))).orderBy("leaf").collect()
        self.leaves = self._write(placed, [(leaf, c) for leaf, c, _ in counts])
        total = sum(c for _, _, c in counts)
        # blocks and their size grow alike: all rows are read once for each block
        size = max(1, min(-(-total // LEAST_ANCHOR_BLOCKS), MOST_ANCHORS, 4 * math.isqrt(total)))
        deals, at, held = [], 0, 0
        for leaf, _, c in counts:
            # leaves with few anchors share a block, one with many has several
            if held and held + c > size:
                at, held = at + 1, 0
            parts = max(1, -(-c // size))
            deals.append((leaf, parts, at))
            at, held = (at, held + c) if parts == 1 else (at + parts, 0)
        kinds = "block int, ids binary, labels binary, homes binary, rows binary"
        packed = self._dealt(placed.where(anchor), deals).groupBy("block").applyInArrow(_pack_anchors(self.dim, self.longest), kinds)
        self.anchors = staged(packed, "anchors").repartitionByRange(at + 1, "block")

    def _dealt(self, placed: DataFrame, deals: list) -> DataFrame:
        """The rows with the block that they are dealt to, whatever ids they have."""
        deal = placed.sparkSession.createDataFrame(deals, "leaf int, parts int, first int")
        block = F.pmod(F.xxhash64("vec_id", "deal"), F.col("parts")) + F.col("first")
        return placed.join(F.broadcast(deal), "leaf").select("vec_id", "label", "vec", "leaf", "deal", block.cast("int").alias("block"))

    def _write(self, placed: DataFrame, counts: list[tuple[int, int]]) -> Leaves:
        kind = stored_kind(self.longest)
        folder = scratch_path(placed.sparkSession, "leaves")
        places, at = {}, 0
        for leaf, c in counts:
            places[leaf] = at, max(1, -(-c // BLOCK))
            at += places[leaf][1]
        most = FILE_BYTES // (BLOCK * self.dim * np.dtype(kind).itemsize)
        per_file = max(1, min(most, at // LEAST_FILES))
        rows = self._dealt(placed, [(leaf, n, first) for leaf, (first, n) in places.items()])
        file = (F.col("block") / per_file).cast("int").alias("file")
        rows = rows.select("vec_id", "label", "vec", "deal", "block", file)
        written = rows.groupBy("file").applyInArrow(_write_blocks(folder, per_file, self.dim, self.longest), "file int")
        return Leaves(folder, per_file, places, {r["file"] for r in written.collect()}, self.dim, kind)


def _few(rows: DataFrame, n: int) -> pa.Table:
    """The rows with the smallest hashes, which split points are picked from."""
    order = F.xxhash64("vec_id", "label", "vec")
    if n > 4 * SAMPLE:
        # all of them lie below twice their share of the hashes, unless rows repeat
        below = rows.where(order < -(1 << 63) + (1 << 64) * 2 * SAMPLE // n)
        few = below.orderBy(order).limit(SAMPLE).select("vec").toArrow()
        if len(few) == SAMPLE:
            return few
    return rows.orderBy(order).limit(SAMPLE).select("vec").toArrow()


def mine(
    vectors: DataFrame,
    anchor: Column,
    label: Column | str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """Hard negatives of each anchor and each of its positives.

    ``anchor`` is a condition on ``vec_id``. A row's score is its integer inner product with the anchor
    (components ``floor(256 * x)``). The positives are the best rows of the anchor's label, the negatives
    the best rows of other labels whose scores lie between ``window`` percent of the positive's; ties
    go to smaller ids. Negative positive scores have an empty window.

    Rows without id, label or vector, with a null or non-finite component or one of 2**18 and more take
    no part; shorter vectors are filled with zeros. Rows with the anchor's own ``vec_id`` are not its
    partners; other repeated rows are rows of their own. An empty table gives no rows. Other columns
    are not read.
    """
    label = F.col(label) if isinstance(label, str) else label
    index = Index(usable(vectors, vector, label), anchor)
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if index.empty:
        return vectors.sparkSession.createDataFrame([], kinds)
    return index.anchors.mapInArrow(_mine(index.tree, index.leaves, positives, negatives, window), kinds)
