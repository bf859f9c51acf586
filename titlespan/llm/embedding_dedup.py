"""Operator 10: exact near-duplicates among embeddings by dual traversal of cover trees.

Equal vectors are one class. Classes go to the nearest of a bounded number of pivots and there
into blocks of bounded size, each with a cover tree: nested levels whose radii halve, every
node knowing how far its points reach. Two trees are walked together; a pair of nodes is
dropped if even their nearest points are too far apart, taken whole if even their farthest
ones are near enough, and opened otherwise. Points that no bound decides are compared by
cosine in double precision. What leaves a task are sums of links and a spanning forest.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.llm.common import join_groups, quoted_name, table, written
from titlespan.llm.links import components

COSINE = 0.9
#: Classes of a block, and pivots at most.
BLOCK = 8192
PIVOTS = 2048
#: Points of a node that is not divided any more, if they are so near its middle, and rows of a
#: matrix of distances.
LEAF = 8
TIGHT = 0.2
CHUNK = 512
#: Distances nearer than this to a bound are not decided by it.
MARGIN = 1e-6
#: More than products of unit vectors are wrong by in single precision.
ROUGH = 1e-4


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (left @ right.T)))


@dataclass
class Node:
    center: int
    low: int
    high: int
    reach: float
    children: list[Node] = field(default_factory=list)


class CoverTree:
    """Points in the tree's order, each node a range of them around one of its points."""

    def __init__(self, raw: np.ndarray, sizes: np.ndarray):
        points = unit(raw)
        order: list[int] = []
        self.root = self._node(points, np.arange(len(raw)), 2.0, order)
        at = np.array(order)
        self.order, self.raw, self.points, self.sizes = at, raw[at], points[at], sizes[at]
        self.sums = np.concatenate([[0], np.cumsum(self.sizes)])
        place = np.empty(len(at), int)
        place[at] = np.arange(len(at))
        stack = [self.root]
        while stack:
            node = stack.pop()
            node.center = int(place[node.center])
            stack += node.children

    def _node(self, points, members, radius, order, distances=None) -> Node:
        """A node around its first member; `distances` are those of the members to it."""
        center = members[0]
        if distances is None:
            distances = apart(points[members], points[center : center + 1])[:, 0]
        low, reach = len(order), float(distances.max())
        node = Node(int(center), low, low + len(members), reach)
        if len(members) == 1 or reach < MARGIN or (len(members) <= LEAF and reach <= TIGHT):
            order += members.tolist()
            return node
        while radius > reach:  # levels at which the node would have one child
            radius /= 2
        # Children start below this radius, also where one of them is all of the node.
        for near, own in _covered(points[members], radius):
            node.children.append(self._node(points, members[near], radius / 2, order, own))
        return node

    def __getstate__(self):
        """What travels: the vectors, in half the room where that loses nothing."""
        small = self.raw.astype(np.float32)
        raw = small if np.array_equal(small.astype(np.float64), self.raw) else self.raw
        return {"raw": raw, "sizes": self.sizes, "order": self.order, "root": self.root}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.raw = self.raw.astype(np.float64)
        self.points = unit(self.raw)
        self.sums = np.concatenate([[0], np.cumsum(self.sizes)])


def _covered(points: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The points in balls around the first point that no ball before has: places and distances
    to the ball's middle, the middle first."""
    left = np.ones(len(points), bool)
    # Any cover will do, as nodes are told how far they reach: single precision is enough while it
    # can tell points a radius apart.
    quick = points.astype(np.float32) if radius * radius > 16 * ROUGH else points
    start = 0
    while start < len(points):
        middles = start + np.flatnonzero(left[start : start + 8 * CHUNK])[:CHUNK]
        start = int(middles[-1]) + 1 if len(middles) else start + 8 * CHUNK
        rest = np.flatnonzero(left)
        if not len(middles):
            continue
        dots = quick[middles] @ quick[rest].T
        within = dots >= 1.0 - radius * radius / 2.0
        for i, middle in enumerate(middles.tolist()):
            if not left[middle]:
                continue
            here = rest[within[i]]
            here = here[left[here]]
            here = np.concatenate([[middle], here[here != middle]])
            left[here] = False
            yield here, apart(points[here], points[middle : middle + 1])[:, 0]


class Walk:
    """The links between the points of two trees, or within one."""

    def __init__(self, left: CoverTree, right: CoverTree, cosine: float):
        self.left, self.right, self.same = left, right, left is right
        self.cosine, self.far = cosine, float(np.sqrt(2 - 2 * cosine))
        self.steps = [np.zeros(len(t.points) + 1, np.int64) for t in (left, right)]
        self.shift = 0 if self.same else len(left.points)
        self.parent = list(range(len(left.points) + (0 if self.same else len(right.points))))
        self.joined: set[tuple[int, int, int]] = set()
        if self.same:
            self._within(left.root)
        else:
            self._across([left.root], [right.root])

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def _join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def _all(self, side: int, node: Node, size: int) -> None:
        self.steps[side][node.low] += size
        self.steps[side][node.high] -= size

    def _joined(self, side: int, node: Node) -> int:
        """One point that stands for all of a node, whose points are linked through others."""
        shift = self.shift * side
        key = (side, node.low, node.high)
        if key not in self.joined:
            self.joined.add(key)
            for i in range(node.low + 1, node.high):
                self._join(shift + node.low, shift + i)
        return shift + node.low

    def _taken(self, a: Node, b: Node) -> None:
        """Every point of `a` is linked with every point of `b`."""
        left, right = self.left, self.right
        self._all(0, a, int(right.sums[b.high] - right.sums[b.low]))
        self._all(0 if self.same else 1, b, int(left.sums[a.high] - left.sums[a.low]))
        self._join(self._joined(0, a), self._joined(0 if self.same else 1, b))

    def _fine(self, nodes: list[Node]) -> list[Node]:
        """The nodes, those too wide to be taken whole replaced by what is below them."""
        out, stack = [], list(nodes)
        while stack:
            node = stack.pop()
            if node.children and 2 * node.reach > self.far - 2 * MARGIN:
                stack += node.children
            else:
                out.append(node)
        return out

    def _within(self, root: Node) -> None:
        """All pairs of a tree's points."""
        tree, nodes = self.left, self._fine([root])
        for node in nodes:
            if 2 * node.reach > self.far - MARGIN:
                self._points(node, node)
                continue
            inside = slice(node.low, node.high)
            self._all(0, node, int(tree.sums[node.high] - tree.sums[node.low]))
            self.steps[0][inside] -= tree.sizes[inside]
            self.steps[0][node.low + 1 : node.high + 1] += tree.sizes[inside]
            self._joined(0, node)
        self._between(nodes, nodes)

    def _across(self, first: list[Node], second: list[Node]) -> None:
        """All pairs of nodes of two trees. While the lists are short, pairs of wide nodes that are
        too far apart go, level by level; beyond that, wide nodes give way to those below them,
        whose narrow bounds decide nearly all pairs at once."""
        wide = {id(n) for n in (*first, *second) if n.children and 2 * n.reach > self.far - 2 * MARGIN}
        if wide and len(first) * len(second) <= CHUNK:
            for a in first:
                for b in second:
                    gap = apart(self.left.points[a.center : a.center + 1], self.right.points[b.center : b.center + 1])
                    if float(gap[0, 0]) - a.reach - b.reach <= self.far + MARGIN:
                        below = [n.children if id(n) in wide else [n] for n in (a, b)]
                        if id(a) not in wide and id(b) not in wide:
                            self._between([a], [b])
                        else:
                            self._across(*below)
            return
        self._between(self._fine(first), self._fine(second))

    def _between(self, first: list[Node], second: list[Node]) -> None:
        """All pairs of two lists of nodes; of one list with itself, each pair once."""
        once = first is second
        at = np.array([n.center for n in second])
        reach = np.array([n.reach for n in second])
        other = self.right.points[at]
        quick = other.astype(np.float32).T
        for start in range(0, len(first), CHUNK):
            part = first[start : start + CHUNK]
            own = np.array([n.reach for n in part])
            middles = self.left.points[[n.center for n in part]]
            # Nothing is nearer than the widest pair of the part allows: most pairs end here, in
            # single precision; the others are measured in double.
            widest = self.far + MARGIN + own.max() + reach.max()
            dots = middles.astype(np.float32) @ quick
            rows, columns = np.nonzero(dots >= np.float32(1.0 - widest * widest / 2.0 - ROUGH))
            if once:
                later = columns > rows + start
                rows, columns = rows[later], columns[later]
            exact = np.einsum("ij,ij->i", middles[rows], other[columns])
            distance = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * exact))
            bound = own[rows] + reach[columns]
            near = distance - bound <= self.far + MARGIN
            whole = distance + bound <= self.far - MARGIN
            for i, j, taken in zip(
                rows[near].tolist(), columns[near].tolist(), whole[near].tolist(), strict=True
            ):
                a, b = part[i], second[j]
                if taken:
                    self._taken(a, b)
                elif a.children or b.children:
                    self._between(a.children or [a], b.children or [b])
                else:
                    self._points(a, b)

    def _points(self, a: Node, b: Node) -> None:
        left, right = self.left, self.right
        one, two = left.raw[a.low : a.high], right.raw[b.low : b.high]
        norms = np.linalg.norm(one, axis=1)[:, None] * np.linalg.norm(two, axis=1)[None, :]
        linked = (one @ two.T) / norms >= self.cosine
        if a is b:
            linked &= ~np.eye(len(one), dtype=bool)
        side = 0 if self.same else 1
        for i, j in zip(*np.nonzero(linked), strict=True):
            i, j = a.low + int(i), b.low + int(j)
            if a is b:
                if i < j:
                    self._join(i, j)
                self._one(0, i, right.sizes[j])
            else:
                self._one(0, i, right.sizes[j])
                self._one(side, j, left.sizes[i])
                self._join(i, self.shift * side + j)

    def _one(self, side: int, i: int, size: int) -> None:
        self.steps[side][i] += size
        self.steps[side][i + 1] -= size

    def links(self) -> list[np.ndarray]:
        """By tree and point in the tree's order: linked vectors."""
        return [np.cumsum(s)[:-1] for s in self.steps[: 1 if self.same else 2]]


def _usable(cell) -> np.ndarray | None:
    if cell is None or not len(cell) or any(x is None for x in cell):
        return None
    vector = np.asarray(cell, np.float64)
    size = np.linalg.norm(vector)
    return vector if np.isfinite(vector).all() and np.isfinite(size) and size > 0 else None


def classed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`(vec_id, class, vector)`; both null where a vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_usable(v) for v in batch.column(1).to_pylist()]
            data = [None if v is None else (v + 0.0).tobytes() for v in found]
            keys = [None if d is None else hashlib.blake2b(d, digest_size=16).digest() for d in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(data, pa.binary())],
                ["vec_id", "class", "vector"],
            )

    narrow = vectors.select(
        quoted_name(id_col).alias("vec_id"),
        quoted_name(vector_col).cast("array<double>").alias("vector"),
    )
    kind = narrow.schema["vec_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"vec_id {kind}, class binary, vector binary")


def _doubles(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def _celled(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """`(cell, class, size, vector, distance)`: the nearest pivot of the vector's dimension."""
    spans = {}
    for dimension, rows in pivots.items():
        spans[dimension] = sum(len(p) for p in list(spans_rows(pivots, dimension)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("vector").to_pylist()
            lengths = np.array([len(d) // 8 for d in data])
            cells, distances = np.zeros(len(data), np.int64), np.zeros(len(data))
            for dimension in np.unique(lengths):
                at = np.flatnonzero(lengths == dimension)
                away = apart(unit(_doubles([data[i] for i in at])), pivots[int(dimension)])
                cells[at] = spans[int(dimension)] + away.argmin(axis=1)
                distances[at] = away.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), batch.column("class"), batch.column("size"), batch.column("vector"), pa.array(distances)],
                ["cell", "class", "size", "vector", "distance"],
            )

    return classes.select("class", "size", "vector").mapInArrow(
        run, "cell long, class binary, size long, vector binary, distance double"
    )


def spans_rows(pivots: dict[int, np.ndarray], dimension: int) -> Iterator[np.ndarray]:
    """The pivots of the dimensions before this one: cells are numbered through."""
    return (rows for d, rows in sorted(pivots.items()) if d < dimension)


def _near_cells(spark: SparkSession, pivots, reach: dict[int, float], cosine: float) -> DataFrame:
    """`(one, other)`: cells whose points may link, by their pivots and reaches."""
    pairs, far = [], float(np.sqrt(2 - 2 * cosine))
    for dimension, rows in sorted(pivots.items()):
        base = sum(len(p) for p in spans_rows(pivots, dimension))
        own = np.array([reach.get(base + i, -np.inf) for i in range(len(rows))])
        for i in range(len(rows)):
            gap = apart(rows[i : i + 1], rows[i:])[0] - own[i] - own[i:]
            pairs += [(base + i, base + i + int(j)) for j in np.flatnonzero(gap <= far + MARGIN)]
    pairs = [p for p in pairs if p[0] in reach and p[1] in reach]
    columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, ["one", "other"]))


def _blocks(celled: DataFrame) -> DataFrame:
    """`(block, cell, classes, tree)`: a row for each block of at most about `BLOCK` classes, with
    its cover tree and the classes in the tree's order."""
    counts = celled.groupBy("cell").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = celled.join(F.broadcast(counts), "cell").withColumn(
        "block", F.concat_ws("-", "cell", F.pmod(F.xxhash64("class"), blocks))
    )
    kind = pa.schema(
        [("block", pa.string()), ("cell", pa.int64()), ("classes", pa.list_(pa.binary())), ("tree", pa.binary())]
    )

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("class")
        tree = CoverTree(
            _doubles(rows.column("vector").to_pylist()), rows.column("size").to_numpy().astype(np.int64)
        )
        classes = rows.column("class").to_pylist()
        row = {
            "block": rows.column("block")[0].as_py(),
            "cell": rows.column("cell")[0].as_py(),
            "classes": [classes[i] for i in tree.order],
            "tree": pickle.dumps(tree),
        }
        return pa.Table.from_pylist([row], kind)

    narrow = placed.select("block", "cell", "class", "size", "vector")
    return narrow.groupBy("block").applyInArrow(
        build, "block string, cell long, classes array<binary>, tree binary"
    )


def linked(classes: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Of written `(class, size, vector)`: links by class `(class, links)` and edges `(a, b)`."""
    spark = classes.sparkSession
    dimensions = [r[0] for r in classes.select(F.length("vector")).distinct().limit(PIVOTS).collect()]
    pivots: dict[int, np.ndarray] = {}
    for length in dimensions:
        own = classes.filter(F.length("vector") == length)
        wanted = min(PIVOTS // len(dimensions) or 1, max(1, -(-own.count() // BLOCK)))
        rows = own.orderBy(F.xxhash64("class"), "class").limit(wanted).collect()
        pivots[length // 8] = unit(_doubles([bytes(r["vector"]) for r in rows]))
    celled = written(_celled(classes, pivots), "embed-cells")
    reach = {r[0]: r[1] for r in celled.groupBy("cell").agg(F.max("distance")).collect()}
    blocks = written(_blocks(celled), "embed-blocks")
    cells = _near_cells(spark, pivots, reach, cosine)
    names = blocks.select("block", "cell")
    pairs = (
        cells.join(names.selectExpr("cell AS one", "block AS first"), "one")
        .join(names.selectExpr("cell AS other", "block AS second"), "other")
        .filter("one < other OR first <= second")
        .select("first", "second")
    )
    sides = [
        blocks.select(
            F.col("block").alias(n), F.col("classes").alias(f"classes_{n}"), F.col("tree").alias(f"tree_{n}")
        )
        for n in ("first", "second")
    ]
    joined = pairs.join(sides[0], "first").join(sides[1], "second")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, CoverTree] = {}

        def tree(block: str, data: pa.Scalar) -> CoverTree:
            if block not in trees:
                if len(trees) >= 4:
                    trees.clear()
                trees[block] = pickle.loads(data.as_py())
            return trees[block]

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: c[i] for n, c in zip(batch.schema.names, batch.columns, strict=True)}
                sides = ("first", "second")
                yield found(
                    [tree(row[n].as_py(), row[f"tree_{n}"]) for n in sides],
                    [row[f"classes_{n}"].as_py() for n in sides],
                )

    def found(trees: list[CoverTree], classes: list[list[bytes]]) -> pa.RecordBatch:
        walk = Walk(*trees, cosine)
        names = classes[0] if walk.same else classes[0] + classes[1]
        links = np.concatenate(walk.links())
        roots = [walk.find(i) for i in range(len(names))]
        some = [i for i in range(len(names)) if links[i] or roots[i] != i]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in some], pa.binary()),
                pa.array([names[roots[i]] for i in some], pa.binary()),
                pa.array(links[some] if some else [], pa.int64()),
            ],
            ["a", "b", "links"],
        )

    result = written(
        joined.repartition("first", "second").mapInArrow(run, "a binary, b binary, links long"),
        "embed-links",
    )
    sums = result.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "class")
    return sums, result.filter("a <> b").select("a", "b")


def embedding_dedup(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """`(vec_id, n_links, component_id, kept)`, one row per input row.

    Vectors are linked if their cosine is at least `cosine`; `n_links` counts the other rows a
    row is linked with. Null, empty and zero vectors and those with null or non-finite parts
    link with nothing, vectors of different length never. `component_id` is the smallest id
    reachable by links, nulls aside; repeated ids are rows of their own. Other columns are not
    looked at; an empty table gives no rows.
    """
    rows = written(classed(vectors, id_col, vector_col), "embed-rows")
    classes = written(
        rows.filter("class IS NOT NULL").groupBy("class").agg(
            F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("vector").alias("vector")
        ),
        "embed-classes",
    )
    links, edges = linked(classes, cosine)
    known = components(edges).select(F.col("node").alias("class"), F.col("component").alias("root"))
    groups = (
        classes.select("class", "least", "size")
        .join(links, "class", "left")
        .join(known, "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    groups = written(groups, "embed-groups")
    roots = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = written(groups.join(roots, "root"), "embed-found").select(
        "class", "size", "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    narrow = rows.select("vec_id", "class")
    alone = narrow.filter("class IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    others = join_groups(narrow.filter("class IS NOT NULL"), groups, "class", "size")
    both = others.select("vec_id", "n_links", "component_id").union(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))
