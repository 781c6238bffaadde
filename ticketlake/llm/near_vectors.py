"""Near-duplicate vectors by a forest of random-projection trees.

Vectors with equal labels are compared by cosine in double precision and linked from 0.98 up.

Each tree splits a node along a random direction at the median; vectors within ``spill`` of the split go
to both sides, so a close pair is rarely parted, and ``TREES`` trees make up for the rest.  Splits are
fitted in rounds: Spark counts the nodes, each node with more than ``LEAF`` vectors gives a bounded
sample, and one task per node fits up to ``DEPTH`` levels on it; directions come from the node's name,
so the forest is its thresholds alone.  A node that a split does not thin out, such as a tight cluster,
becomes a leaf of any size.  Every vector is sent down all trees.

Vectors are compared within leaves only, large leaves in blocks; a pair counts in the first leaf that
both share, so each link is counted once and no row is made per pair.  Equal vectors are one class with
a number of copies.

Defined results: null vectors, zero vectors, those with a null or non-finite component, and those with
a null label are linked with nothing; vectors of different lengths are not compared; rows that repeat a
vec_id each count; a null vec_id takes part and sorts last; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import classes_of, in_units, ragged, run_units, settle
from .common import kept

THRESHOLD = 0.98
TREES = 6
LEAF = 1024
DEPTH = 8
#: Vectors per leaf-to-be in the sample of a node.
SAMPLE = 64
#: Thresholds that the forest may hold: 64 MB.  Beyond them leaves stay larger, and are compared in blocks.
MAX_SPLITS = 8_000_000
BLOCK = 1024


def marks(vectors: DataFrame) -> DataFrame:
    """(vec_id, key1, key2, space, vector): space stands for label and length; null keys: links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, labels = batch.column("embedding"), batch.column("label").to_pylist()
            key1, key2, space, raw = [], [], [], []
            for value, label in zip(lists, labels, strict=True):
                v = None
                if value.is_valid and label is not None and not value.values.null_count and len(value.values):
                    v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    most = np.abs(v).max()
                    if np.isfinite(most) and most > 0:
                        # A power of two: the same direction, and squares neither overflow nor vanish.
                        v = np.ldexp(v, -int(np.frexp(most)[1])) + 0.0
                    else:
                        v = None
                if v is None:
                    key1.append(None), key2.append(None), space.append(None), raw.append(None)
                    continue
                own = v.tobytes()
                name = f"{label!r}/{len(v)}".encode()
                found = xxhash.xxh3_128_intdigest(name + b"\0" + own)
                key1.append((found >> 64) - (1 << 63)), key2.append((found & ((1 << 64) - 1)) - (1 << 63))
                space.append(xxhash.xxh3_64_intdigest(name) - (1 << 63)), raw.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), *[pa.array(c, pa.int64()) for c in (key1, key2, space)], pa.array(raw, pa.binary())],
                names=["vec_id", "key1", "key2", "space", "vector"],
            )

    schema = "vec_id bigint, key1 bigint, key2 bigint, space bigint, vector binary"
    return vectors.select("vec_id", "embedding", "label").mapInArrow(run, schema)


def directions(node: int, tree: int, depth: int, dim: int) -> np.ndarray:
    """Unit directions of the splits below a node, in heap order."""
    rng = np.random.default_rng([tree, node & 0xFFFFFFFF, (node >> 32) & 0xFFFFFFFF])
    found = rng.standard_normal(((1 << depth) - 1, dim))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def spill(dim: int) -> float:
    """Half the width of the shared strip: how far apart a pair at the threshold lies along a direction, usually."""
    return float(np.sqrt(2 - 2 * THRESHOLD) / np.sqrt(dim))


def unit_rows(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_node(x: np.ndarray, node: int, tree: int, depth: int) -> np.ndarray:
    """Thresholds of the splits below a node in heap order; not a number where it ends."""
    way = directions(node, tree, depth, x.shape[1])
    cuts = np.full(len(way), np.nan)
    strip = spill(x.shape[1])
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        p = x[rows] @ way[at]
        cut = float(np.median(p))
        low, high = rows[p <= cut + strip], rows[p >= cut - strip]
        if max(len(low), len(high)) > 0.8 * len(rows):
            continue
        cuts[at] = cut
        for child, part in ((2 * at + 1, low), (2 * at + 2, high)):
            if child < len(cuts) and len(part) > SAMPLE:
                todo.append((child, part))
    return cuts


def child_name(node: int, tree: int, at: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{tree}/{node}/{at}".encode()) - (1 << 63)


class Forest:
    """Thresholds by tree and node; a node's name is that of its space or of its place below another."""

    def __init__(self):
        self.cuts: dict[tuple[int, int], np.ndarray] = {}
        self.splits = 0

    def add(self, tree: int, node: int, cuts: np.ndarray) -> None:
        self.cuts[tree, node] = cuts
        self.splits += len(cuts)

    def leaves(self, x: np.ndarray, tree: int, root: int) -> list[tuple[int, np.ndarray]]:
        """The leaves below a root and the rows that reach each."""
        done = []
        todo = [(root, np.arange(len(x)))]
        strip = spill(x.shape[1])
        while todo:
            node, rows = todo.pop()
            cuts = self.cuts.get((tree, node))
            if cuts is None:
                done.append((node, rows))
                continue
            way = directions(node, tree, int(len(cuts) + 1).bit_length() - 1, x.shape[1])
            inner = [(0, rows)]
            while inner:
                at, some = inner.pop()
                if not len(some):
                    continue
                if at >= len(cuts) or np.isnan(cuts[at]):
                    name = node if at == 0 else child_name(node, tree, at)
                    if at == 0:
                        done.append((name, some))
                    else:
                        todo.append((name, some))
                    continue
                p = x[some] @ way[at]
                inner.append((2 * at + 1, some[p <= cuts[at] + strip]))
                inner.append((2 * at + 2, some[p >= cuts[at] - strip]))
        return done


def send_down(firsts: DataFrame, forest: Forest) -> DataFrame:
    """(uid, copies, space, vector, leaves): the tree and node of every leaf that a vector reaches."""
    shared = firsts.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            spaces = batch.column("space").to_numpy()
            raw = batch.column("vector").to_pylist()
            trees: list[list[int]] = [[] for _ in raw]
            nodes: list[list[int]] = [[] for _ in raw]
            for space in np.unique(spaces).tolist():
                rows = np.flatnonzero(spaces == space)
                x = unit_rows([raw[i] for i in rows])
                for tree in range(TREES):
                    for node, some in own.leaves(x, tree, space):
                        for i in rows[some].tolist():
                            trees[i].append(tree)
                            nodes[i].append(node)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(trees, pa.list_(pa.int32())), pa.array(nodes, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "trees", "nodes"],
            )

    base = firsts.select("uid", "copies", "space", "vector")
    return base.mapInArrow(
        run, "uid bigint, copies bigint, space bigint, vector binary, trees array<int>, nodes array<bigint>"
    )


def grow(firsts: DataFrame, leaf: int, rounds: int = 12) -> Forest:
    """Fit splits until every node is a leaf."""
    forest = Forest()
    ended: set[tuple[int, int]] = set()
    for _ in range(rounds):
        sent = send_down(firsts, forest)
        at = sent.select("uid", "vector", F.explode(F.arrays_zip("trees", "nodes")).alias("at")).select(
            "uid", "vector", F.col("at.trees").alias("tree"), F.col("at.nodes").alias("node")
        )
        # No more nodes than vectors / leaf are large; the check of the forest's size bounds them too.
        large = at.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf)
        large = kept(large, "large-nodes")
        if forest.splits + large.count() > MAX_SPLITS:
            return forest
        depth = F.least(F.lit(DEPTH), F.ceil(F.log2(F.col("n") / leaf))).cast("int")
        plan = large.withColumn("depth", depth).withColumn("take", F.expr(f"shiftleft({SAMPLE}, depth)"))
        picked = at.join(plan, ["tree", "node"]).filter(F.pmod(F.xxhash64("uid", "tree"), F.col("n")) < F.col("take"))

        def fit(part: pd.DataFrame) -> pd.DataFrame:
            tree, node, depth = (int(part[c].iloc[0]) for c in ("tree", "node", "depth"))
            x = unit_rows(part.sort_values("uid")["vector"].tolist())
            return pd.DataFrame({"tree": [tree], "node": [node], "cuts": [fit_node(x, node, tree, depth).tolist()]})

        fitted = (
            picked.select("tree", "node", "depth", "uid", "vector")
            .groupBy("tree", "node")
            .applyInPandas(fit, "tree int, node bigint, cuts array<double>")
            .collect()
        )
        new = 0
        for row in fitted:
            name = (row["tree"], row["node"])
            cuts = np.array([np.nan if c is None else c for c in row["cuts"]])
            if name not in ended and name not in forest.cuts and not np.isnan(cuts[0]):
                forest.add(*name, cuts)
                new += 1
            else:
                ended.add(name)
        if not new:
            return forest
    return forest


def compare(table: pa.Table):
    vectors, bounds = ragged(table, "vector", "f8")
    lists = table["leaves"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends = np.asarray(lists.offsets).astype(np.int64)
    codes = lists.values.to_numpy()
    here = table["leaf"].to_numpy()

    def padded(start: int, rows: np.ndarray) -> np.ndarray:
        sizes = ends[start + rows + 1] - ends[start + rows]
        out = np.zeros((len(rows), int(sizes.max())), np.int64)
        filled = np.arange(out.shape[1])[None, :] < sizes[:, None]
        out[filled] = np.concatenate([codes[ends[start + r] : ends[start + r + 1]] for r in rows])
        return np.where(filled, out, np.iinfo(np.int64).max)

    def pairs(start: int, end: int, side):
        v = vectors[bounds[start] : bounds[end]].reshape(end - start, -1)
        norm = np.sqrt(np.einsum("ij,ij->i", v, v))
        if side is None:
            left = right = np.arange(end - start)
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = []
        step = max(1, 2_000_000 // max(1, len(right)))
        for s in range(0, len(left), step):
            rows = left[s : s + step]
            a, b = np.nonzero(v[rows] @ v[right].T >= THRESHOLD * norm[rows][:, None] * norm[right][None, :] * (1 - 1e-12))
            a, b = rows[a], right[b]
            if side is None:
                a, b = a[a < b], b[a < b]
            cosine = np.einsum("ij,ij->i", v[a], v[b]) / (norm[a] * norm[b])
            found.append((a[cosine >= THRESHOLD], b[cosine >= THRESHOLD]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        if not len(a):
            return a, b
        # The pair counts here if this is the first leaf that both reach.
        used = np.unique(np.concatenate([a, b]))
        mine = padded(start, used)
        first = np.empty(len(a), np.int64)
        none = np.iinfo(np.int64).max
        for s in range(0, len(a), 50_000):
            p, q = mine[np.searchsorted(used, a[s : s + 50_000])], mine[np.searchsorted(used, b[s : s + 50_000])]
            shared = (p[:, :, None] == q[:, None, :]).any(2)
            first[s : s + 50_000] = np.where(shared, p, none).min(1)
        keep = first == here[start]
        return a[keep], b[keep]

    return pairs


def link(vectors: DataFrame, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """(uid, vec_id, class_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label)."""
    marked = kept(marks(vectors).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    classes = kept(classes_of(marked, "vec_id"), "vector-classes")
    firsts = kept(classes.select("uid", "copies").join(marked.select("uid", "space", "vector"), "uid"), "first-vectors")
    forest = grow(firsts, leaf)
    sent = send_down(firsts, forest)
    # A leaf's code: tree and node, spread; its order is the same for all vectors.
    code = F.transform(F.arrays_zip("trees", "nodes"), lambda x: F.xxhash64(x["trees"], x["nodes"]))
    coded = sent.select("uid", "copies", "vector", F.array_distinct(code).alias("leaves"))
    rows = coded.select("uid", "copies", "vector", "leaves", F.explode("leaves").alias("leaf"))
    sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    units = in_units(rows.join(sizes, "leaf"), [F.col("leaf")], F.col("n"), block).drop("n")
    found = kept(run_units(units, compare), "vector-links")
    return settle(marked, classes, found, "vec_id", "vector-groups")
