"""Nearest vectors by inner product, by counting collisions on sorted projections.

The index deals all vectors into shards: vectors of like length (a factor of two) form a band, a band is
cut along its widest projections by thresholds fitted on a bounded sample, and a place that still holds
more than ``SHARD`` vectors is dealt by hash.  Within a band the vectors are lifted onto a sphere of the
band's largest norm M, where the largest inner product is the smallest distance.

A shard keeps one sorted array per random projection.  A query looks at windows of these arrays centred
on its own projections, and widens them step by step (virtual rehashing); only the newly covered ends are
read.  A vector that ``COLLISIONS`` of ``PROJECTIONS`` windows hold is verified by its exact inner product.
A vector at distance r collides often enough with probability ``CATCH`` once the windows reach ``REACH`` * r
to both sides, so a query is done in a shard when its windows reach ``REACH`` times the distance that its
present last neighbour would have there: the search has no cap on candidates, and widens to whole arrays
while neighbours are missing.

Every query first searches the shard it would lie in itself.  The last score found there bounds all
others: a shard is left out if no vector of its norm could beat it, or if fewer than ``COLLISIONS`` of the
query's final windows meet the shard's span.  What is left are pairs of a query and a shard, dealt into
units of at most ``SHARD`` vectors and about ``QUERIES`` queries.

Equal vectors are one class with its smallest vec_ids, and equal queries are searched once.

Defined results: null vectors, zero vectors and those with a null or non-finite component take no part,
nor do those whose squared length is no finite double; vectors of different lengths are not compared; a
null vec_id is no query, and sorts last among ties; rows that repeat a vec_id each count, as queries too; a
query's own row is not its neighbour, a copy of it is; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept

NEIGHBOURS = 20
EVERY = 20
PROJECTIONS = 64
#: Collisions that make a candidate, and how far windows reach, as a multiple of a distance: a vector at that
#: distance then collides ``COLLISIONS`` times or more with probability ``CATCH`` (tested).
COLLISIONS = 27
REACH = 0.75
CATCH = 0.98
WIDEN = 1.5
SHARD = 16_384
QUERIES = 4_096
#: Queries whose counts are held at once.
TOGETHER = 256
#: Vectors of a band on which its cuts are fitted, and shards whose spans may be sent to all tasks.
SAMPLE = 20_000
MAX_SPANS = 40_000


# ---- classes of equal vectors


def marks(vectors: DataFrame) -> DataFrame:
    """(uid, vec_id, key, vector, dim, band, norm2) of every row that takes part.

    ``key``: a digest of the vector; ``vector``: its doubles; ``band``: the exponent of its squared norm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, key, raw, dim, band, norm2 = [], [], [], [], [], []
            for i, value in enumerate(batch.column("embedding")):
                if not value.is_valid or not len(value.values) or value.values.null_count:
                    continue
                v = value.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                if not np.isfinite(v).all() or not v.any():
                    continue
                own = v.tobytes()
                with np.errstate(over="ignore"):
                    size = max(float(v @ v), 5e-324)
                if math.isinf(size):
                    continue
                rows.append(i), key.append(xxhash.xxh3_128_digest(own)), raw.append(own), dim.append(len(v))
                norm2.append(size), band.append(math.frexp(size)[1] // 2)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(taken) for c in ("uid", "vec_id")],
                    pa.array(key, pa.binary()),
                    pa.array(raw, pa.binary()),
                    pa.array(dim, pa.int32()),
                    pa.array(band, pa.int32()),
                    pa.array(norm2, pa.float64()),
                ],
                names=["uid", "vec_id", "key", "vector", "dim", "band", "norm2"],
            )

    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"
    )
    schema = "uid bigint, vec_id bigint, key binary, vector binary, dim int, band int, norm2 double"
    return rows.mapInArrow(run, schema)


def first_rows(marked: DataFrame, most: int) -> DataFrame:
    """(key, ids): of every class the rows with the smallest vec_ids, at most ``most``, as (none, vec_id, uid)."""
    entry = F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "uid")
    order = W.partitionBy("key").orderBy("none", "vec_id", "uid")
    rows = marked.select("key", entry.alias("e")).select("key", "e", "e.none", "e.vec_id", "e.uid")
    first = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most)
    return first.groupBy("key").agg(F.array_sort(F.collect_list("e")).alias("ids"))


# ---- projections


def directions(dim: int, projections: int = PROJECTIONS) -> np.ndarray:
    """(projections, dim + 1): the directions for vectors lifted by one dimension."""
    return np.random.default_rng([dim, projections]).standard_normal((projections, dim + 1))


def as_matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def projected(x: np.ndarray, norm2: np.ndarray, most2: float, way: np.ndarray) -> np.ndarray:
    """(rows, projections) of vectors lifted onto the sphere of squared radius ``most2``, in units of that radius."""
    lift = np.sqrt(np.maximum(0.0, 1 - norm2 / most2))
    return (x / math.sqrt(most2)) @ way[:, :-1].T + lift[:, None] * way[None, :, -1]


def directed(q: np.ndarray, way: np.ndarray) -> np.ndarray:
    """(queries, projections): only a query's direction counts, on the sphere of radius 1, unlifted."""
    most = np.abs(q).max(axis=1, keepdims=True)
    unit = q / most
    return (unit / np.linalg.norm(unit, axis=1, keepdims=True)) @ way[:, :-1].T


# ---- cuts: which shard a vector lies in


@dataclass
class Band:
    """One band: its number of classes, largest squared norm, and cuts in heap order (projection, threshold)."""

    n: int
    most2: float
    axis: np.ndarray
    at: np.ndarray

    def places(self, p: np.ndarray) -> np.ndarray:
        """The leaf of each row of projections."""
        node = np.zeros(len(p), np.int64)
        for _ in range((len(self.axis) + 1).bit_length() - 1):
            right = p[np.arange(len(p)), self.axis[node]] > self.at[node]
            node = 2 * node + 1 + right
        return node


def fit_cuts(p: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A tree of ``depth`` levels that halves a sample at the median of its widest projection."""
    axis, at = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
    todo = [(0, np.arange(len(p)))] if depth else []
    while todo:
        node, rows = todo.pop()
        if len(rows) < 2:
            continue  # the threshold is infinite: everything goes left
        axis[node] = p[rows].std(axis=0).argmax()
        own = p[rows, axis[node]]
        at[node] = np.median(own)
        if 2 * node + 2 < len(axis):
            todo += [(2 * node + 1, rows[own <= at[node]]), (2 * node + 2, rows[own > at[node]])]
    return axis, at


def bands_of(classes: DataFrame, shard: int) -> dict[tuple[int, int], Band]:
    """The bands by (dim, band): as many as there are vector lengths and magnitudes, however many vectors."""
    counted = (
        classes.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("most2")).collect()
    )
    out = {}
    large = [r for r in counted if r["n"] > shard]
    picked: dict[tuple[int, int], list[bytes]] = {}
    if large:
        take = F.lit(False)
        for r in large:
            some = F.pmod(F.xxhash64("key"), F.lit(r["n"])) < SAMPLE
            take = take | ((F.col("dim") == r["dim"]) & (F.col("band") == r["band"]) & some)
        for row in classes.filter(take).select("dim", "band", "key", "vector").orderBy("key").toLocalIterator():
            picked.setdefault((row["dim"], row["band"]), []).append(bytes(row["vector"]))
    for r in counted:
        name, n = (r["dim"], r["band"]), r["n"]
        axis, at = np.zeros(0, np.int64), np.zeros(0)
        if name in picked:
            x = as_matrix(picked[name])
            # A leaf is cut until it holds half a shard, but not beyond what the sample can show.
            depth = min(math.ceil(math.log2(2 * n / shard)), int(math.log2(max(2, len(x) / 16))))
            axis, at = fit_cuts(projected(x, np.einsum("ij,ij->i", x, x), r["most2"], directions(name[0])), depth)
        out[name] = Band(n, r["most2"], axis, at)
    return out


def placed(classes: DataFrame, bands: dict[tuple[int, int], Band]) -> DataFrame:
    """Classes with the leaf of their band."""
    shared = classes.sparkSession.sparkContext.broadcast(bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            dims, names = batch.column("dim").to_numpy(), batch.column("band").to_numpy()
            raw, norm2 = batch.column("vector").to_pylist(), batch.column("norm2").to_numpy()
            leaf = np.zeros(len(raw), np.int64)
            for dim, name in set(zip(dims.tolist(), names.tolist(), strict=True)):
                rows = np.flatnonzero((dims == dim) & (names == name))
                x = as_matrix([raw[i] for i in rows])
                band = own[dim, name]
                leaf[rows] = band.places(projected(x, norm2[rows], band.most2, directions(dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    schema = T.StructType([*classes.schema.fields, T.StructField("leaf", T.LongType())])
    return classes.mapInArrow(run, schema)


def sharded(classes: DataFrame, bands: dict[tuple[int, int], Band], shard: int) -> DataFrame:
    """Classes with their shard: band, leaf, and a part of a leaf that is still too large."""
    at = kept(placed(classes, bands), "placed-vectors")
    sizes = at.groupBy("dim", "band", "leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard / 2)).alias("parts"))
    part = F.when(F.col("parts") > 2, F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts"))).otherwise(0)
    return at.join(sizes, ["dim", "band", "leaf"]).withColumn(
        "shard", F.concat_ws("/", "dim", "band", "leaf", part.cast("string"))
    ).drop("leaf", "parts")


# ---- the search within a shard


@dataclass
class Shard:
    """Vectors of one band with a sorted array per projection."""

    x: np.ndarray
    first: np.ndarray  # sort keys of the classes among ties
    most2: float
    order: list[np.ndarray]
    values: list[np.ndarray]

    @classmethod
    def of(cls, x: np.ndarray, norm2: np.ndarray, first: np.ndarray, most2: float, way: np.ndarray) -> Shard:
        p = projected(x, norm2, most2, way)
        order = [np.argsort(p[:, j], kind="stable") for j in range(p.shape[1])]
        return cls(x, first, most2, order, [p[o, j] for j, o in enumerate(order)])

    def search(
        self, q: np.ndarray, p: np.ndarray, bound: np.ndarray, k: int, collisions: int, reach: float
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows and scores of its ``k`` best found, all better than or equal to its bound."""
        n, m = len(self.x), len(self.order)
        counts = np.zeros((len(q), n), np.int16)
        scores = np.full((len(q), n), -np.inf)
        found = np.zeros(len(q), np.int64)
        last = bound.copy()  # the k-th score known
        norm = np.sqrt(np.einsum("ij,ij->i", q, q))
        lo = hi = None
        spread = max(float(v[-1] - v[0]) for v in self.values)
        half = np.maximum(np.where(np.isfinite(last), self.radius(last, norm) * reach / WIDEN**2, spread / 64), 1e-3)
        active = np.arange(len(q))
        while len(active):
            low = np.empty((len(active), m), np.int64)
            high = np.empty_like(low)
            for j, v in enumerate(self.values):
                low[:, j] = np.searchsorted(v, p[active, j] - half[active], "left")
                high[:, j] = np.searchsorted(v, p[active, j] + half[active], "right")
            if lo is None:
                lo, hi = high.copy(), high.copy()  # nothing is covered yet
            done = []
            for row, i in enumerate(active.tolist()):
                parts = []
                for j, (a, b, c, d) in enumerate(zip(low[row].tolist(), lo[i].tolist(), hi[i].tolist(), high[row].tolist(), strict=True)):
                    if a < b:
                        parts.append(self.order[j][a:b])
                    if c < d:
                        parts.append(self.order[j][c:d])
                lo[i], hi[i] = low[row], high[row]
                if parts:
                    counts[i] += np.bincount(np.concatenate(parts), minlength=n).astype(np.int16)
                new = np.flatnonzero((counts[i] >= collisions) & np.isneginf(scores[i]))
                if len(new):
                    scores[i, new] = np.einsum("ij,j->i", self.x[new], q[i])
                    found[i] += len(new)
                    if found[i] >= k:
                        last[i] = max(last[i], np.partition(scores[i], n - k)[n - k])
                covered = (low[row] == 0).all() and (high[row] == n).all()
                if covered or (np.isfinite(last[i]) and half[i] >= reach * self.radius(last[i], norm[i])):
                    done.append(row)
            active = np.delete(active, done)
            ways = np.where(np.isfinite(last[active]), reach * self.radius(last[active], norm[active]), np.inf)
            half[active] = np.minimum(half[active] * WIDEN, np.maximum(ways, half[active]))
        out = []
        for i in range(len(q)):
            rows = np.flatnonzero((scores[i] > -np.inf) & (scores[i] >= last[i]))
            best = rows[np.lexsort((self.first[rows], -scores[i, rows]))][:k]
            out.append((best, scores[i, best]))
        return out

    def radius(self, score: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """How far from a query of this norm a vector with this score lies, on the sphere of radius 1."""
        return radius(score, norm, self.most2)


def radius(score: np.ndarray, norm: np.ndarray, most2: np.ndarray | float) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (score / norm) / np.sqrt(most2)))


def search_units(queries: DataFrame, rows: DataFrame, k: int, collisions: int, reach: float) -> DataFrame:
    """(query, score, ids): the best of every query in every unit it shares with vectors.

    Both sides have ``unit``, a bounded number of rows of each.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        query, score, ids = [], [], []
        if left.num_rows and right.num_rows:
            x = as_matrix(right["vector"].to_pylist())
            entries = right["ids"].combine_chunks()
            first = entries.to_pylist()
            # The order of classes by their first row.
            rank = np.empty(len(first), np.int64)
            rank[sorted(range(len(first)), key=lambda i: (first[i][0]["none"], first[i][0]["vec_id"] or 0, first[i][0]["uid"]))] = np.arange(len(first))
            way = directions(x.shape[1])
            own = Shard.of(x, right["norm2"].to_numpy(), rank, right["most2"][0].as_py(), way)
            names, bound = left["query"].to_pylist(), left["bound"].to_numpy()
            raw = left["vector"].to_pylist()
            for start in range(0, len(raw), TOGETHER):
                q = as_matrix(raw[start : start + TOGETHER])
                hits = own.search(q, directed(q, way), bound[start : start + TOGETHER], k, collisions, reach)
                for i, (best, scores) in enumerate(hits):
                    query += [names[start + i]] * len(best)
                    score += scores.tolist()
                    ids += [first[b] for b in best.tolist()]
        entry = pa.struct([("none", pa.bool_()), ("vec_id", pa.int64()), ("uid", pa.int64())])
        return pa.table(
            {"query": pa.array(query, pa.binary()), "score": pa.array(score, pa.float64()), "ids": pa.array(ids, pa.list_(entry))}
        )

    schema = "query binary, score double, ids array<struct<none: boolean, vec_id: bigint, uid: bigint>>"
    left = queries.select("unit", "query", "vector", "bound").groupBy("unit")
    right = rows.select("unit", "vector", "norm2", "ids", "most2").groupBy("unit")
    return left.cogroup(right).applyInArrow(run, schema)


# ---- which shards a query must see


def spans(rows: DataFrame) -> DataFrame:
    """(shard, n, low, high): the span of every shard along every projection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, names = batch.column("vector").to_pylist(), np.array(batch.column("shard").to_pylist(), object)
            norm2, most2 = batch.column("norm2").to_numpy(), batch.column("most2").to_numpy()
            out = []
            for name in dict.fromkeys(names.tolist()):
                some = np.flatnonzero(names == name)
                x = as_matrix([raw[i] for i in some])
                p = projected(x, norm2[some], float(most2[some[0]]), directions(x.shape[1]))
                out.append((name, x.shape[1], float(most2[some[0]]), len(some), p.min(axis=0).tolist(), p.max(axis=0).tolist()))
            columns = list(zip(*out, strict=True)) if out else [[] for _ in range(6)]
            kinds = [pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["shard", "dim", "most2", "n", "low", "high"],
            )

    def each(pick, name: str) -> Column:
        return F.array(*[pick(F.col(name)[j]) for j in range(PROJECTIONS)]).alias(name)

    schema = "shard string, dim int, most2 double, n bigint, low array<double>, high array<double>"
    found = rows.select("shard", "vector", "norm2", "most2").mapInArrow(run, schema)
    return found.groupBy("shard").agg(
        F.first("dim").alias("dim"), F.first("most2").alias("most2"), F.sum("n").alias("n"),
        each(F.min, "low"), each(F.max, "high"),
    )


def routed(queries: DataFrame, seen: DataFrame, collisions: int, reach: float) -> DataFrame:
    """(query, vector, bound, home, shard) for every shard in which a query may find something better.

    The spans are sent to all tasks if there are at most ``MAX_SPANS`` shards; beyond that only norms decide,
    in a join on the length of the vectors.
    """
    if seen.limit(MAX_SPANS + 1).count() > MAX_SPANS:
        norm = F.sqrt("norm2")
        able = (F.col("bound") <= norm * F.sqrt("s.most2") * (1 + 1e-9)) & (F.col("s.shard") != F.col("home"))
        return queries.alias("q").join(seen.select("shard", "dim", "most2").alias("s"), "dim").filter(able).select(
            "query", "vector", "bound", "shard"
        )
    by_dim: dict[int, list] = {}
    for r in seen.select("dim", "shard", "most2", "low", "high").toLocalIterator():
        by_dim.setdefault(r["dim"], []).append((r["shard"], r["most2"], r["low"], r["high"]))
    packed = {
        dim: (
            np.array([r[0] for r in rows], object), np.array([r[1] for r in rows]),
            np.array([r[2] for r in rows]), np.array([r[3] for r in rows]),
        )
        for dim, rows in by_dim.items()
    }
    shared = seen.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, home = batch.column("vector").to_pylist(), batch.column("home").to_pylist()
            bound = batch.column("bound").to_numpy()
            for start in range(0, len(raw), TOGETHER):
                rows, names = [], []
                for i in range(start, min(start + TOGETHER, len(raw))):
                    q = as_matrix([raw[i]])
                    shards, most2, low, high = shared.value[q.shape[1]]
                    norm = float(np.sqrt(q[0] @ q[0]))
                    p = directed(q, directions(q.shape[1]))[0]
                    # Rounding must not shut a shard out.
                    half = reach * radius(np.full(len(shards), bound[i]), norm, most2) + 1e-9
                    meets = ((p + half[:, None] >= low) & (p - half[:, None] <= high)).sum(axis=1) >= collisions
                    able = bound[i] <= norm * np.sqrt(most2) * (1 + 1e-9)
                    found = shards[meets & able & (shards != home[i])]
                    rows += [i] * len(found)
                    names += found.tolist()
                some = batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in ("query", "vector", "bound")], pa.array(names, pa.string())],
                    names=["query", "vector", "bound", "shard"],
                )

    return queries.select("query", "vector", "bound", "home").mapInArrow(
        run, "query binary, vector binary, bound double, shard string"
    )


def dealt(queries: DataFrame, rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``unit``: a shard and a part of its queries, at most about ``most`` of them."""
    wanted = queries.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(most))).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("query"), F.col("parts"))
    left = queries.join(wanted, "shard").withColumn("unit", F.concat_ws("/", "shard", part.cast("string")))
    right = rows.join(wanted, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return left, right.withColumn("unit", F.concat_ws("/", "shard", F.col("part").cast("string")))


def best_of(found: DataFrame, k: int) -> DataFrame:
    """(query, score, ids): the ``k`` best classes of every query."""
    first = F.col("ids")[0]
    order = W.partitionBy("query").orderBy(F.desc("score"), first["none"], first["vec_id"], first["uid"])
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).drop("n")


def search(
    vectors: DataFrame,
    is_query: Column | None = None,
    k: int = NEIGHBOURS,
    collisions: int = COLLISIONS,
    reach: float = REACH,
    shard: int = SHARD,
    together: int = QUERIES,
) -> DataFrame:
    """(query_id, query_uid, rank, vec_id, score): the ``k`` nearest found of every query of (vec_id, embedding)."""
    is_query = F.col("vec_id") % EVERY == 0 if is_query is None else is_query
    marked = kept(marks(vectors), "search-vectors")
    # One more than wanted, for the query's own row.
    own = marked.groupBy("key").agg(*[F.first(c).alias(c) for c in ("vector", "dim", "band", "norm2")])
    classes = kept(own.join(first_rows(marked, k + 1), "key"), "search-classes")
    bands = bands_of(classes, shard)
    if not bands:
        return marked.select(
            F.col("vec_id").alias("query_id"), F.col("uid").alias("query_uid"), F.lit(1).alias("rank"), "vec_id",
            F.lit(0.0).alias("score"),
        )
    most2 = F.coalesce(
        *[F.when((F.col("dim") == d) & (F.col("band") == b), F.lit(band.most2)) for (d, b), band in bands.items()]
    )
    rows = kept(sharded(classes, bands, shard).withColumn("most2", most2), "search-shards")
    seen = kept(spans(rows), "search-spans")

    asked = marked.filter(is_query).select("key").distinct().withColumnRenamed("key", "query")
    asked = asked.join(rows.select(F.col("key").alias("query"), "vector", "dim", "norm2", F.col("shard").alias("home")), "query")
    asked = kept(asked, "search-queries")
    at_home = asked.select("query", "vector", F.lit(float("-inf")).alias("bound"), F.col("home").alias("shard"))
    found = kept(search_units(*dealt(at_home, rows, together), k + 1, collisions, reach), "search-home")
    bound = found.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
    bound = bound.select("query", F.when(F.col("n") > k, F.col("last")).alias("last"))
    bounded = asked.join(bound, "query", "left").withColumn("bound", F.coalesce("last", F.lit(float("-inf"))))
    sent = kept(routed(bounded, seen, collisions, reach), "search-routes")
    found = found.unionByName(search_units(*dealt(sent, rows, together), k + 1, collisions, reach))

    # Copies become rows, then each query row loses itself.
    each = best_of(found, k + 1).select("query", "score", F.explode("ids").alias("e"))
    order = W.partitionBy("query").orderBy(F.desc("score"), "e.none", "e.vec_id", "e.uid")
    each = each.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    hit = F.struct("n", "score", F.col("e.vec_id").alias("vec_id"), F.col("e.uid").alias("uid"))
    lists = each.groupBy("query").agg(F.array_sort(F.collect_list(hit)).alias("hits"))
    ask = marked.filter(is_query).select(F.col("key").alias("query"), F.col("uid").alias("query_uid"), F.col("vec_id").alias("query_id"))
    mine = F.slice(F.filter("hits", lambda h: h["uid"] != F.col("query_uid")), 1, k)
    return (
        ask.join(lists, "query")
        .select("query_id", "query_uid", F.posexplode(mine).alias("place", "hit"))
        .select("query_id", "query_uid", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )
