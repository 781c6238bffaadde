"""Links between vectors and between texts, and the pipeline, against brute force."""

import math
import os
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from ticketlake.llm import blocks, near_vectors, ngram_join
from ticketlake.llm.common import BATCH_BYTES, add_columns, components, ship
from ticketlake.llm.queries import REGISTRY, table

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def settled(ids, linked):
    """For each row: number of links and smallest id reached; ``linked``: pairs of row numbers."""
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    n = [0] * len(ids)
    for a, b in linked:
        n[a] += 1
        n[b] += 1
        up[find(a)] = find(b)
    low = {}
    for i, x in enumerate(ids):
        low[find(i)] = min(low.get(find(i), math.inf), math.inf if x is None else x)
    return sorted((x is None, x or 0, n[i], low[find(i)]) for i, x in enumerate(ids))


def got(rows, key):
    return sorted(
        (r[key] is None, r[key] or 0, r.n_links, math.inf if r.component_id is None else r.component_id) for r in rows
    )


def one_kept_each(rows):
    by_component = {}
    for r in rows:
        by_component.setdefault(r.component_id, []).append(r.kept)
    return all(sum(k) == 1 for c, k in by_component.items() if c is not None)


def test_roots_of_random_links():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        a, b = rng.integers(0, n, (2, int(rng.integers(0, 40))))
        want = settled(list(range(n)), list(zip(a.tolist(), b.tolist(), strict=True)))
        assert blocks.roots(n, a, b).tolist() == [w[3] for w in want]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    nodes = sorted({x for e in links for x in e} | {999})
    found = components(
        spark.createDataFrame([(n,) for n in nodes], "id bigint"), spark.createDataFrame(links, "a bigint, b bigint"), "t"
    )
    assert {r.id: r.component for r in found.collect()} == {n: 0 if n <= 40 else 100 if n < 200 else n for n in nodes}


# ---- vectors


def near(rows):
    found = []
    for (i, a), (j, b) in combinations(enumerate(rows), 2):
        if a[2] is None or a[2] != b[2] or not a[1] or not b[1] or len(a[1]) != len(b[1]):
            continue
        if any(x is None for x in [*a[1], *b[1]]):
            continue
        x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
        if not (np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()):
            continue
        if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
            found.append((i, j))
    return found


def vectors():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    rows = []
    for i in range(300):
        v = centres[i % 12] + rng.standard_normal(16) * (0.06 if i % 3 else 0.5)
        rows.append((i, v.tolist(), i % 2))
    rows += [(400 + i, rows[0][1], 0) for i in range(30)]  # equal vectors
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [None] * 16, 0), (504, rows[0][1], None)]
    rows += [(505, [float("inf")] * 16, 0), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0), (508, [], 0), (None, rows[0][1], 0)]
    rows += [(600, [1e-30] * 16, 0), (601, [3e30] * 16, 0), (0, rows[0][1], 0)]
    return rows


@pytest.mark.parametrize("leaf,block", [(1024, 1024), (20, 8)])
def test_vector_links(spark, leaf, block):
    rows = vectors()
    data = spark.createDataFrame([(*r, -1) for r in rows], "vec_id bigint, embedding array<float>, label int, n_links int")
    found = near_vectors.link(data.repartition(3), leaf, block).collect()
    assert got(found, "vec_id") == settled([r[0] for r in rows], near(rows))
    assert one_kept_each(found)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert near_vectors.link(none).count() == 0


def test_trees_keep_close_pairs_together():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.standard_normal(x.shape) * 0.02
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    close = (x * y).sum(1) >= 0.98
    forest = near_vectors.Forest()
    both = np.concatenate([x, y])
    together = np.zeros(3000, bool)
    for tree in range(near_vectors.TREES):
        forest.add(tree, 5, near_vectors.fit_node(both, 5, tree, 4))
        for _, rows in forest.leaves(both, tree, 5):
            there = np.zeros(6000, bool)
            there[rows] = True
            together |= there[:3000] & there[3000:]
            assert len(rows) < 3000  # the leaves are much smaller than the whole
    assert close.sum() > 1000 and together[close].mean() >= 0.999


# ---- texts


def shingles(text):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(texts):
    sets = [shingles(t) for t in texts]
    return [
        (i, j)
        for i, j in combinations(range(len(sets)), 2)
        if sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])
    ]


def copies():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(12):
        base = rng.choice(words, rng.integers(60, 200)).tolist()
        for _ in range(12):
            own = list(base)
            for _ in range(rng.integers(0, 5)):
                own[rng.integers(len(own))] = str(rng.choice(words))
            texts.append(" ".join(own))
    return texts


def test_least_agreements_prune_and_keep():
    found = ngram_join.least_agreements()
    assert all(0 < m <= 0.8 * n for n, m in found) and found[-1][1] > 0.5 * found[-1][0]


@pytest.mark.parametrize("block", [512, 8])
def test_text_links(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BUCKET_BLOCK", block)
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", block)
    texts = copies()
    docs = spark.createDataFrame([(1000 - i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = ngram_join.link(docs.repartition(3)).collect()
    assert got(found, "doc_id") == settled([1000 - i for i in range(len(texts))], similar(texts))
    assert one_kept_each(found)


def test_text_links_in_blocks_by_shingles(spark, monkeypatch):
    texts = copies()[:60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 50)
    assert got(ngram_join.link(docs).collect(), "doc_id") == settled(list(range(60)), similar(texts))


def test_text_links_without_broadcast(spark, monkeypatch):
    texts = copies()[:40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", -1)
    assert got(ngram_join.link(docs).collect(), "doc_id") == settled(list(range(40)), similar(texts))
    assert ngram_join.keep_one(docs).count() == sum(r.kept for r in ngram_join.link(docs).collect())


def test_text_links_of_odd_rows(odd, nothing):
    rows = odd.collect()
    found = ngram_join.link(odd).collect()
    assert got(found, "doc_id") == settled([r.doc_id for r in rows], similar([r.text for r in rows]))
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in found)
    assert ngram_join.link(nothing).count() == 0 and ngram_join.keep_one(nothing).count() == 0


@needs_data
def test_given_tables(spark):
    docs = table(spark, SF, "documents").collect()
    found = REGISTRY["op6_ngram_join"].run(spark, SF).collect()
    assert got(found, "doc_id") == settled([d.doc_id for d in docs], similar([d.text for d in docs]))
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF, "embeddings").collect()]
    found = REGISTRY["op1_near_vectors"].run(spark, SF).collect()
    assert got(found, "vec_id") == settled([r[0] for r in rows], near(rows))


# ---- the pipeline


@needs_data
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents").select("*").cache()
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF).cache()
        assert after.columns == columns
        left = {r.doc_id: r for r in after.collect()}
        assert all(before[i] == r for i, r in left.items()), name
        if name == "language":
            assert set(before) - set(left) == {i for i, r in before.items() if not re.search(r"[^\W\d_]", r.text or "")}
        if name == "near_copies":
            order = sorted(before)
            pairs = similar([before[i].text for i in order])
            want = {w[3] for w in settled(order, pairs)}
            assert set(left) == want
        docs, before = after, left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(before)


def test_pipeline_of_odd_rows(spark, odd, nothing, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.collect()


def test_units_are_put_together_in_small_pieces(monkeypatch):
    monkeypatch.setattr(blocks, "PIECE_BYTES", 10_000, raising=False)
    rng = np.random.default_rng(5)
    keys = np.sort(np.concatenate([rng.integers(0, 60, 900), np.full(300, 30)]))
    body = [rng.bytes(int(n)) for n in rng.integers(0, 200, len(keys))]
    every = pa.RecordBatch.from_arrays(
        [pa.array(keys.astype(np.int64)), pa.array(np.arange(len(keys))), pa.array(body, pa.binary())],
        names=["unit", "uid", "grams"],
    )
    batches = [every.slice(0, 700), every.slice(700, 0), every.slice(700, 1), every.slice(701)]
    tables = list(blocks.stream_units(iter(batches)))
    assert pa.concat_tables([t for t, _ in tables]).combine_chunks().equals(pa.Table.from_batches([every]))
    units = [k for t, bounds in tables for k in t["unit"].to_numpy()[bounds[:-1]]]
    assert units == sorted(set(keys.tolist()))
    widest = max(every.slice(int(a), int(b - a)).nbytes for a, b in zip(*[np.searchsorted(keys, np.arange(60), s) for s in ("left", "right")]))
    assert max(t.nbytes for t, _ in tables) <= widest + 2 * 10_000


def test_workers_get_batches_of_bounded_size(spark):
    """Long texts: a batch was 10,000 rows of any length before."""
    docs = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('lorem ipsum ', 500) as text")
    sizes = add_columns(docs, "n bigint", lambda: lambda b: [pa.array(np.full(b.num_rows, b.nbytes))])
    assert sizes.agg({"n": "max"}).first()[0] <= BATCH_BYTES + 10_000
    assert sizes.count() == 3000
    # A bound of the session's own stays.
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "123456")
    try:
        ship(spark)
        assert int(spark.conf.get(name).rstrip("b")) == 123456
    finally:
        spark.conf.set(name, before)
