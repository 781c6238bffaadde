"""Nearest vectors, filter orders and vector codes against plain versions."""

import math
import os
import re
import sys
from itertools import permutations

import numpy as np
import pytest

from ticketlake.llm import collision_search, filter_audit, vector_codes
from ticketlake.llm.queries import REGISTRY, table

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
VECTORS = "vec_id bigint, embedding array<double>, label int, score double, rank int, code string, value binary, dim int"

ODD_VECTORS = [
    (0, None, 1), (20, [], 1), (40, [0.0] * 8, 1), (60, [1.0] * 7 + [None], 1), (80, [math.nan] * 8, 2),
    (100, [math.inf] + [0.0] * 7, 2), (120, [1.0, 2.0], 2), (140, [3.0, -1.0], None), (1, [1e200] * 8, None),
]


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, -1.0, 3, "mine", b"x", 5) for r in rows], VECTORS).repartition(3)


def mixed(n, dim=8, seed=1):
    """Rows with copies, repeated vec_ids and norms over many magnitudes."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * np.exp(rng.uniform(-4, 4, (n, 1)))
    x[n // 2 : n // 2 + n // 4] = x[7]
    ids = list(range(n))
    ids[-1] = ids[-2] = n - 20 if (n - 20) % 20 == 0 else 0
    return [(i, v.tolist(), int(i) % 3) for i, v in zip(ids, x, strict=True)] + [(None, x[9].tolist(), None)]


# ---- nearest vectors


def usable(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v) and math.isfinite(sum(c * c for c in v))


def plain_search(rows, k=20):
    """{(query row): [(score, vec_id)]}"""
    some = [(i, v) for i, v, *_ in rows if usable(v)]
    out = []
    for a, (i, q) in enumerate(some):
        if i is None or i % 20:
            continue
        hits = sorted(
            (-math.fsum(x * y for x, y in zip(q, v, strict=True)), j is None, j or 0) for b, (j, v) in enumerate(some) if b != a and len(v) == len(q)
        )
        out.append((i, [(-s, None if none else j) for s, none, j in hits[:k]]))
    return out


def lists_of(rows):
    by = {}
    for r in rows:
        by.setdefault((r.query_id, r.query_uid), {})[r["rank"]] = (r.score, r.vec_id)
    for hits in by.values():
        assert sorted(hits) == list(range(1, len(hits) + 1))
    return sorted((q, [hits[i] for i in sorted(hits)]) for (q, _), hits in by.items())


def test_collisions_catch_what_is_promised():
    p = math.erf(collision_search.REACH / math.sqrt(2))
    m, t = collision_search.PROJECTIONS, collision_search.COLLISIONS
    caught = sum(math.comb(m, k) * p**k * (1 - p) ** (m - k) for k in range(t, m + 1))
    assert caught >= collision_search.CATCH


@pytest.mark.parametrize("shard", [16_384, 24])
def test_nearest_of_odd_vectors(spark, shard):
    rows = mixed(120) + ODD_VECTORS + [(160, [3.0, -1.0], 5)]
    want = sorted(plain_search(rows))
    # As many collisions as a window can ask for none: all vectors that the windows reach are verified.
    got = lists_of(collision_search.search(vectors_of(spark, rows), shard=shard, collisions=1, together=5).collect())
    assert [q for q, _ in got] == [q for q, hits in want if hits]
    for (_, mine), (_, theirs) in zip(got, [w for w in want if w[1]], strict=True):
        assert [s for s, _ in mine] == pytest.approx([s for s, _ in theirs], rel=1e-12)
        assert [v for _, v in mine] == [v for _, v in theirs]


def test_nearest_of_copies_takes_the_smallest_ids(spark):
    rows = [(i, [1.0, 0.5, 0.25], 1) for i in range(60)] + [(100, [2.0, 1.0, 0.5], 1)]
    got = lists_of(collision_search.search(vectors_of(spark, rows)).collect())
    assert [q for q, _ in got] == [0, 20, 40, 100]
    for q, hits in got:
        assert [v for _, v in hits] == [v for v in [100, *range(60)] if v != q][:20]


def test_nearest_of_nothing(spark):
    empty = vectors_of(spark, mixed(30)).limit(0)
    assert collision_search.search(empty).collect() == []
    assert collision_search.search(vectors_of(spark, [(20, [0.0, 0.0], 1)])).collect() == []
    assert collision_search.search(vectors_of(spark, [(20, [1.0, 0.0], 1)])).collect() == []


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_over_many_shards(spark, spread):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 32))
    x = centres[rng.integers(0, 12, 6000)] + 0.6 * rng.standard_normal((6000, 32))
    x *= np.exp(spread * rng.standard_normal((6000, 1)))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = lists_of(collision_search.search(vectors_of(spark, rows), shard=512, together=64).collect())
    found = 0
    for q, hits in got:
        score = x @ x[q]
        score[q] = -np.inf
        found += len(set(np.argsort(-score)[:20].tolist()) & {v for _, v in hits})
        assert [s for s, _ in hits] == pytest.approx([score[v] for _, v in hits], rel=1e-12)
    assert len(got) == 300 and found >= 0.95 * 300 * 20


@needs_data
def test_given_vectors_are_found(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table(spark, SF, "embeddings").collect()]
    want = dict(plain_search(rows))
    found = {}
    for r in REGISTRY["op11_nearest_vectors"].run(spark, SF).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    assert set(found) == set(want) and all(sorted(f) == list(range(1, 21)) for f in found.values())
    hits = sum(len({v for _, v in want[q]} & set(found[q].values())) for q in want)
    assert hits >= 0.95 * 20 * len(want)


# ---- filter orders


def plain_fails(docs):
    first = {}
    for i, text, _ in docs:
        key = (i is None, i or 0)
        first[text or ""] = min(first.get(text or "", key), key)
    out = []
    for i, text, part in docs:
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(ws) < 200,
            "B": 100 * len(set(ws)) < 50 * len(ws),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": (i is None, i or 0) != first[text],
        }
        out.append((i, part or "", "".join(f for f in "ABCDE" if fails[f])))
    return out


def plain_audit(docs, labels):
    """The counts by walking every order over every document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    marked = plain_fails(docs)
    out, totals = {}, {}
    for part in {p for _, p, _ in marked}:
        for order in map("".join, permutations("ABCDE")):
            left = [(i, f) for i, p, f in marked if p == part]
            gone = []
            for step, name in enumerate(order, 1):
                here = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                out[part, order, step] = [
                    len(left), len(here), sum(name in f for _, f in gone), sum(f == name for _, p, f in marked if p == part),
                    sum(i in good for i, _ in here), sum(i in toxic for i, _ in here),
                ]
                gone += here
                totals[part, name] = totals.get((part, name), 0) + len(here)
    return {(p, o, s): (*c, totals[p, o[s - 1]]) for (p, o, s), c in out.items()}


def audited(df):
    return {
        (r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.COUNTS)
        for r in df.collect()
    }


def test_min_plus_product_is_the_first_step():
    fails = filter_audit.mask_matrix(4)
    orders, steps = filter_audit.position_matrix(4)
    ranks = filter_audit.removal_ranks(fails, steps)
    for mask in range(16):
        for o, order in enumerate(orders):
            want = next((s for s, f in enumerate(order, 1) if mask >> f & 1), math.inf)
            assert ranks[mask, o] == want


def test_audit_of_odd_documents(spark):
    long = " ".join(f"w{i}" for i in range(300))
    texts = [
        None, "", " \t\n", "one two", long, long, long + " ABCDEFGHIJKLMNOPQRSTUVWXYZ", "same " * 400, "same " * 400, "x" * 100_000,
        long + " #", "ÄÖÜ É " * 300, "A\x0bB\x85C D", long + " & | *", "word " * 250 + long,
    ]
    docs = [(i, t, [None, "", "s", "t"][i % 4]) for i, t in enumerate(texts)]
    docs += [(None, long, "s"), (None, "only", "s"), (None, "only", "t"), (4, long, "s"), (5, long, "t"), (5, "one two", "t")]
    labels = [(1, 1, 0), (4, 1, None), (4, 0, 1), (5, None, 1), (7, 1, 1), (99, 1, 1), (None, 1, 1), (12, 1, 0), (12, 1, 0)]
    df = spark.createDataFrame(
        [(*d, 9, 9, "z") for d in docs], "doc_id bigint, text string, source string, kept int, mask int, part string"
    ).repartition(3)
    said = spark.createDataFrame([(*r, 5) for r in labels], "doc_id bigint, quality int, toxic int, part int")
    got = audited(filter_audit.audit(df, said))
    assert got == plain_audit(docs, labels)
    assert audited(filter_audit.audit(df, said.limit(0))) == plain_audit(docs, [])
    assert filter_audit.audit(df.limit(0), said).collect() == []


def test_audit_of_random_masks():
    rng = np.random.default_rng(2)
    weight = rng.integers(0, 50, (3, 32))
    got = filter_audit.audit_of(*weight)
    orders = list(permutations(range(5)))
    for o in rng.integers(0, 120, 12):
        left = weight[0].copy()
        for s, f in enumerate(orders[o]):
            bit = (np.arange(32) >> f & 1).astype(bool)
            assert got["removed"][o, s] == left[bit].sum()
            assert got["redundant"][o, s] == weight[0][bit].sum() - left[bit].sum()
            left[bit] = 0
            assert got["kept"][o, s] == left.sum()
    # All orders remove the same documents in the end, so the shares add up.
    assert got["shapley"][0].sum() == 120 * weight[0][1:].sum()


@needs_data
@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_vector_codes"])
def test_registered_sql(spark, name):
    from compare import compare, connect

    ok, note = compare(spark, connect(SF), name, REGISTRY[name].run, REGISTRY[name].sql, SF)
    assert ok, note


# ---- vector codes


def plain_codes(rows, parts, entries, rounds):
    """[(vec_id, code, error, label_error)] and all final components, in plain integers."""
    fine = [(i, v, lab) for i, v, lab in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    most = vector_codes.LARGEST
    ints = [(i, [int(max(-most, min(most, math.floor(c * 256) if abs(c) < 1e9 else math.copysign(most, c)))) for c in v], lab) for i, v, lab in fine]

    def key(r):  # the written integers, as Spark orders binaries
        return (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes())

    ints.sort(key=key)
    dim = len(ints[0][1])
    ints = [r for r in ints if len(r[1]) == dim]
    cuts = [0]
    for k in range(parts):
        cuts.append(cuts[-1] + dim // parts + (k < dim % parts))
    books = [[r[1][s:e] for r in ints[:entries]] for s, e in zip(cuts, cuts[1:], strict=False)]

    def assign(v, p):
        own = v[cuts[p] : cuts[p + 1]]
        return min((sum((a - b) ** 2 for a, b in zip(own, entry, strict=True)), k) for k, entry in enumerate(books[p]))

    for _ in range(rounds):
        chosen = [[assign(v, p)[1] for p in range(parts)] for _, v, _ in ints]
        for p in range(parts):
            moved = list(books[p])
            for k in range(len(moved)):
                mine = [v[cuts[p] : cuts[p + 1]] for (_, v, _), c in zip(ints, chosen, strict=True) if c[p] == k]
                if mine:
                    moved[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
            books[p] = moved
    found = [(i, [assign(v, p) for p in range(parts)], lab) for i, v, lab in ints]
    errors = {}
    for _, f, lab in found:
        errors[lab] = errors.get(lab, 0) + sum(d for d, _ in f)
    out = [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), errors[lab]) for i, f, lab in found]
    return out, [c for p in range(parts) for entry in books[p] for c in entry]


def order(rows):
    return sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in rows)


@pytest.mark.parametrize("dim,parts,entries", [(8, 4, 16), (7, 3, 5), (3, 16, 64)])
def test_codes_of_odd_vectors(spark, dim, parts, entries):
    import hashlib

    rows = mixed(90, dim)[2:] + ODD_VECTORS + [(500, [1e9] * dim, 1), (501, [-3e300] * dim, 2), (502, [0.0] * dim, None)]
    want, components = plain_codes(rows, parts, entries, 2)
    got = vector_codes.compress(vectors_of(spark, rows), parts, entries).collect()
    assert order((r.vec_id, r.code, r.error, r.label_error) for r in got) == order(want)
    digest = hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_codes_of_nothing(spark):
    empty = vectors_of(spark, mixed(30)).limit(0)
    assert vector_codes.compress(empty).collect() == []
    assert vector_codes.compress(vectors_of(spark, [(1, None, 1), (2, [math.nan], 1)])).columns == [
        "vec_id", "code", "error", "label_error", "codebooks_sha256",
    ]


def test_dictionary_distances_are_plain_distances():
    rng = np.random.default_rng(3)
    x, books = rng.integers(-9, 9, (200, 10)), rng.integers(-9, 9, (12, 10))
    cuts = vector_codes.bounds(10, 3)
    for part, found in enumerate(vector_codes.dictionary_distances(x, books, cuts)):
        s, e = cuts[part], cuts[part + 1]
        assert (found == ((x[:, None, s:e] - books[None, :, s:e]) ** 2).sum(axis=2)).all()
