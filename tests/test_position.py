"""Positional operators against a plain reading of the rows, with chunk borders everywhere."""

import random

import pytest
from pyspark.sql import functions as F

from ticketlake.operators import position


def make(spark, seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for name, size in (("a", n), ("b", 7), ("c", 1)):
        for i in range(size):
            rows.append((name, i, rnd.choice([None, None, f"v{i}"]), rnd.random() < 0.25))
    df = spark.createDataFrame(rows, "src_file string, row_idx long, v string, m boolean")
    return rows, df.orderBy(F.rand(seed))


def by_file(rows):
    files = {}
    for r in rows:
        files.setdefault(r[0], []).append(r)
    return files


@pytest.mark.parametrize("seed,chunk", [(1, 1), (2, 4), (3, 1000)])
def test_fill_shift_count(spark, seed, chunk):
    rows, df = make(spark, seed)
    filled = position.locf(df, ["v"], chunk_rows=chunk)
    counted = position.running_sum(filled, F.col("m").cast("long"), "s", chunk_rows=chunk)
    if chunk >= 2:
        counted = position.shift(counted, {"row_idx": "down"}, 2, chunk_rows=chunk)
        counted = position.shift(counted, {"row_idx": "up"}, -1, chunk_rows=chunk)
    got = {(r["src_file"], r["row_idx"]): r for r in counted.collect()}
    assert len(got) == len(rows)
    for part in by_file(rows).values():
        last, total = None, 0
        for i, (name, idx, v, m) in enumerate(part):
            last, total = v if v is not None else last, total + m
            r = got[(name, idx)]
            assert (r["v"], r["s"]) == (last, total)
            if chunk >= 2:
                assert r["down"] == (idx + 2 if i + 2 < len(part) else None)
                assert r["up"] == (idx - 1 if i else None)


@pytest.mark.parametrize("chunk", [3, 1000])
def test_blocks(spark, chunk):
    rows, df = make(spark, 5)
    got = {(r["src_file"], r["row_idx"]): r["block"]
           for r in position.block_number(df, F.col("m"), chunk_rows=chunk).collect()}
    for part in by_file(rows).values():
        for i, (name, idx, _, _) in enumerate(part):
            assert got[(name, idx)] == 1 + sum(p[3] for p in part[: max(i - 1, 0)])


def test_block_ends_after_its_marker(spark):
    df = spark.createDataFrame([("f", i, i == 2) for i in range(7)], "src_file string, row_idx long, m boolean")
    got = [r["block"] for r in position.block_number(df, F.col("m"), chunk_rows=2).orderBy("row_idx").collect()]
    assert got == [1, 1, 1, 1, 2, 2, 2]


def test_densify_and_numbered(spark):
    _, df = make(spark, 9)
    dense = position.densify(df.filter("row_idx % 3 = 1"), chunk_rows=4)
    for name, n in (("a", 20), ("b", 2)):
        idx = sorted(r["row_idx"] for r in dense.filter(F.col("src_file") == name).collect())
        assert idx == list(range(n))
    heads = position.numbered(df, F.col("row_idx") % 10 == 0, "n", chunk_rows=7).filter("src_file = 'a'")
    assert sorted((r["row_idx"], r["n"]) for r in heads.collect()) == [(10 * i, i + 1) for i in range(6)]


def test_drop_first(spark):
    _, df = make(spark, 9)
    kept = position.drop_first(df.filter("row_idx > 2"))
    firsts = {tuple(r) for r in kept.groupBy("src_file").agg(F.min("row_idx")).collect()}
    assert firsts == {("a", 4), ("b", 4)}


def test_fill_survives_one_hot_file(spark):
    """Nearly all rows in one file: no window may span the file."""
    df = spark.range(200_000).select(
        F.when(F.col("id") < 199_990, "hot").otherwise("cold").alias("src_file"),
        F.col("id").alias("row_idx"),
        F.when(F.col("id") % 1000 == 0, F.col("id")).alias("v"),
    )
    got = position.locf(df, ["v"], chunk_rows=5_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan
    wrong = got.filter("src_file = 'hot' and v <> row_idx - row_idx % 1000").count()
    assert wrong == 0 and got.filter("src_file = 'hot'").count() == 199_990


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_scan_does_all_in_one_pass(spark, chunk):
    rows, df = make(spark, 9)
    found = position.scan(
        df,
        fills={"v": F.col("v"), "at": F.when(F.col("m"), F.col("row_idx"))},
        above={"before": F.when(F.col("m"), F.col("row_idx"))},
        sums={"n": F.col("m").cast("long"), "i": F.col("row_idx")},
        chunk_rows=chunk,
    )
    got = {(r["src_file"], r["row_idx"]): r for r in found.collect()}
    assert len(got) == len(rows)
    for part in by_file(rows).values():
        v = at = None
        n = i = 0
        for name, idx, own, m in part:
            before, at = at, idx if m else at
            v, n, i = own if own is not None else v, n + m, i + idx
            r = got[name, idx]
            assert (r["v"], r["at"], r["before"], r["n"], r["i"]) == (v, at, before, n, i)


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_values_of_a_whole_file(spark, chunk):
    rows, df = make(spark, 11)
    marked = position.scan(
        df, least={"first_mark": F.when(F.col("m"), F.col("row_idx"))}, greatest={"last_text": F.col("v")}, chunk_rows=chunk
    )
    per_file = spark.createDataFrame([("a", 1), ("c", 3), ("z", 9)], "src_file string, tag int")
    got = position.attach(marked, per_file, chunk_rows=chunk).collect()
    files = by_file(rows)
    assert len(got) == len(rows)
    for r in got:
        part = files[r["src_file"]]
        assert r["first_mark"] == min((p[1] for p in part if p[3]), default=None)
        assert r["last_text"] == max((p[2] for p in part if p[2] is not None), default=None)
        assert r["tag"] == {"a": 1, "c": 3}.get(r["src_file"])
    left = position.drop_first(df, chunk_rows=chunk).collect()
    assert sorted((r["src_file"], r["row_idx"]) for r in left) == sorted((n, i) for n, i, _, _ in rows if i)


def test_rows_of_one_file_are_not_dealt_by_file(spark):
    _, df = make(spark, 3)
    cells = df.select("src_file", "row_idx", F.col("v").alias("c1"))
    head = cells.groupBy("src_file").agg(F.max("c1").alias("head"))
    for plan in (position.drop_first(cells), position.attach(cells, head)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        # The rows, with their cell, move by file and chunk only.
        assert "hashpartitioning(src_file#" in text and "_chunk#" in text
        assert not any("SortMergeJoin [src_file" in x and "_chunk" not in x and "c1#" in x for x in text.splitlines())
