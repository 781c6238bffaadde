"""Quoted reports over many splits against plain readers."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ticketlake.sources import readers, records


def report(seed, rows=400):
    """Rows of three cells with quotes, separators and line breaks in them."""
    rnd = random.Random(seed)
    bits = ['"', ",", "\n", "x", "long words here", "\n\n", "", "é中", '""', "\r\n", " "]
    out = []
    for i in range(rows):
        note = "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 2, 40])))
        out.append([f"k{i}", f"a{note}b", str(rnd.randint(0, 99))])
    if seed == 2:
        out[5][1] = "start " + "line\n" * 3000 + "end"  # a record over many splits
    return out


def as_text(rows, **kind):
    text = io.StringIO()
    csv.writer(text, lineterminator=kind.pop("end", "\n"), **kind).writerows(rows)
    return text.getvalue()


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("seed,kind", [(0, {}), (1, {"quoting": csv.QUOTE_ALL}), (2, {"end": "\r\n"}), (3, {"end": "\r\n", "quoting": csv.QUOTE_ALL})])
def test_records_over_many_splits(small_splits, tmp_path, seed, kind):
    spark = small_splits
    want = {}
    for name in ("一 a.csv", "b.csv"):
        rows = report(seed, 400 if name == "b.csv" else 60)
        (tmp_path / name).write_bytes(as_text(rows, **dict(kind)).encode())
        want[name] = rows
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 4
    grid = readers.read_grid(spark, str(tmp_path), 3, glob="*.csv", quoted_breaks=True)
    found = {}
    for r in grid.collect():
        found.setdefault(r.src_file.split("/")[-1], {})[r.row_idx] = [r.c1, r.c2, r.c3]
    assert set(found) == set(want)
    for name, rows in want.items():
        assert sorted(found[name]) == list(range(len(rows)))
        assert [found[name][i] for i in range(len(rows))] == rows


def test_records_equal_the_reader_of_one_task(small_splits, tmp_path):
    spark = small_splits
    rows = report(7, 300)
    (tmp_path / "a.csv").write_text(as_text(rows, quoting=csv.QUOTE_ALL), newline="")
    whole = (
        spark.read.schema("c1 string, c2 string, c3 string").options(multiLine=True, escape='"').csv(str(tmp_path))
    )
    split = readers.read_grid(spark, str(tmp_path), 3, quoted_breaks=True).drop("src_file", "row_idx")
    trimmed = whole.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) for c in whole.columns])
    # One line feed stands for a carriage return and line feed in Spark's reader.
    same = [F.replace(c, F.lit("\r\n"), F.lit("\n")).alias(c) for c in split.columns]
    assert sorted(map(tuple, split.select(same).collect())) == sorted(map(tuple, trimmed.select(same).collect()))


def test_open_quote_ends_with_its_file(small_splits, tmp_path):
    spark = small_splits
    (tmp_path / "a.csv").write_text('x,1\n"y,2\n' + "z,3\n" * 900)
    (tmp_path / "b.csv").write_text("u,1\n\nv,2")
    got = {}
    for r in records.read_records(spark, str(tmp_path), readers.file_path()).collect():
        got[r.src_file.split("/")[-1], r.row_idx] = r.line
    assert got["a.csv", 0] == "x,1" and got["a.csv", 1] == '"y,2\n' + "\n".join(["z,3"] * 900)
    assert [got["b.csv", i] for i in range(3)] == ["u,1", "", "v,2"] and len(got) == 5


def test_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert readers.read_grid(spark, str(tmp_path), 2, quoted_breaks=True).collect() == []


def test_records_of_one_split_need_no_shuffle(spark, tmp_path):
    (tmp_path / "a.csv").write_text(as_text(report(1, 50)))
    plan = readers.read_grid(spark, str(tmp_path), 3, quoted_breaks=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
