"""Best-fit packing by bin completion.

Texts become token ids and are cut into pieces of at most ``CAPACITY`` ids.  Packing needs only how many
pieces have each length, a table of at most ``CAPACITY`` rows whatever the input.  The driver packs that
table by branch and bound: the longest piece left opens a sequence, the undominated ways to fill the
rest of it are enumerated, the fullest first, by the sums that pieces left can have, and a branch is dropped when its
waste so far lets it no longer beat the best packing known, which starts as best fit decreasing.  The search ends when
a plan meets a lower bound (``Plan.least``) or ``MAX_LOOKS`` fillings were looked at; then it is the best known, not
proven.  A filling is taken as often as the counts allow, so the plan is a few thousand rows at most.

Spark then hands the places of the plan to the pieces: pieces of one length are numbered with counts per
bucket, so that no length meets in one task, and a piece's number gives its sequence and offset.

Defined results: a null or empty text is its end id alone; equal rows get a place each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept
from .words import text_array

CAPACITY = 1024
END_ID = 2
#: Fillings that a sequence may branch into, and fillings that the whole search looks at.
MAX_FILLINGS = 12
MAX_LOOKS = 60_000
#: Pieces that are numbered together.
BUCKET_ROWS = 20_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# Characters on which both tokenizer libraries agree by the same classes.
_COMMON = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    """Ids of a text by a byte-level BPE file.

    The vocabulary's merges are run by the faster of two libraries that give the same ids; texts with
    characters whose class may differ between them go to the file's own library.
    """
    from tiktoken import Encoding
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    from_char = {c: b for b, c in byte_letters().items()}
    ranks = {
        bytes(from_char[c] for c in entry): i
        for entry, i in own.get_vocab(with_added_tokens=False).items()
        if all(c in from_char for c in entry)
    }
    special = {t.content: i for i, t in own.get_added_tokens_decoder().items()}
    ranks = {entry: i for entry, i in ranks.items() if entry.decode(errors="replace") not in special}
    # No special token is allowed below, so all are ordinary text; but if it knows none, the library looks for one at every character.
    known = special or {"<|endoftext|>": max(ranks.values(), default=-1) + 1}
    fast = Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=known)

    def ids(text: str) -> np.ndarray:
        if text.isascii() and text.isprintable() or _COMMON.fullmatch(text):
            return np.asarray(fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), np.uint32)
        return np.asarray(own.encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


# How byte-level vocabularies write bytes, and the split they use.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[int, str]:
    """Printable bytes stand for themselves; the others, in order, for characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of n ids; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every text (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        for batch in batches:
            texts = text_array(batch.column("text"))
            rows: list[tuple] = []
            where: list[int] = []
            for i, value in enumerate(texts):
                ids = np.append(encode(value.as_py()), np.uint32(END_ID)).astype("<u4")
                raw = memoryview(ids).cast("B")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
                    where.append(i)
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            owners = batch.column("doc_id").take(pa.array(where, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [owners, pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


# ---- bin completion on the table of lengths


@dataclass
class Plan:
    """Fillings (length: times) and how many sequences each of them has."""

    fillings: list[tuple[dict[int, int], int]] = field(default_factory=list)
    #: No plan has fewer sequences.
    least: int = 0

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.fillings)


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing over counts: the longest piece, then always the longest that still fits."""
    left = {k: v for k, v in counts.items() if v}
    plan = Plan()
    while left:
        filling: dict[int, int] = {}
        room = capacity
        for length in sorted(left, reverse=True):
            if length <= room:
                n = min(left[length], room // length)
                filling[length] = n
                room -= n * length
        times = min(left[k] // n for k, n in filling.items())
        _take(left, filling, times)
        plan.fillings.append((filling, times))
    return plan


def _take(left: dict[int, int], filling: dict[int, int], times: int) -> None:
    for k, n in filling.items():
        left[k] -= n * times
        if not left[k]:
            del left[k]


def _sums(items: list[int]) -> int:
    """Bit s is set if some of the items add up to s."""
    bits = 1
    for x in items:
        bits |= bits << x
    return bits


def dominated(items: list[int], room: int, left: dict[int, int], longest: list[int]) -> bool:
    """Whether a longer piece that is left could stand for some of the items within the room."""
    spare = room - sum(items)
    sums = _sums(items)
    for x in longest:
        if x > room:
            continue
        free = left[x] - items.count(x)
        if free <= 0:
            continue
        # Some items of sum x - spare .. x - 1 give way to x; of sum x, if they are more than one.
        window = (sums >> max(1, x - spare)) & ((1 << max(0, min(spare, x - 1))) - 1)
        if window:
            return True
        if x not in items and (sums >> x) & 1:
            return True
    return False


class Sums:
    """Which sums pieces of ``lengths`` from number i on have, up to ``room``; the last ones first."""

    def __init__(self, lengths: list[int], left: dict[int, int], room: int):
        self.lengths, self.left, self.room = lengths, left, room
        self.bits = [1]

    def has(self, i: int, total: int) -> bool:
        """Whether pieces of ``lengths[i:]`` add up to ``total``."""
        back = len(self.lengths) - i
        while len(self.bits) <= back:
            x = self.lengths[-len(self.bits)]
            bits, n, step = self.bits[-1], min(self.left[x], self.room // x), 1
            while n:
                take = min(step, n)
                bits |= bits << (take * x)
                n, step = n - take, step * 2
            self.bits.append(bits & ((1 << (self.room + 1)) - 1))
        return bool((self.bits[back] >> total) & 1)

    def ways(self, i: int, total: int) -> Iterator[tuple[int, ...]]:
        """Pieces of ``lengths[i:]`` that add up to ``total``, in the order of ``lengths``.

        A branch is entered only if the pieces behind it can make up what is still missing, so each ends in a filling.
        """
        if total == 0:
            yield ()
            return
        for j in range(i, len(self.lengths)):
            if not self.has(j, total):
                return
            x = self.lengths[j]
            for n in range(min(self.left[x], total // x), 0, -1):
                if self.has(j + 1, total - n * x):
                    for others in self.ways(j + 1, total - n * x):
                        yield (*[x] * n, *others)


def fillings(
    left: dict[int, int], first: int, capacity: int, waste: int, most: int = MAX_FILLINGS, looks: Callable[[int], object] = int
) -> Iterator[dict[int, int]]:
    """Undominated ways to fill a sequence around a piece of length ``first``, the least waste first.

    At most 24 * ``most`` are looked at; ``looks`` is told how many.

    Of the first ways of equal waste, those come first that keep the shortest pieces, which fit anywhere, for later.
    """
    room = capacity - first
    own = dict(left)
    own[first] -= 1
    lengths = [x for x in sorted(own, reverse=True) if x <= room and own[x] > 0]
    sums = Sums(lengths, own, room)
    given = looked = 0
    spare: tuple[int, ...] | None = None
    for lost in range(min(waste, room) + 1):
        if given == most or looked >= 20 * most:
            break
        if not sums.has(0, room - lost):
            continue
        some = list(islice(sums.ways(0, room - lost), 4 * most))
        looked += len(some)
        looks(len(some))
        for items in sorted(some, key=lambda items: -min(items, default=0)):
            if dominated(list(items), room, own, lengths):
                spare = spare or items
                continue
            yield with_first(first, items)
            given += 1
            if given == most:
                break
    if not given and spare is not None:
        # All that were looked at are dominated: the fullest of them, rather than none.
        yield with_first(first, spare)


def with_first(first: int, items: tuple[int, ...]) -> dict[int, int]:
    filling = {first: 1}
    for x in items:
        filling[x] = filling.get(x, 0) + 1
    return filling


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that no plan can do without.

    For every k: a piece longer than capacity - k shares with none of at least k, one longer than half with no other
    such; pieces from k to half go into what those leave, or into further sequences.
    """
    least = -(-sum(x * n for x, n in counts.items()) // capacity)
    for k in {1, *(x for x in counts if 2 * x <= capacity)}:
        alone = sum(n for x, n in counts.items() if x > capacity - k)
        half = {x: n for x, n in counts.items() if 2 * x > capacity and x <= capacity - k}
        small = sum(x * n for x, n in counts.items() if k <= x and 2 * x <= capacity)
        spare = sum((capacity - x) * n for x, n in half.items())
        least = max(least, alone + sum(half.values()) + max(0, -(-(small - spare) // capacity)))
    return least


def complete(counts: dict[int, int], capacity: int = CAPACITY, most: int = MAX_LOOKS) -> Plan:
    """Bin completion: the best plan found in ``most`` looks at fillings; ``least`` is the bound that it is held against.

    Best fit is the first incumbent.  A pass over the tree takes another filling than the first at most ``turns``
    times on a way; passes with more turns follow until a plan meets the bound, no branch was left out, or
    the looks are used up.
    """
    counts = {k: v for k, v in counts.items() if v}
    total = sum(k * v for k, v in counts.items())
    least = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    best.least = least
    if best.sequences == least:
        return best
    steps: list[tuple[dict[int, int], int]] = []
    spent = 0
    left_out = False

    def look(n: int) -> None:
        nonlocal spent
        spent += n

    def branch(left: dict[int, int], wasted: int, used: int, turns: int) -> bool:
        """Follow the fillings of the longest piece left; ``turns``: how often not the first is taken."""
        nonlocal best, left_out
        if not left:
            if used < best.sequences:
                best = Plan(list(steps), least)
            return best.sequences == least
        look(1)
        if spent > most:
            return True
        # To win, a plan may waste so much and no more.
        may = (best.sequences - 1) * capacity - total - wasted
        if may < 0:
            return False
        first = max(left)
        for k, filling in enumerate(fillings(left, first, capacity, min(may, capacity), looks=look)):
            if k and not turns:
                left_out = True
                break
            lost = capacity - sum(x * n for x, n in filling.items())
            times = min(left[x] // n for x, n in filling.items())
            if lost:
                times = min(times, max(1, may // lost))
            rest = dict(left)
            _take(rest, filling, times)
            steps.append((filling, times))
            done = branch(rest, wasted + lost * times, used + times, turns - (k > 0))
            steps.pop()
            if done:
                return True
        return False

    import sys

    deep = sys.getrecursionlimit()
    sys.setrecursionlimit(max(deep, 20 * capacity))
    try:
        turns = 0
        while True:
            left_out = False
            if branch(counts, 0, 0, turns) or not left_out:
                break
            turns += 1
    finally:
        sys.setrecursionlimit(deep)
    return best


# ---- places for the pieces


@dataclass
class Places:
    """For every length, runs of piece numbers that have their places in the same filling."""

    keys: np.ndarray  # length << 40 | first number
    first: np.ndarray
    sequence: np.ndarray
    per_sequence: np.ndarray
    offset: np.ndarray


def places(plan: Plan) -> Places:
    given: dict[int, int] = {}
    rows = []
    sequence = 0
    for filling, times in plan.fillings:
        offset = 0
        for length in sorted(filling, reverse=True):
            n, first = filling[length], given.get(length, 0)
            rows.append(((length << 40) + first, first, sequence, n, offset))
            given[length] = first + n * times
            offset += n * length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Places(*[table[:, i].copy() for i in range(5)])


def place(numbered: DataFrame, at: Places) -> DataFrame:
    """Pieces with their number among those of their length, given sequence_id and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("number", "length"))
            k = np.searchsorted(at.keys, (length << 40) + number, "right") - 1
            inside = number - at.first[k]
            sequence = at.sequence[k] + inside // at.per_sequence[k]
            offset = at.offset[k] + inside % at.per_sequence[k] * length
            rest = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return numbered.mapInArrow(run, f"{PIECES}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every text with its place in as few sequences as were found."""
    cut_up = kept(pieces(docs, path, capacity), "pieces")
    lengths = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = complete(lengths, capacity)
    buckets = max(1, sum(lengths.values()) // BUCKET_ROWS)
    rows = cut_up.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = rows.groupBy("bucket", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    order = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (
        rows.withColumn("number", F.row_number().over(order))
        .join(starts, ["bucket", "length"])
        .withColumn("number", (F.col("begin") + F.col("number") - 1).cast("bigint"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    )
    return place(numbered, places(plan))
