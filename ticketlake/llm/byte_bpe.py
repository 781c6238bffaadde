"""Byte-level BPE encoding and decoding with a two-tier lookup.

First tier: a minimal perfect hash over the vocabulary tells in two probes whether a whole pre-token is
a vocabulary entry, and its id.  Second tier, for the rest: a heap of adjacent pairs over a linked list
of bytes merges the pair of lowest rank, the leftmost first, until none is left; its time grows as
n log n for a run of n bytes.  Results for a pre-token are remembered in a table of bounded size.

The hash is built on the driver from the rank file and sent with the task; workers read the rank file
for the entries' bytes.

Defined results: a null or empty text has no ids, the digest of no text, and decodes to no bytes;
strings of special tokens are ordinary text; repeated rows get equal results; an empty table gives an
empty result; other columns pass through, but those with the result's names are replaced.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import add_columns

#: Pre-tokens whose ids are remembered by a worker.
REMEMBER = 500_000

# Characters for which the plain pattern below splits as the given one does.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ſ]*")
_LETTER = "A-Za-zÀ-ÖØ-öø-ſ"
_PLAIN_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+|\s+(?!\S)|\s+"


_ALL = (1 << 64) - 1


def place(digest: int, shift: int, n: int) -> int:
    """The slot of a key under a displacement of its bucket."""
    x = digest ^ (shift * 0x9E3779B97F4A7C15 & _ALL)
    return (((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & _ALL) >> 16) % n


@dataclass
class PerfectHash:
    """A minimal perfect hash: key number k of n has a slot of its own among 0 .. n - 1."""

    shifts: np.ndarray  # per bucket: the displacement, or -1 - slot where one key has the bucket
    keys: np.ndarray  # per slot: the number of its key

    def slot(self, digest: int) -> int:
        shift = self._shifts[digest % len(self._shifts)]
        if shift < 0:
            return -1 - shift
        return place(digest, shift, len(self._keys))

    def key(self, digest: int) -> int:
        return self._keys[self.slot(digest)]

    def __post_init__(self):
        self._shifts, self._keys = self.shifts.tolist(), self.keys.tolist()


def build_hash(entries: list[bytes], per_bucket: int = 4) -> PerfectHash:
    """Place the largest buckets first, each with the first displacement that finds free slots."""
    n, n_buckets = len(entries), max(1, len(entries) // per_bucket)
    digests = [xxhash.xxh3_64_intdigest(e) for e in entries]
    buckets: list[list[int]] = [[] for _ in range(n_buckets)]
    for i, d in enumerate(digests):
        buckets[d % n_buckets].append(i)
    taken, shifts, keys = np.zeros(n, bool), np.zeros(n_buckets, np.int64), np.zeros(n, np.int64)
    alone = []
    for b in sorted(range(n_buckets), key=lambda b: -len(buckets[b])):
        inside = buckets[b]
        if len(inside) == 1:
            alone.append(b)
        if len(inside) < 2:
            continue
        for shift in range(1 << 24):
            slots = {place(digests[i], shift, n): i for i in inside}
            if len(slots) == len(inside) and not any(taken[s] for s in slots):
                break
        else:
            raise ValueError("two entries have the same digest")
        shifts[b] = shift
        for s, i in slots.items():
            taken[s], keys[s] = True, i
    for b, s in zip(alone, np.flatnonzero(~taken).tolist(), strict=True):
        shifts[b], keys[s] = -1 - s, buckets[b][0]
    return PerfectHash(shifts, keys)


@functools.lru_cache(maxsize=4)
def read_ranks(path: str) -> tuple[list[bytes], list[int]]:
    """Entries and ids of a rank file: a line has an entry in base64 and its id."""
    with open(path, "rb") as lines:
        rows = [line.split() for line in lines if line.strip()]
    return [base64.b64decode(a) for a, _ in rows], [int(b) for _, b in rows]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a run of bytes: a heap of adjacent pairs over a linked list."""
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        rank, left, stop = heapq.heappop(heap)
        right = end[left]
        # Stale: the left part is gone or longer by now, or the right one is.
        if right < 0 or right >= n or end[right] != stop:
            continue
        end[left], end[right] = stop, -1
        follow = after[right]
        after[left] = follow
        if follow < n:
            before[follow] = left
            rank = get(piece[left : end[follow]])
            if rank is not None:
                heapq.heappush(heap, (rank, left, end[follow]))
        back = before[left]
        if back >= 0:
            rank = get(piece[back:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, back, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class Coder:
    """Encodes texts and decodes ids by the ranks of one file."""

    def __init__(self, path: str, pattern: str, table: PerfectHash, remember: int = REMEMBER):
        entries, ids = read_ranks(path)
        self.entries, self.ids, self.table = entries, ids, table
        self.ranks = dict(zip(entries, ids, strict=True))
        self.bytes_of: list[bytes] = [b""] * (max(ids) + 1)
        for entry, i in zip(entries, ids, strict=True):
            self.bytes_of[i] = entry
        self.split = regex.compile(pattern).findall
        self.plain_split = re.compile(_PLAIN_SPLIT).findall if pattern == _GIVEN_FORM else self.split
        self.known: dict[str, tuple[list[int], str]] = {}
        self.remember = remember

    def piece(self, token: str) -> tuple[list[int], str]:
        raw = token.encode()
        k = self.table.key(xxhash.xxh3_64_intdigest(raw))
        ids = [self.ids[k]] if self.entries[k] == raw else merge(raw, self.ranks)
        if len(self.known) >= self.remember:
            self.known.clear()
        found = self.known[token] = (ids, " ".join(map(str, ids)))
        return found

    def pieces(self, text: str) -> list[tuple[list[int], str]]:
        split = self.plain_split if _PLAIN.fullmatch(text) else self.split
        known, piece = self.known.get, self.piece
        return [known(token) or piece(token) for token in split(text)]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(p[0] for p in self.pieces(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


# The pattern for which the plain one above was written.
_GIVEN_FORM = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_coders: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str, table: PerfectHash) -> Coder:
    """One coder per worker, kept from task to task."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern, table)
    return _coders[path, pattern]


def rows_of(own: Callable[[], Coder]):
    def work():
        code = own()

        def each(batch: pa.RecordBatch):
            counts, ids_sum, bytes_sum = [], [], []
            for value in batch.column("text"):
                pieces = code.pieces(value.as_py() or "")
                ids = list(chain.from_iterable([p[0] for p in pieces]))
                counts.append(len(ids))
                ids_sum.append(hashlib.sha256(" ".join([p[1] for p in pieces]).encode()).hexdigest())
                bytes_sum.append(hashlib.sha256(code.decode(ids)).hexdigest())
            return [pa.array(counts, pa.int64()), pa.array(ids_sum, pa.string()), pa.array(bytes_sum, pa.string())]

        return each

    return work


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with the number and digest of each text's ids, and the digest of what they decode to."""
    table = build_hash(read_ranks(path)[0])
    return add_columns(
        docs,
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        rows_of(lambda: coder(path, pattern, table)),
    )
