"""Language by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of its labelled text.  A text is
parsed with each automaton: a phrase is the longest run of characters that occurs somewhere in that
language's sample, and the next phrase begins where it ended.  The language whose sample needs the
fewest phrases per letter wins: the number of phrases estimates the cross entropy.

Parsing needs only the automaton's transitions.  They are laid out in one table per language with the restart
worked in, so one gather moves thousands of texts one byte on.  Every learned language has an automaton; a
worker keeps ``TABLE_BYTES`` of tables and lays out the others one at a time from their list of transitions.  Texts are cut into blocks of
``BLOCK`` bytes, a phrase ends with its block, and each block is one lane; no text is cut short.

Letters are lower-cased; every byte that no letter of the samples uses counts as a break.

Defined results: ``und`` with score 0 for a null or empty text and one without any letter; ties go to
the first language by name; a null language is not learned; without any labelled text every result is
``und``; repeated rows get equal results; other columns pass through, but those named lang_pred and
score are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import add_columns, fold
from .words import buffers, slices, text_array

#: Bytes of labelled text per language that an automaton is fitted on, and characters of one text.
SAMPLE_BYTES = 24_000
SAMPLE_PER_TEXT = 1_500
#: Spans of labelled texts per language that the sample is taken from, and characters of a span.
SAMPLE_TEXTS = 200
SPAN = 150
BLOCK = 1024
#: Bytes of text that move on together.
LANE_BYTES = 1 << 23
#: Bytes of laid out tables that a worker keeps.
TABLE_BYTES = 1 << 27
_MISS = np.int32(1 << 30)


def letters(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def break_bytes() -> np.ndarray:
    """ASCII bytes that are no letters: one class, the break between words."""
    found = np.zeros(256, bool)
    found[:128] = True
    found[97:123] = False
    return found


@dataclass
class Automata:
    """Transitions of all languages over shared byte classes."""

    names: list[str]
    classes: np.ndarray
    size: int
    #: Per language: its number of states, and where in its table each transition stands and leads to.
    moves: list[tuple[int, np.ndarray, np.ndarray]]
    laid_out: dict[int, np.ndarray] = field(default_factory=dict)

    def table(self, k: int) -> np.ndarray:
        """The flat transition table of a language; its last row is the start: whatever comes begins a phrase."""
        if k in self.laid_out:
            return self.laid_out[k]
        states, at, to = self.moves[k]
        # A byte that the sample lacks is a phrase by itself, so it leads to the start.
        again = np.full(self.size, states * self.size, np.int32)
        first = at < self.size
        again[at[first]] = to[first]
        flat = np.tile(again + _MISS, states + 1)
        flat[at] = to
        if sum(t.nbytes for t in self.laid_out.values()) + flat.nbytes <= TABLE_BYTES:
            self.laid_out[k] = flat
        return flat


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every run of ``symbols``; state 0 is its root."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return moves


def fit(samples: dict[str, str]) -> Automata:
    names = sorted(n for n in samples if samples[n])
    raw = {n: letters(pa.array([samples[n]]))[0].as_py().encode() for n in names}
    used = sorted(set(b"".join(raw.values())) - set(np.flatnonzero(break_bytes()).tolist()))
    classes = np.zeros(256, np.int32)  # 0: a break, or a byte that no sample has
    for i, byte in enumerate(used):
        classes[byte] = i + 1
    size = len(used) + 1
    found = []
    for n in names:
        symbols = classes[np.frombuffer(raw[n], np.uint8)].tolist()
        moves = suffix_automaton(symbols)
        at = [state * size + s for state, row in enumerate(moves) for s in row]
        to = [target * size for row in moves for target in row.values()]
        found.append((len(moves), np.array(at, np.int32), np.array(to, np.int32)))
    return Automata(names, classes, size, found)


def phrases(model: Automata, texts: pa.Array) -> np.ndarray:
    """Phrases that each text needs, one column per language."""
    out = np.zeros((len(texts), len(model.names)), np.int64)
    low = letters(texts)
    for start, end in slices(low, LANE_BYTES):
        data, off = buffers(low.slice(start, end - start))
        sizes = np.diff(off)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(end - start), blocks)
        if not len(owner):
            continue
        first = np.repeat(off[:-1] - BLOCK * (np.cumsum(blocks) - blocks), blocks) + BLOCK * np.arange(len(owner))
        length = np.minimum(off[1:][owner] - first, BLOCK)
        # The longest lanes first: at every step the live lanes are a prefix.
        order = np.argsort(-length, kind="stable")
        first, length, owner = first[order], length[order], owner[order]
        live = np.searchsorted(-length, -np.arange(BLOCK), "left")
        symbols = model.classes[data]
        for k in range(len(model.names)):
            table = model.table(k)
            state = np.full(len(owner), len(table) - model.size, np.int32)
            count = np.zeros(len(owner), np.int64)
            for j in range(int(length[0])):
                n = live[j]
                got = table[state[:n] + symbols[first[:n] + j]]
                count[:n] += got >> 30
                state[:n] = got & (_MISS - 1)
            np.add.at(out[start:end, k], owner, count)
    return out


def decide(model: Automata, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    known = np.asarray(pc.match_substring_regex(texts, r"\p{L}"))
    if not model.names:
        return ["und"] * len(texts), np.zeros(len(texts))
    found = phrases(model, texts)
    best = found.argmin(1)
    # The share that the winner's rate of compression has among all: 1 / n_languages to 1.
    least = found.min(1)
    weight = np.exp(-4 * (found - least[:, None]) / np.maximum(least, 1)[:, None])
    score = np.where(known, 1 / weight.sum(1), 0.0)
    return [model.names[b] if k else "und" for b, k in zip(best, known, strict=True)], score


def sample(docs: DataFrame) -> dict[str, str]:
    """A bounded sample of labelled text of each language, from the learning folds."""
    known = docs.filter(F.col("lang").isNotNull() & (fold("doc_id", 5) != 0))
    # As many parts as spans that a text gives; a span begins at a hashed place of its part.  The first turn takes one
    # span of each text, from a hashed part.
    spans = F.least(F.ceil(F.length("text") / SPAN), F.lit(SAMPLE_PER_TEXT // SPAN)).cast("int")
    parts = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"), spans.alias("parts"))
    rows = parts.filter("parts > 0").select(
        "lang", "h", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("turn"), "text", "parts"
    )
    wide = F.floor(F.length("text") / F.col("parts"))
    place = F.pmod(F.col("h"), F.col("parts")) + F.col("turn")
    begin = wide * F.pmod(place, F.col("parts")) + F.pmod(F.xxhash64("h", "turn"), F.greatest(wide - SPAN, F.lit(0)) + 1)
    rows = rows.select("lang", "turn", "h", F.col("text").substr(begin.cast("int") + 1, F.lit(SPAN)).alias("text"))
    order = Window.partitionBy("lang").orderBy("turn", "h", "text")
    rows = (
        rows.filter(F.col("text").rlike(r"\p{L}"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= SAMPLE_TEXTS)
        .collect()
    )
    found: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        found.setdefault(row["lang"], []).append(row["text"])
    return {k: "\n".join(v).encode()[:SAMPLE_BYTES].decode(errors="ignore") for k, v in found.items()}


def identify(docs: DataFrame, model: Automata | None = None, mark: str = "") -> DataFrame:
    """``docs`` with lang_pred and score, their names preceded by ``mark``."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(sample(docs)))

    def work():
        def each(batch: pa.RecordBatch):
            names, score = decide(shared.value, text_array(batch.column("text")))
            return [pa.array(names, pa.string()), pa.array(score, pa.float64())]

        return each

    return add_columns(docs, f"{mark}lang_pred string, {mark}score double", work)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language can be told, with their columns."""
    marked = identify(docs, mark="__")
    return marked.filter("__lang_pred != 'und'").select([F.col(f"`{c}`") for c in docs.columns])
