"""Toxicity by a subsequence string kernel.

Two words are alike by the runs of ``ORDER`` characters that both contain in order, gaps allowed; a run
that spans s characters counts ``DECAY ** s``.  So ``idiot``, ``idi*ot`` and ``id-i-ot`` stay alike.
The kernel is approximated on Nyström landmarks, words of the labelled texts, and a linear support
vector machine is trained on the landmark features of words from labelled sentences: every word of a
clean text is a negative example, and of each toxic text the word that looks worst so far is a positive one, with the words
that far more toxic texts than clean ones hold, each also with a character put in; training and choice of witnesses alternate (multiple-instance learning).  A text scores as its worst word, and a
logistic curve fitted on whole training texts turns that into 0 .. 1.

The machine is linear in the landmarks, and a landmark is a sum over its subsequences.  So the fitted
machine folds into one weight per subsequence, exactly, and scoring a word sums the weights of its
subsequences: no pair of words is ever compared on the cluster.  Each different word of a batch of
texts is scored once.

Words are runs without white space, lower-cased, as UTF-8 bytes (the rarest bytes count as one); three or more single characters in a
row are also read as one word; a word of more than ``WORD`` bytes is read in overlapping windows, and in those of
the lengths of the learned insults at every byte, since what stands beside an insult hides it.

Defined results: a null or empty text has the score of a text without words; without labelled texts of
both kinds every score is 0; rows with a null label are not learned; repeated rows get equal scores;
other columns pass through, but those named score and predicted are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, fold
from .words import Spans, buffers, slices, text_array

ORDER = 3
DECAY = 0.7
#: Bytes of a word that are read at once, and how far windows of a longer one are apart.
WORD = 20
STEP = 12
LANDMARKS = 256
#: Labelled texts of each kind that the machine is fitted on.
SAMPLE_TEXTS = 1_000
ROUNDS = 4
#: Bytes of text whose different words are scored together.
TOGETHER = 1 << 21
#: Words of clean texts that each round learns from, besides the worst ones.
NEGATIVES = 8_000
#: Evidence that a first witness needs, and that makes every word that has it a positive example.
MIN_HINT = 8.0
STRONG_HINT = 24.0
_ALPHABET = 64


def word_rows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of words: the word's index, start and length (at most WORD bytes)."""
    size = ends - starts
    more = np.where(size > WORD, -(-(size - WORD) // STEP), 0)
    own = np.repeat(np.arange(len(starts)), more + 1)
    turn = np.arange(len(own)) - np.repeat(np.cumsum(more + 1) - (more + 1), more + 1)
    begin = starts[own] + turn * STEP
    return own, begin, np.minimum(WORD, ends[own] - begin)


_picks: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def picks(length: int) -> tuple[np.ndarray, np.ndarray]:
    """All places of ORDER characters in a word of a length, and what each counts."""
    if length not in _picks:
        places = np.array(list(combinations(range(length), ORDER)), np.int64).reshape(-1, ORDER)
        _picks[length] = places, (DECAY ** (places[:, -1] - places[:, 0] + 1.0)).astype(np.float32)
    return _picks[length]


def self_kernel(codes: np.ndarray) -> np.ndarray:
    """The kernel of each word with itself, by dynamic programming; ``codes``: words of one length."""
    n, length = codes.shape
    same = (codes[:, :, None] == codes[:, None, :]).astype(np.float32)
    inner = np.ones((n, length + 1, length + 1), np.float32)
    total = np.zeros(n, np.float32)
    for k in range(ORDER):
        nxt = np.zeros_like(inner)
        hits = same * inner[:, :-1, :-1] * np.float32(DECAY * DECAY)
        if k == ORDER - 1:
            total = hits.sum((1, 2))
            break
        for i in range(length):
            row = np.zeros(n, np.float32)
            for j in range(length):
                row = np.float32(DECAY) * row + hits[:, i, j]
                nxt[:, i + 1, j + 1] = np.float32(DECAY) * nxt[:, i, j + 1] + row
        inner = nxt
    return total


@dataclass
class Machine:
    """Weights of subsequences, and the logistic curve over a text's worst word."""

    classes: np.ndarray  # byte -> class; 0: a byte that no landmark has
    weights: np.ndarray  # per subsequence of classes
    bias: float
    slope: float = 0.0
    middle: float = 0.0
    trained: bool = False
    sizes: tuple[int, ...] = ()  # lengths of the learned insults, gapped ones too

    def words(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The machine's value of each word window."""
        out = np.full(len(begin), self.bias, np.float32)
        for length in np.unique(size):
            if length < ORDER:
                continue
            which = np.flatnonzero(size == length)
            places, counts = picks(int(length))
            step = max(1, 2_000_000 // len(places))
            for s in range(0, len(which), step):
                part = which[s : s + step]
                raw = data[begin[part][:, None] + np.arange(length)]
                codes = self.classes[raw]
                key = codes[:, places[:, 0]]
                for k in range(1, ORDER):
                    key = key * _ALPHABET + codes[:, places[:, k]]
                value = self.weights[key] @ counts
                norm = np.empty(len(part), np.float32)
                for t in range(0, len(part), 4096):
                    norm[t : t + 4096] = self_kernel(codes[t : t + 4096])
                out[part] += value / np.sqrt(norm)
        return out

    def worst(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The highest value among the windows of each word."""
        own, begin, size = word_rows(data, starts, ends)
        out = np.maximum.reduceat(self.words(data, begin, size), np.searchsorted(own, np.arange(len(starts))))
        run = np.flatnonzero(ends - starts > WORD)
        if not len(run):
            return out
        known = self.classes[data] > 0
        length = ends[run] - starts[run]
        owner = np.repeat(run, length)
        place = np.arange(len(owner)) + np.repeat(starts[run] - (np.cumsum(length) - length), length)
        for n in self.sizes:
            # A window that begins or ends with a byte that no landmark has is less than the one without it.
            inside = np.flatnonzero(place + n <= ends[owner])
            inside = inside[known[place[inside]] & known[place[inside] + n - 1]]
            for s in range(0, len(inside), 1 << 16):
                part = inside[s : s + (1 << 16)]
                texts = data[place[part][:, None] + np.arange(n)]
                _, one, back = np.unique(texts.view(f"V{n}").ravel(), return_index=True, return_inverse=True)
                value = self.words(data, place[part[one]], np.full(len(one), n))
                np.maximum.at(out, owner[part], value[back])
        return out

    def score(self, worst: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(worst))
        return 1 / (1 + np.exp(-np.clip(self.slope * (worst - self.middle), -30, 30)))


def joined_singles(data: np.ndarray, ws: np.ndarray, we: np.ndarray, ranges: np.ndarray) -> list[tuple[int, bytes]]:
    """Words spelled with spaces: runs of at least three words of one character each."""
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    single = points[we] - points[ws] == 1
    found = []
    if len(ws) >= 3 and single.any():
        owner = np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))
        run = single.copy()
        change = np.flatnonzero(np.diff(np.concatenate([[0], run.astype(np.int8), [0]])))
        for a, b in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            if b - a < 3:
                continue
            for text in np.unique(owner[a:b]).tolist():
                inside = [i for i in range(a, b) if owner[i] == text]
                if len(inside) >= 3:
                    found.append((text, b"".join(data[ws[i] : we[i]].tobytes() for i in inside)))
    return found


def worst_words(machine: Machine, texts: pa.Array) -> np.ndarray:
    """The highest value among each text's words."""
    out = np.full(len(texts), machine.bias, np.float64)
    low = pc.utf8_lower(texts)
    for start, end in slices(low, TOGETHER):
        data, off = buffers(low.slice(start, end - start))
        spans = Spans(data, off)
        ws, we, ranges = spans.words()
        spelled = joined_singles(data, ws, we, ranges)
        if len(ws):
            _, one, back = np.unique(spans.hashes(ws, we), return_index=True, return_inverse=True)
            value = machine.worst(data, ws[one], we[one])
            full = np.flatnonzero(np.diff(ranges))
            out[start + full] = np.maximum(out[start + full], np.maximum.reduceat(value[back], ranges[:-1][full]))
        for text, word in spelled:
            raw = np.frombuffer(word, np.uint8)
            out[start + text] = max(out[start + text], machine.worst(raw, np.array([0]), np.array([len(raw)]))[0])
    return out


# ---- training, on a bounded sample


def features(words: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, normalised count) of all words of ORDER bytes or more, sorted by word."""
    sizes = np.array([len(w) for w in words], np.int64)
    owners, keys, values = [], [], []
    for length in np.unique(sizes[sizes >= ORDER]).tolist():
        which = np.flatnonzero(sizes == length)
        places, counts = picks(length)
        step = max(1, 1_000_000 // len(places))
        for s in range(0, len(which), step):
            part = which[s : s + step]
            codes = classes[np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(-1, length)]
            key = np.broadcast_to(np.arange(len(part))[:, None], (len(part), len(places)))
            for k in range(ORDER):
                key = key * _ALPHABET + codes[:, places[:, k]]
            uniq, at = np.unique(key.ravel(), return_inverse=True)
            value = np.bincount(at, np.broadcast_to(counts, key.shape).ravel())
            own = uniq // _ALPHABET**ORDER
            norm = np.sqrt(np.bincount(own, value**2))
            owners.append(part[own])
            keys.append(uniq % _ALPHABET**ORDER)
            values.append((value / norm[own]).astype(np.float32))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    return np.concatenate(owners), np.concatenate(keys), np.concatenate(values)


def gram(words: list[bytes], landmarks: list[bytes], classes: np.ndarray) -> np.ndarray:
    """Normalised kernel of words with landmarks."""
    mo, mk, mv = features(landmarks, classes)
    used, at = np.unique(mk, return_inverse=True)
    base = np.zeros((len(landmarks), len(used)), np.float32)
    np.add.at(base, (mo, at), mv)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for s in range(0, len(words), 2000):
        part = words[s : s + 2000]
        wo, wk, wv = features(part, classes)
        place = np.searchsorted(used, wk)
        ok = (place < len(used)) & (used[np.minimum(place, len(used) - 1)] == wk)
        mine = np.zeros((len(part), len(used)), np.float32)
        np.add.at(mine, (wo[ok], place[ok]), wv[ok])
        out[s : s + 2000] = mine @ base.T
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, lam: float = 1e-4, steps: int = 250) -> np.ndarray:
    """Squared hinge loss by gradient descent with momentum; the last column of x is 1."""
    w = np.zeros(x.shape[1])
    v = np.zeros_like(w)
    rate = 1.0 / (2 * weight @ np.einsum("ij,ij->i", x, x) / weight.sum() + lam)
    for step in range(steps):
        look = w + step / (step + 3) * v
        gap = np.maximum(0, 1 - y * (x @ look.astype(x.dtype)))
        grad = -2 * ((weight * y * gap).astype(x.dtype) @ x) / weight.sum() + lam * look
        new = look - rate * grad
        v, w = new - w, new
    return w


def text_words(text: str) -> list[bytes]:
    """Word windows of one text, as worst_words reads them."""
    low = pc.utf8_lower(pa.array([text], pa.large_string()))
    data, off = buffers(low)
    ws, we, ranges = Spans(data, off).words()
    _, begin, size = word_rows(data, ws, we)
    found = {data[b : b + n].tobytes() for b, n in zip(begin.tolist(), size.tolist(), strict=True)}
    for _, word in joined_singles(data, ws, we, ranges):
        raw = np.frombuffer(word, np.uint8)
        _, begin, size = word_rows(raw, np.array([0]), np.array([len(raw)]))
        found |= {raw[b : b + n].tobytes() for b, n in zip(begin.tolist(), size.tolist(), strict=True)}
    return sorted(found)


def untrained() -> Machine:
    return Machine(np.zeros(256, np.int64), np.zeros(_ALPHABET**ORDER, np.float32), 0.0)


def suspicion(toxic: list[list[bytes]], clean: list[list[bytes]]) -> dict[bytes, float]:
    """For runs of four and five characters: how far more toxic texts than clean ones hold them (log likelihood)."""

    def found(texts: list[list[bytes]]) -> dict[bytes, int]:
        counts: dict[bytes, int] = {}
        for words in texts:
            for g in {w[i : i + n] for w in words for n in (4, 5) for i in range(len(w) - n + 1)}:
                counts[g] = counts.get(g, 0) + 1
        return counts

    a, b = found(toxic), found(clean)
    share = len(toxic) / (len(toxic) + len(clean))
    out = {}
    for g, x in a.items():
        y = b.get(g, 0)
        due = (x + y) * share
        if x > due:
            out[g] = x * np.log(x / due) + (y * np.log(y / (x + y - due)) if y else 0.0)
    return out


def train(
    positive: dict[bytes, float], negative: dict[bytes, float], landmarks: list[bytes], classes: np.ndarray
) -> Machine:
    """Nyström features of the weighted words on the landmarks, a linear machine, folded into weights."""
    size, turn = np.linalg.eigh(gram(landmarks, landmarks, classes).astype(np.float64))
    good = size > 1e-5 * size.max()
    root = turn[:, good] / np.sqrt(size[good])
    words = [*positive, *negative]
    x = np.ones((len(words), root.shape[1] + 1), np.float32)
    x[:, :-1] = gram(words, landmarks, classes) @ root.astype(np.float32)
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    plus, minus = np.array([*positive.values()], float), np.array([*negative.values()], float)
    fitted = linear_svm(x, y, np.concatenate([plus / plus.sum(), minus / minus.sum()]))
    alpha = root @ fitted[:-1]
    owner, keys, values = features(landmarks, classes)
    weights = np.zeros(_ALPHABET**ORDER)
    np.add.at(weights, keys, values * alpha[owner])
    return Machine(classes, weights.astype(np.float32), float(fitted[-1]))


def spread_out(words: list[bytes], n: int) -> list[bytes]:
    """At most n words: the first half of the list's share, then evenly through the rest."""
    head, rest = words[: n // 2], words[n // 2 :]
    return head + rest[:: max(1, -(-len(rest) // max(1, n - len(head))))]


def fit(texts: list[str], labels: list[int]) -> Machine:
    """Train on labelled texts."""
    toxic = [t for t in (text_words(t) for t, y in zip(texts, labels, strict=True) if y == 1) if t]
    clean = [t for t in (text_words(t) for t, y in zip(texts, labels, strict=True) if y != 1) if t]
    if not toxic or not clean:
        return untrained()
    times: dict[bytes, int] = {}
    for t in clean:
        for w in t:
            times[w] = times.get(w, 0) + 1
    letters = np.bincount(np.frombuffer(b"".join(w for t in toxic for w in t), np.uint8), minlength=256)
    classes = np.zeros(256, np.int64)
    common = [b for b in np.argsort(-letters, kind="stable").tolist() if letters[b]][: _ALPHABET - 1]
    classes[common] = np.arange(1, len(common) + 1)

    # First witnesses: the word of each toxic text with the most suspicious run of characters.
    hints = suspicion(toxic, clean)
    value = {
        w: max((hints.get(w[i : i + n], 0.0) for n in (4, 5) for i in range(len(w) - n + 1)), default=0.0)
        for w in {w for t in toxic for w in t}
        if w not in times
    }
    chosen = [max(t, key=lambda w: (value.get(w, 0.0), w)) for t in toxic]
    chosen = [w for w in chosen if value.get(w, 0.0) >= MIN_HINT]
    # One text may hold several insults: words with strong evidence stay positive in every round.
    strong = [w for t in toxic for w in t if value.get(w, 0.0) >= STRONG_HINT]
    hard: list[bytes] = []
    usual = sorted((w for w in times if len(w) >= ORDER), key=lambda w: (-times[w], w))
    every = sorted({w for t in toxic for w in t} | set(times))
    number = {w: i for i, w in enumerate(every)}
    buffer = np.frombuffer(b"".join(every), np.uint8)
    sizes = np.array([len(w) for w in every])
    begins = np.cumsum(sizes) - sizes
    bags = [np.array([number[w] for w in t]) for t in toxic]
    bags_clean = [np.array([number[w] for w in t]) for t in clean]
    machine = None
    for _ in range(ROUNDS):
        positive: dict[bytes, float] = {}
        for w in [*chosen, *strong]:
            if len(w) >= ORDER and w not in times:
                positive[w] = positive.get(w, 0) + 1
        # Spellings with something put in between are insults too; all of a word weigh half as much as it.
        for w in [w for w in positive if len(w) < WORD]:
            for k in range(2, len(w) - 1):
                for between in (b"*", b".", b"-"):
                    gapped = w[:k] + between + w[k:]
                    positive.setdefault(gapped, positive[w] / (6 * len(w)))
        if not positive:
            return untrained()
        worst_clean: dict[bytes, int] = {}
        for w in hard:
            if len(w) >= ORDER:
                worst_clean[w] = worst_clean.get(w, 0) + 1
        marks = spread_out(sorted(positive, key=lambda w: (-positive[w], w)), LANDMARKS // 2)
        marks += spread_out(sorted(worst_clean, key=lambda w: (-worst_clean[w], w)), LANDMARKS // 4)
        marks += spread_out(usual, LANDMARKS - len(marks))
        negative = {w: times[w] / len(clean) for w in spread_out(usual, NEGATIVES)}
        # A clean text's worst words count as much as all its usual ones.
        scale = sum(negative.values()) / max(1, sum(worst_clean.values()))
        for w, n in worst_clean.items():
            negative[w] = negative.get(w, 0.0) + n * scale
        machine = train(positive, negative, sorted(set(marks)), classes)
        got = machine.words(buffer, begins, sizes)
        chosen = [every[b[got[b].argmax()]] for b in bags]
        # Texts whose worst word looks clean are left out: a label may be wrong.
        chosen = [w for w in chosen if got[number[w]] > -0.5]
        hard += [every[b[got[b].argmax()]] for b in bags_clean]
    high = np.sort([got[b].max() for b in bags])
    low = np.sort([got[b].max() for b in bags_clean])
    # The curve's middle lies in the widest gap with the fewest errors, nearer its toxic end: the clean
    # training texts' worst words were trained on, those of other texts lie higher.
    cuts = np.unique(np.concatenate([high, low]))
    middles = 0.3 * cuts[:-1] + 0.7 * cuts[1:] if len(cuts) > 1 else cuts
    errors = np.searchsorted(high, middles) / len(high) + 4 * (len(low) - np.searchsorted(low, middles)) / len(low)
    gap = np.diff(cuts) if len(cuts) > 1 else np.ones(1)
    machine.middle = float(middles[np.lexsort((-gap, errors))[0]])
    machine.slope, machine.trained = 6.0, True
    machine.sizes = tuple(sorted({len(w) for w in positive if len(w) <= WORD}))
    return machine


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """A bounded sample of labelled texts of each kind, from the learning folds."""
    known = labels.filter(F.col("toxic").isNotNull() & (fold("doc_id", 5) != 0)).select("doc_id", "toxic").distinct()
    picked = None
    for kind in (0, 1):
        part = known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_TEXTS)
        picked = part if picked is None else picked.union(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").filter("text is not null").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


def score(docs: DataFrame, machine: Machine, mark: str = "") -> DataFrame:
    """``docs`` with score and predicted, their names preceded by ``mark``."""
    # The table of weights is of fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work():
        own = shared.value

        def each(batch: pa.RecordBatch):
            found = own.score(worst_words(own, text_array(batch.column("text"))))
            return [pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))]

        return each

    return add_columns(docs, f"{mark}score double, {mark}predicted int", work)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns."""
    found = score(docs, fit(*sample(docs, labels)), "__")
    return found.filter("__predicted = 0").select([F.col(f"`{c}`") for c in docs.columns])
