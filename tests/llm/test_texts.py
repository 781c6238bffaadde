"""Counts, languages, toxicity, scores: against plain versions, on odd rows and on nothing."""

import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ticketlake.llm import language, lm_score, quality, toxicity
from ticketlake.llm.queries import REGISTRY, table, vocabulary

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + k for i in range(len(words) - 2) for k in range(3) if grams[tuple(words[i : i + 3])] > 1}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines), len(lines) - len(set(lines)), len(inside),
    )


def test_counts_of_odd_texts():
    texts = pa.array([t or "" for t in ODD_TEXTS], pa.large_string())
    got = list(zip(*[c.tolist() for c in quality.count_texts(texts)], strict=True))
    assert got == [counts(t) for t in ODD_TEXTS]


def test_counts_in_small_slices(monkeypatch):
    monkeypatch.setattr("ticketlake.llm.words.SLICE_BYTES", 64)
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("ab c\n| é"), rng.integers(0, 90))) for _ in range(200)]
    got = list(zip(*[c.tolist() for c in quality.count_texts(pa.array(texts, pa.large_string()))], strict=True))
    assert got == [counts(t) for t in texts]


def test_quality_on_odd_rows(spark, odd, nothing):
    rows = quality.judge(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].n_words == 0 and by_id[0].base_failed and not by_id[0].kept
    assert all(not r.kept for r in rows if r.base_failed)
    assert quality.judge(nothing).count() == 0


def test_sketch_cells_are_close(spark):
    values = [0, 1, 127, 128, 129, 255, 256, 1000, 123_456, 10**9]
    got = spark.createDataFrame([(v,) for v in values], "v bigint").select(quality.cell(quality.F.col("v")).alias("c"))
    for v, row in zip(values, got.collect(), strict=True):
        assert row.c <= v and (row.c == v if v < 128 else (v - row.c) / v < 1 / 64)


def test_thresholds_merge_small_groups(spark):
    rows = [("en", f"s{i % 4}", 100, 500, 2 * (i % 3), 10, 0, 0) for i in range(400)]
    rows += [("de", "s0", 100, 500, 90, 10, 0, 0) for _ in range(5)]
    data = spark.createDataFrame(
        rows, "lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, "
        "n_dup_lines bigint, n_repeat_words bigint",
    )
    limits = {(r.lang, r.source): r for r in quality.thresholds(quality.sketch(data), 50).collect()}
    # Five German texts do not move their own threshold: the merged sketch gives it.
    assert limits["de", "s0"].most_symbol_rate == limits["en", "s0"].most_symbol_rate < 900


# ---- language

SAMPLES = {"a": "hello there world and more of the same", "b": "hallo welt und noch mehr davon hier ßß é"}


def plain_phrases(classes, sample, text):
    known = bytes(classes[b] for b in sample.lower().encode())
    total, raw = 0, text.lower().encode()
    for s in range(0, len(raw), language.BLOCK):
        block = bytes(classes[b] for b in raw[s : s + language.BLOCK])
        i = 0
        while i < len(block):
            k = 1
            while i + k <= len(block) and block[i : i + k] in known:
                k += 1
            i += max(1, k - 1)
            total += 1
    return total


def test_phrases_are_longest_matches(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 16)
    model = language.fit(SAMPLES)
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("helo wrdanßétx.Z "), rng.integers(0, 60))) for _ in range(200)]
    got = language.phrases(model, pa.array(texts, pa.large_string()))
    assert got.tolist() == [[plain_phrases(model.classes, SAMPLES[n], t) for n in model.names] for t in texts]


def test_language_on_odd_rows(odd, nothing):
    model = language.fit(SAMPLES)
    rows = language.identify(odd, model).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r for r in rows}
    assert [got[i].lang_pred for i in (0, 1, 2, None)] == ["und"] * 4
    assert all(0 <= r.score <= 1 and (r.lang_pred == "und") == (r.score == 0) for r in rows)
    assert language.identify(nothing, model).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.fit({})).collect()} == {"und"}
    kept = language.keep_identified(odd)
    assert kept.columns == odd.columns
    assert {r.score for r in kept.collect()} == {-1.0}  # the input's own column
    assert kept.count() == odd.count() - 4


def test_every_language_is_learned(spark, monkeypatch):
    rng = np.random.default_rng(9)
    spell = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(8)] for _ in range(80)]
    rows = [(f"l{k:02}", " ".join(rng.choice(spell[k], 30))) for k in range(80) for _ in range(8)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string")
    model = language.fit(language.sample(docs))
    assert len(model.names) == 80
    assert all(r.lang == r.lang_pred for r in language.identify(docs, model).collect())
    texts = pa.array([t for _, t in rows[::7]], pa.large_string())
    kept = language.phrases(model, texts)
    model.laid_out.clear()
    monkeypatch.setattr(language, "TABLE_BYTES", 0)
    assert (language.phrases(model, texts) == kept).all() and not model.laid_out


def test_samples_are_no_headers(spark):
    headers = ["1234 5678. " * 200, "a licence in another language " * 60]
    rows = [(i, "xx", headers[i % 2] + "".join(f"zug{i} quark " for _ in range(300))) for i in range(100)]
    found = language.sample(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"))["xx"]
    assert found.count("quark") * len("zug00 quark ") > len(found) / 3
    assert len(set(re.findall(r"zug\d\d", found))) > 40
    assert all(re.search("[a-z]", span) for span in found.split("\n")[:-1])


@needs_data
def test_languages_are_told(spark):
    rows = REGISTRY["op8_language"].run(spark, SF).join(table(spark, SF, "documents"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n_chars > 50]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


# ---- toxicity


def kernel(s, t):
    from itertools import combinations

    def runs(word):
        out = Counter()
        for places in combinations(range(len(word)), toxicity.ORDER):
            out[tuple(word[i] for i in places)] += toxicity.DECAY ** (places[-1] - places[0] + 1)
        return out

    a, b = runs(s), runs(t)
    return sum(v * b[k] for k, v in a.items())


def test_kernel_of_gapped_words():
    for word in (b"idiot", b"idi*ot", b"aaaaab"):
        codes = np.frombuffer(word, np.uint8)[None, :]
        assert np.isclose(toxicity.self_kernel(codes)[0], kernel(word, word), rtol=1e-5)
    classes = np.arange(256) % 64
    got = toxicity.gram([b"idiot", b"i-d-iot"], [b"idiot", b"moron"], classes)
    want = [[kernel(x, y) / np.sqrt(kernel(x, x) * kernel(y, y)) for y in (b"idiot", b"moron")] for x in (b"idiot", b"i-d-iot")]
    assert np.allclose(got, want, atol=1e-5)
    assert got[1, 0] > 3 * got[1, 1]


def test_folded_machine_is_the_landmark_machine():
    classes = np.arange(256) % 64
    marks = [b"idiot", b"moron", b"hello", b"world"]
    machine = toxicity.train({b"idiot": 3, b"moron": 2}, {b"hello": 1.0, b"world": 1.0, b"thing": 1.0}, marks, classes)
    words = [b"idiot", b"idi0t", b"hello", b"words"]
    raw = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    got = machine.words(raw, np.cumsum(sizes) - sizes, sizes)
    inner = toxicity.gram(marks, marks, classes).astype(float)
    # The decision is linear in the landmark features, so it is a combination of kernel rows.
    rows = toxicity.gram(words, marks, classes)
    solved = np.linalg.lstsq(inner, machine.words(np.frombuffer(b"".join(marks), np.uint8), np.arange(0, 20, 5), np.full(4, 5)) - machine.bias, rcond=None)[0]
    assert np.allclose(got, rows @ solved + machine.bias, atol=1e-3)


def toxic_sample():
    rng = np.random.default_rng(5)
    parts = ["an", "er", "th", "in", "on", "re", "st", "ly", "ou", "ha", "ea", "ti"]
    insults = ["idiot", "moron", "scum", "pathetic", "trash"]
    texts, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(parts, rng.integers(1, 5))) for _ in range(rng.integers(20, 120))]
        if i % 4 == 0:
            words[rng.integers(len(words))] = str(rng.choice(insults))
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_insults_are_found_also_gapped():
    texts, labels = toxic_sample()
    machine = toxicity.fit(texts[:400], labels[:400])
    score = lambda t: machine.score(toxicity.worst_words(machine, pa.array(t, pa.large_string())))
    held = score(texts[400:]) >= 0.5
    assert (held == np.array(labels[400:])).mean() >= 0.98
    clean = texts[401]
    assert (score([f"{clean} {x}" for x in ("IDIOT", "idi*ot", "path_etic", "m.oron", "i d i o t", "tra-sh", "patheeetic")]) >= 0.5).all()
    assert (score([clean, "", "a b"]) < 0.5).all()


def test_insults_are_found_at_every_offset_of_a_long_run():
    texts, labels = toxic_sample()
    machine = toxicity.fit(texts[:400], labels[:400])
    score = lambda t: machine.score(toxicity.worst_words(machine, pa.array(t, pa.large_string())))
    parts = sorted({w for t, y in zip(texts, labels, strict=True) if not y for w in t.split()})
    run = "".join(parts[:40])[:60]
    for insult in ("idiot", "scum", "idi*ot", "path_etic", "pathetic"):
        assert (score([run[:k] + insult + run[k:] for k in range(40)]) >= 0.5).all()
    assert (score([run, f"https://www.example.org/{run}", "中文字" * 40]) < 0.5).all()


def test_toxicity_on_odd_rows(spark, odd, nothing):
    texts, labels = toxic_sample()
    machine = toxicity.fit(texts[:200], labels[:200])
    rows = toxicity.score(odd, machine).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score(nothing, machine).count() == 0
    unlabelled = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    kept = toxicity.keep_clean(odd, unlabelled)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.keep_clean(nothing, unlabelled).count() == 0


# ---- scores


def test_model_scores_sum_to_one():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 40, rng.integers(0, 70)).astype("<u2") for _ in range(40)]
    end, size = 50, 51
    counts_ = np.bincount(np.concatenate(texts), minlength=size)
    counts_[end] = len(texts)
    model = lm_score.train(texts, counts_, end, steps=20)
    flow = [np.concatenate([[end], t, [end]]).astype(np.int64) for t in texts]
    pairs, n = np.unique(np.concatenate([x[:-1] << 16 | x[1:] for x in flow]), return_counts=True)
    model.learn_pairs(pairs, n)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = lm_score.text_scores(model, np.concatenate(texts).astype(np.int64), bounds)
    for text, value in zip(texts, got, strict=True):
        seq, want = [end, *text.tolist()], 0.0
        for i, own in enumerate(seq):
            at = np.arange(max(0, (i // lm_score.STRIDE - 1) * lm_score.STRIDE), i + 1)
            rows = model.table[model.row_of[[seq[j] for j in at]]]
            me = model.table[model.row_of[own]]
            w = lm_score.WIDTH
            bias = model.bias[i % lm_score.STRIDE, i % lm_score.STRIDE + lm_score.STRIDE - (i - at)]
            a = np.exp(rows[:, w : 2 * w] @ me[:w] + bias)
            z = (a / a.sum()) @ rows[:, 2 * w : 3 * w] @ model.out + me[3 * w :]
            p = np.exp(z) / np.exp(z).sum()
            every = np.arange(size)
            full = p[model.class_of[every]] * model.within(np.full(size, own), every)
            # Classes without any id have a share too: what is left sums to that of the others.
            assert np.isclose(full.sum(), p[np.unique(model.class_of)].sum(), atol=1e-4)
            want += np.log10(full[seq[i + 1] if i + 1 < len(seq) else end])
        assert np.isclose(value, want, atol=1e-2)


def base_of(rows):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = [[*WORD.findall((t or "").translate(fold)), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for words, h in zip(tokens, held, strict=True) if not h for w in words)
    n, v = sum(c.values()), len(c)
    return sorted(
        ((i is None, i or 0), h, len(w), sum(c[x] > 0 for x in w), n, round(sum(np.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))
        for (i, _), h, w in zip(rows, held, tokens, strict=True)
    )


def test_base_on_odd_rows(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 5)
    path = vocabulary("byte_bpe_50k.json")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for most in (lm_score.HEAD, 3):
        monkeypatch.setattr(lm_score.head_words, "__defaults__", (most,))
        got = lm_score.score(odd, path).collect()
        assert sorted(
            ((r.doc_id is None, r.doc_id or 0), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
        ) == base_of(rows)
        assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_score.score(nothing, path).count() == 0


def test_pairs_beyond_the_table_count_the_same(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 5)
    rng = np.random.default_rng(7)
    words = ["tree", "house", "green", "walks", "under", "small", "river", "old"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    path = vocabulary("byte_bpe_50k.json")
    want = {r.doc_id: r.score for r in lm_score.score(docs, path).collect()}
    for pairs, bits in ((0, (20, 18)), (20, (20, 18)), (lm_score.PAIRS, (2, 1))):
        monkeypatch.setattr(lm_score, "PAIRS", pairs)
        monkeypatch.setattr(lm_score, "SLOT_BITS", bits)
        got = {r.doc_id: r.score for r in lm_score.score(docs, path).collect()}
        assert got.keys() == want.keys()
        assert all(np.isclose(got[i], want[i], atol=1e-3) for i in want)


def test_attention_learns_from_anywhere_in_a_text(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(lm_score, "STEPS", 2)
    monkeypatch.setattr(lm_score, "SAMPLE_PER_TEXT", 20)
    own = lm_score.train
    monkeypatch.setattr(lm_score, "train", lambda texts, *rest: taken.extend(texts) or own(texts, *rest))
    rows = [(i, "same header here " * 20 + f"number {i} of the rest " * 60) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lm_score.score(docs, vocabulary("byte_bpe_50k.json"))
    assert all(len(t) == 20 for t in taken) and len({t.tobytes() for t in taken}) > len(taken) // 2


def test_attention_and_classes_learn_from_every_learning_text(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 2)
    monkeypatch.setattr(lm_score, "SAMPLE_TEXTS", 1)
    found = []
    own = lm_score.learned
    monkeypatch.setattr(
        lm_score, "learned", lambda rows, model: found.append((dict(model.weights), own(rows, model))) or found[-1][1]
    )
    built = lm_score.built
    made = []
    monkeypatch.setattr(lm_score, "built", lambda w, *rest: made.append({n: x.copy() for n, x in w.items()}) or built(w, *rest))
    path = vocabulary("byte_bpe_50k.json")
    words = "tree house green walks under small river old stone bread winter music paper garden window bridge".split()
    rows = [(i, f"the {words[i % 16]} and {words[i * 7 % 16]} number {i} of the rest " * 3) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    lm_score.score(docs, path)
    encode = lm_score.tokenizer(path)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    ids = {i: set(encode(t).tolist()) for i, t in rows}
    (_, model), start, after = found[0], made[0], made[-1]
    unknown = len(start["emb"]) - 2
    learned_ids = set().union(*(ids[i] for i in ids if not held[i]))
    for i in learned_ids:
        row = model.row_of[i]
        assert row < unknown and not np.allclose(start["emb"][row], after["emb"][row])
        assert model.class_of[i] < lm_score.CLASSES - 1
    for i in set().union(*ids.values()) - learned_ids:
        assert model.row_of[i] == unknown
    for name in lm_score.OTHERS:
        assert not np.array_equal(start[name], after[name])


def test_learning_follows_the_gradient(monkeypatch):
    rng = np.random.default_rng(3)
    size, end = 30, 29
    texts = [rng.integers(0, 28, n) for n in (40, 3, 0, 17)]
    counts_ = np.bincount(np.concatenate(texts), minlength=size)
    model = lm_score.train(texts, counts_, end, 5)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    inputs, targets, *_ = lm_score.laid_out(np.concatenate(texts).astype(np.int64), bounds, end, size)

    def loss(weights):
        copy = {n: x.astype(np.float32) for n, x in weights.items()}
        made = lm_score.built(copy, model.row_of, model.class_of, model.inside, end)
        z = lm_score.attend(made, inputs).astype(np.float64)
        want = targets[1:]
        there = want >= 0
        picked = z[there][np.arange(there.sum()), model.class_of[want[there]]]
        return (np.log(np.exp(z[there]).sum(1)) - picked).mean()

    start = {n: x.astype(np.float64) for n, x in model.weights.items()}
    monkeypatch.setattr(lm_score, "RATE", np.float32(1e-3))
    learner = lm_score.Learner(model)
    learner.step(inputs, targets[1:])
    # One step of Adagrad from small squares moves every weight by its gradient's sign, about: the loss falls with each part.
    for name in start:
        moved = {**start, name: learner.w[name].astype(np.float64)}
        moved["emb"] = np.vstack([moved["emb"][:-2], start["emb"][-2:]])
        assert loss(moved) < loss(start), name
    assert learner.ids == sum(len(t) + 1 for t in texts)


def test_a_step_of_learning_is_the_same_in_blocks_of_any_size(monkeypatch):
    rng = np.random.default_rng(4)
    size, end = 60, 59
    texts = [rng.integers(0, 58, n) for n in (300, 3, 0, 170, 90)]
    model = lm_score.train(texts, np.bincount(np.concatenate(texts), minlength=size), end, 5)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = []
    for rows in (1, 7, 10_000):
        monkeypatch.setattr(lm_score, "LEARN_ROWS", rows)
        learner = lm_score.Learner(model)
        learner.texts(np.concatenate(texts).astype(np.int64), bounds)
        found.append(learner)
    for other in found[:2]:
        assert other.ids == found[2].ids == sum(len(t) + 1 for t in texts)
        assert np.array_equal(other.met, found[2].met)
        for name in found[2].w:
            np.testing.assert_allclose(other.w[name], found[2].w[name], atol=2e-5, err_msg=name)


def test_tokenizer_looks_for_special_tokens_as_a_whole(monkeypatch):
    import tiktoken
    from tokenizers import Tokenizer

    from ticketlake.llm import packing

    known = []
    own = tiktoken.Encoding
    monkeypatch.setattr(tiktoken, "Encoding", lambda *a, **k: known.append(k["special_tokens"]) or own(*a, **k))
    path = vocabulary("byte_bpe_50k.json")
    encode = packing.tokenizer.__wrapped__(path)
    # Without any, the library looks for the empty text at every character.
    assert known and known[0] and "" not in known[0]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for text in ("", " ", *known[0], *(f"one{s}{s} two\n{s}" for s in known[0]), "It's  a\tsmall\n\n text 12 é"):
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pairs_with_a_slot_are_not_looked_up_again(monkeypatch):
    rng = np.random.default_rng(5)
    size, end = 60, 59
    texts = [rng.integers(0, 58, n) for n in (300, 3, 0, 170)]
    model = lm_score.train(texts, np.bincount(np.concatenate(texts), minlength=size), end, 2)
    monkeypatch.setattr(lm_score, "SLOT_BITS", (5, 4))
    before, ids = rng.integers(0, 60, 500), rng.integers(0, 60, 500)
    pairs, n = np.unique(before[:300] << 16 | ids[:300], return_counts=True)
    model.learn_pairs(pairs, n)
    want = (before << 16 | ids).astype(np.uint32)
    counts_ = [{int(p): float(c) for p, c in zip(names, times, strict=True) if c} for names, times in model.slots]
    assert not counts_[0].keys() & counts_[1].keys()
    asked, own = [], lm_score.slot
    monkeypatch.setattr(lm_score, "slot", lambda pairs, slots: asked.append(len(pairs)) or own(pairs, slots))
    assert model.times(want).tolist() == [counts_[0].get(int(p), 0) + counts_[1].get(int(p), 0) for p in want]
    assert asked == [500, sum(int(p) not in counts_[0] for p in want)]


def test_exp_in_place_has_a_bound():
    for values in ([-200.0, 0.0, 3.0], [59.9, 60.0, 61.0, 900.0], []):
        x = np.array(values, np.float32)
        want = np.exp(np.minimum(x, 60))
        lm_score.exp_to(x, 60)
        assert np.array_equal(x, want) and np.isfinite(x).all()
