"""Archives, page text, packing and byte-level BPE: exact round trips and plain versions."""

import base64
import hashlib
import os
import random
import re
import zlib
from itertools import pairwise

import numpy as np
import pytest

from ticketlake.llm import byte_bpe, html_text, packing, warc
from ticketlake.llm.queries import REGISTRY, table, vocabulary

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")


# ---- archives

PAYLOADS = [
    "", None, "x\r\n", "y\r\n\r\n", "WARC/1.1\r\nWARC-Type: z\r\n\r\n" * 9, "\r\n\r\nWARC/1.1" * 40, "é" * 5001,
    "a\rb" * 3000 + "\r", "q" * 99, "q" * 99, "w" * 100, "w" * 100, "\x00cut\x00" * 100, "w" * 100,
]


def test_archives_give_back_every_payload(spark):
    rows = [(i if i != 3 else None, f"http://a/\r\nX{i}é", h, "response") for i, h in enumerate(PAYLOADS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, record_type string")
    got = {r.page_id: r for r in warc.round_trip(pages, chunk=1000).collect()}
    assert len(got) == len(rows)
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type != "response"} == {
        11: ("revisit", 10), 13: ("revisit", 10),
    }
    assert got[8].refers_to is None and got[9].record_type == "response"  # below 100 bytes
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_repeated_and_null_pages(spark):
    rows = [(1, "u", "z" * 200), (1, "u", "z" * 200), (None, None, "z" * 200), (2, None, None)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got) == [
        (0, "revisit", 1), (1, "response", 0), (1, "response", 0), (2, "response", 0),
    ]


def test_chunks_carry_running_digests(spark):
    pages = spark.createDataFrame([(1, "u", "abc" * 1000)], "page_id bigint, url string, html string")
    path = warc.shared_dir(spark, "test-archive")
    warc.write_archive(pages, path, 700)
    chunks = warc.digests(warc.read_archive(spark, path, True).repartition("record").sortWithinPartitions("record", "chunk_no"))
    raw = b"abc" * 1000
    for k, row in enumerate(chunks.collect()):
        end = min(len(raw), 700 * (k + 1))
        assert (row.chunk_no, row.payload_bytes, row.payload_digest) == (k, end, hashlib.sha256(raw[:end]).hexdigest())


def test_archives_have_the_headers_of_the_format(spark):
    rows = [(i, f"http://a/{i}", h) for i, h in enumerate(["w" * 250, "w" * 250, "short", ""])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    heads = [r.value.split(warc.END)[0].split("\r\n")[1:] for r in warc.records(pages, chunk=100).collect()]
    found = [dict(line.split(": ", 1) for line in head) for head in heads]
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["WARC-Date"]) for h in found)
    assert all({"WARC-Type", "WARC-Record-ID", "Content-Length"} <= set(h) for h in found)
    assert [h["WARC-Type"] for h in found].count("revisit") == 1
    assert all(("WARC-Profile" in h) == (h["WARC-Type"] == "revisit") for h in found)
    totals = [(h["WARC-Segment-Number"], h["WARC-Segment-Total-Length"]) for h in found if "WARC-Segment-Total-Length" in h]
    assert totals == [("3", "250")] * 2


# ---- page text

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><header>Site</header>'
    '<nav><ul><li><a href="/x">x</a></ul></nav><!-- ad --><div class="ad-box">Buy</div><article><h1>Head &amp; tail</h1>'
    "<p><b>One\n two<br>three<p>Four&nbsp;five<ul><li>six<li>seven</ul><aside>no</aside><form><p>no</form>"
    '<table><tr><td>a<td>b</table><section class="comments"><p>no</section><p>last</article><footer>f</footer>'
)


def test_blocks_of_an_article():
    assert html_text.extract(PAGE) == "Head & tail\n\nOne two three\n\nFour five\n\nsix\n\nseven\n\na\n\nb\n\nlast"
    assert html_text.extract("") == ""
    assert html_text.extract("<p>a<p>b <i>c</i>d") == "a\n\nb cd"
    assert html_text.extract("plain & <b>bold") == "plain & bold"
    assert html_text.extract("a < b <!-- open") == "a < b"
    deep = "<div>" * 5000 + "x"
    assert html_text.extract(deep) == "x"


def test_templates_go_prose_stays(spark):
    shared = "<p>A passage that every article of the host has.</p>"
    rows = [
        (i, f"https://h.example/{i}", f'<body><div><b>Site</b> of all</div><article><div class="x">Share this</div>{shared}<p>Own {i}</article>')
        for i in range(20)
    ]
    rows += [(i, f"https://g.example/{i}", f"<body><div>Menu <b>of g</b></div><div>page {i}</div>") for i in range(20, 40)]
    rows += [(99, None, None), (None, "no host", "<p>x<p>y"), (98, "https://one.example", "<div>Site <b>of</b></div>")]
    pages = spark.createDataFrame([(*r, "mine") for r in rows], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r for r in html_text.main_text(pages).collect()}
    assert len(got) == len(rows)
    assert got[3].text == "A passage that every article of the host has.\n\nOwn 3"
    assert got[25].text == "page 25"
    assert (got[99].text, got[99].n_chars, got[None].text, got[98].text) == ("", 0, "x\n\ny", "Site of")
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_boilerplate_that_rotates_over_a_large_host(spark):
    def around(k):
        return f"<p>Paragraph {k} of the site</p><h2>Heading {k}</h2>", f"<address>Office {k}</address><div class=q>Box <b>{k}</b></div>"

    def page(i, text):
        top, end = around(i % 30)  # each is on 3 percent of the pages
        return (i, f"https://hot.example/{i}", f"<body>{top}{text}{end}</body>")

    rows = [page(i, f"<p>Own {i} with <b>words</b></p>") for i in range(180)]
    rows += [page(i, "<p>A page with copies</p><p>whose text stays</p>") for i in range(180, 240)]
    rows += [(i, f"https://hot.example/{i}", "<body><p>The same</p><div>all over</div></body>") for i in range(240, 260)]
    rows += [(i, f"https://hot.example/{i}", f"<article><p>Own {i}</p>{around(i % 30)[1]}</article>") for i in range(260, 440)]
    rows += [(i, f"https://hot.example/{i}", f"<body><div>Bare</div>text {i}</body>") for i in range(440, 450)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert len(got) == len(rows)
    for i, text in got.items():
        want = f"Own {i} with words" if i < 180 else "A page with copies\n\nwhose text stays" if i < 240 else "The same\n\nall over"
        assert text == (want if i < 260 else f"Own {i}" if i < 440 else f"text {i}")


@needs_data
def test_given_pages(spark):
    given = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    rows = REGISTRY["op4_html_text"].run(spark, SF).collect()
    assert len(rows) == len(given)
    import html as entities

    for r in rows:
        inner = re.search(r"<article>(.*)</article>", given[r.page_id], re.S).group(1)
        blocks = [re.sub(r"<[^>]+>", " ", re.sub(r"</?[bai]>", "", b)) for b in re.split(r"</?(?:p|h1)>", inner)]
        blocks = [re.sub(r"\s+", " ", entities.unescape(b)).strip() for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p>a <select><option>o<option>q</select> b</p><p>c</p><p>d</p></article>", "a b\n\nc\n\nd"),
        ("<article><p>a <select><optgroup><option>o<optgroup><option>q</select>b</p><p>c</p></article>", "a b\n\nc"),
        ("<article><p>if <math><mi>x</mi></math> holds</p></article>", "if x holds"),
        ('<article><p class="ad-hoc">a</p><p class="comment-free search-term">b</p><div class="notice-board">c</div></article>', "a\n\nb\n\nc"),
        ('<article><p>we <span class="share">share</span> it</p><div><span class="share">tweet</span></div></article>', "we share it"),
        ('<article><p>a</p><div class="comment-list">x</div><div class="x comments">y</div><ul id="related_links"><li>z</ul></article>', "a"),
        ("<main><article><p>teaser</p></article><h1>t</h1><p>the whole long story</p></main>", "teaser\n\nt\n\nthe whole long story"),
        ("<main><article><p>the whole long story</p></article><p>more</p></main>", "the whole long story"),
        ('<main><article><p>story</p></article><div class="comments"><p>a long comment of a reader</p></div></main>', "story"),
    ],
)
def test_pages_that_lost_text(page, text):
    assert html_text.extract(page) == text


def test_templates_by_brute_force(spark):
    """Random pages of blocks: a block is cut where five pages of its host, different without it, have it."""
    rnd = random.Random(4)
    blocks = [f"block {i}" for i in range(12)]
    pages = []
    for i in range(60):
        host = rnd.choice("ab")
        some = [b for b in blocks if rnd.random() < (0.1 if int(b[6:]) % 3 else 0.5)]
        own = f"own text {i % 25}"  # some pages are copies
        pages.append((i, f"http://{host}.org/{i}", own, some, host))
    rows = [(i, u, "<body>" + "".join(f"<section>{b}</section>" for b in [*some, own]) + "</body>") for i, u, own, some, _ in pages]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).collect()}
    often = {}
    for i, _, own, some, host in pages:
        for b in {*some, own}:
            often.setdefault((host, b), []).append(i)
    often = {k: v for k, v in often.items() if len(v) >= html_text.MIN_PAGES}
    cut = set()
    by_id = {p[0]: p for p in pages}
    for (host, b), ids in often.items():
        # What a page shows besides everything that recurs on its host.
        rest = {tuple(sorted(x for x in {*by_id[i][3], by_id[i][2]} if (host, x) not in often)) for i in ids}
        if len(rest) >= html_text.MIN_PAGES:
            cut.add((host, b))
    assert cut
    for i, _, own, some, host in pages:
        assert got[i] == "\n\n".join(b for b in [*some, own] if (host, b) not in cut)


# ---- packing


def least_bins(items, capacity):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        tried = set()
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity and bins[j] not in tried:
                tried.add(bins[j])
                bins[j] += items[i]
                go(i + 1, bins)
                bins[j] -= items[i]
        go(i + 1, [*bins, items[i]])

    items = sorted(items, reverse=True)
    go(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(4)
    for _ in range(150):
        items = [rng.randint(1, 30) for _ in range(rng.randint(0, 10))]
        counts = {x: items.count(x) for x in items}
        plan = packing.complete(counts, 30)
        used = {}
        for filling, times in plan.fillings:
            assert sum(k * n for k, n in filling.items()) <= 30
            for k, n in filling.items():
                used[k] = used.get(k, 0) + n * times
        best = least_bins(items, 30)
        assert used == counts and plan.sequences == best and packing.lower_bound(counts, 30) <= best


def test_bin_completion_beats_best_fit_and_meets_the_bound():
    rng = random.Random(6)
    better = 0
    for _ in range(60):
        counts = {}
        for _ in range(200):
            x = rng.randint(20, 60)
            counts[x] = counts.get(x, 0) + 1
        plan, fit = packing.complete(counts, 100, most=5_000), packing.best_fit(counts, 100)
        assert plan.least <= plan.sequences <= fit.sequences
        better += plan.sequences < fit.sequences
    assert better


def test_fillings_are_all_sums_with_the_waste_asked_for():
    left = {9: 1, 7: 1, 5: 2, 3: 1, 2: 2}
    found = [sorted(f.items()) for f in packing.fillings(left, 9, 16, 0, most=50)]
    # 7 | 5 2 | 3 2 2, of which a 7 that is left dominates the others
    assert found == [[(7, 1), (9, 1)]]
    sums = packing.Sums([7, 5, 3, 2], left, 9)
    assert sorted(sums.ways(0, 7)) == [(3, 2, 2), (5, 2), (7,)]
    assert not sums.has(0, 1) and sums.has(0, 9)


def test_bin_completion_is_no_worse_than_best_fit():
    rng = random.Random(5)
    counts = {}
    for _ in range(3000):
        x = min(1024, max(1, int(rng.lognormvariate(5.8, 1))))
        counts[x] = counts.get(x, 0) + 1
    plan, fit = packing.complete(counts, most=20_000), packing.best_fit(counts, 1024)
    assert plan.sequences <= fit.sequences
    assert plan.sequences >= -(-sum(k * n for k, n in counts.items()) // 1024)


def check_packed(rows, texts):
    """Pieces are cut and placed as they should; returns the number of sequences."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    want = []
    for i, t in texts:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(pairwise(cuts)):
            want.append((i is None, i or 0, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(parts))
        assert sum(parts[-1]) <= 1024
    return len(by_sequence)


def test_packing_of_odd_rows(odd, nothing):
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    check_packed(packing.pack(odd, vocabulary("byte_bpe_50k.json")).collect(), texts)
    assert packing.pack(nothing, vocabulary("byte_bpe_50k.json")).count() == 0


@needs_data
def test_packing_of_given_documents(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows = REGISTRY["op5_packing"].run(spark, SF).collect()
    found = check_packed(rows, texts)
    assert found <= 1.01 * sum(r.length for r in rows) / 1024 + 1


# ---- byte-level BPE


def given_library():
    with open(vocabulary("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_perfect():
    entries, _ = byte_bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    some = entries[:5000]
    found = byte_bpe.build_hash(some)
    digests = [byte_bpe.xxhash.xxh3_64_intdigest(e) for e in some]
    assert [found.key(d) for d in digests] == list(range(len(some)))
    assert {found.slot(d) for d in digests} == set(range(len(some)))
    assert byte_bpe.build_hash([b"one"]).key(byte_bpe.xxhash.xxh3_64_intdigest(b"one")) == 0


def test_ids_are_those_of_the_library():
    path = vocabulary("byte_bpe_50k.tiktoken")
    own = byte_bpe.Coder(path, public.PATTERN, byte_bpe.build_hash(byte_bpe.read_ranks(path)[0]), remember=500)
    library = given_library()
    rng = random.Random(6)
    letters = "abcdefgh ABC  \n\n\t\r.,'!s t d é ßñ 09 ² ½ 中文    \x1c\x1f\x85 <|endoftext|> 🙂 ́ ªº µ × ÷ĀſƀȺ'll 've"
    for text in ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["ab" * 20_000]:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_round_trip_of_odd_rows(odd, nothing):
    library = given_library()
    rows = byte_bpe.round_trip(odd, vocabulary("byte_bpe_50k.tiktoken"), public.PATTERN).collect()
    texts = {i if i != 3 else None: t for i, t in enumerate(ODD_TEXTS)}
    assert len(rows) == odd.count()
    for r in rows:
        raw = texts[r.doc_id] or ""
        ids = library.encode_ordinary(raw)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(raw.encode()).hexdigest()
    assert byte_bpe.round_trip(nothing, vocabulary("byte_bpe_50k.tiktoken"), public.PATTERN).count() == 0
