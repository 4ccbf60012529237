"""Operators for training data against brute force, exact round trips and held-out labels."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from credlake.llm import (ann, components, exact_dedup, html_extract, lm_score, packing, quality, sentencepiece_codec, simhash_dedup,
                          suffix_dedup, toxicity)

from .conftest import DOCS, prose

LABELS = "doc_id long, quality int, toxic int"


def lower(b: bytes) -> bytes:
    return b.lower()  # A-Z only, on bytes


# -- exact dedup (10)

def brute_exact(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower((t or "").encode()), []).append(i)
    return sorted((i, keep(g), len(g), i == keep(g), hashlib.sha256(n).hexdigest()) for n, g in groups.items() for i in g)


@pytest.mark.parametrize("digest", [F.md5, lambda c: F.substring(F.md5(c), 1, 1)])  # the second makes collisions
def test_exact_dedup(make_docs, odd_texts, digest):
    docs = make_docs(odd_texts, extra=True)
    got = exact_dedup.exact_dedup(docs, keep="largest", digest=digest).collect()
    assert sorted(map(tuple, got)) == brute_exact(enumerate(odd_texts), max)


def test_exact_dedup_edges(make_docs, spark):
    assert exact_dedup.exact_dedup(make_docs([])).count() == 0
    got = exact_dedup.exact_dedup(make_docs(["a", "A", "a"], [None, 2, 2])).collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in got) == [(-1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, True)]
    kept = exact_dedup.drop_copies(make_docs(["x", "X", "y"], extra=True), keep="largest")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and len(kept.columns) == 26


# -- SimHash (9)

def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", lower((text or "").encode()))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for k, i in enumerate(ids):
        low[find(k)] = min(low.get(find(k), i), i)
    return {i: low[find(k)] for k, i in enumerate(ids)}


def test_simhash(make_docs, odd_texts):
    got = simhash_dedup.simhash_components(make_docs(odd_texts, extra=True)).collect()
    fps = [brute_fingerprint(t) for t in odd_texts]
    want = brute_components(list(range(len(fps))), fps, 4)
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in got} == {i: (fps[i], want[i]) for i in want}


@pytest.mark.parametrize("tile", [64, 4096])
def test_links_lose_none(spark, tile):
    """Clouds of fingerprints around few centres, some of them chained: components as by brute force."""
    rng = random.Random(8)
    fps = set()
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(60):
            fps.add(x)
            y = x
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5, 6])):
                y ^= 1 << b
            fps.add(y)
            x = y if rng.random() < 0.3 else x
    fps |= {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(3)
    links = simhash_dedup.links(df, 4, tile=tile)
    for r in links.collect():
        assert 0 < ((r.a ^ r.b) % 2**64).bit_count() or r.a != r.b
    got = {r.a % 2**64: r.b % 2**64 for r in components.components(links).collect()}
    want = brute_components(fps, fps, 4)
    same = {}
    for f in fps:
        same.setdefault(got.get(f, f), set()).add(f)
    back = {}
    for f in fps:
        back.setdefault(want[f], set()).add(f)
    assert sorted(map(sorted, same.values())) == sorted(map(sorted, back.values()))


def test_anchors_cover():
    """Any two words within 1 bit in a block share an anchor that is home to one of them."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**63, 300, dtype=np.uint64)
    for lo, hi in simhash_dedup._spans(3):
        for bit in range(lo, hi):
            y = x ^ np.uint64(1 << bit)
            ix, ax, hx = simhash_dedup.anchors(x, lo, hi, 2)
            iy, ay, _ = simhash_dedup.anchors(y, lo, hi, 2)
            near = set(zip(iy.tolist(), ay.tolist()))
            assert all((i, a) in near for i, a in zip(ix[hx].tolist(), ax[hx].tolist()))


def test_simhash_empty(make_docs):
    assert simhash_dedup.simhash_components(make_docs([])).count() == 0
    kept = simhash_dedup.drop_near_copies(make_docs(["one two three four five six"] * 3 + ["", None], [9, 4, 7, 2, 3], extra=True))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4]


# -- suffix-array dedup (3)

def brute_suffix(rows, size):
    first, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        keep = [True] * len(b)
        for k in range(len(b) - size + 1):
            if first.setdefault(b[k:k + size], i) < i:
                keep[k:k + size] = [False] * size
        gone = "".join(".x"[not k] for k in keep)
        out[i] = (i, len(b), gone.count("x"), len(re.findall("x+", gone)), hashlib.sha256(bytes(c for c, k in zip(b, keep) if k)).hexdigest())
    return out


def test_suffix_dedup(make_docs, odd_texts):
    rng = random.Random(3)
    shared = [prose(rng, 14) for _ in range(4)]
    texts = odd_texts + [prose(rng, rng.randint(1, 30)) + rng.choice(shared)[rng.randint(0, 20):] + prose(rng, 5) for _ in range(60)]
    texts += ["a" * n for n in (49, 50, 51, 300)] + ["ab" * 100, "ba" * 60, shared[0][:50], shared[0][:49]]
    ids = random.Random(1).sample(range(10_000), len(texts))
    got = suffix_dedup.suffix_digests(make_docs(texts, ids, extra=True)).collect()
    assert {r.doc_id: tuple(r) for r in got} == brute_suffix(zip(ids, texts), 50)


def test_suffix_edges(make_docs):
    assert suffix_dedup.suffix_digests(make_docs([])).count() == 0
    text = prose(random.Random(5), 40)
    got = suffix_dedup.suffix_digests(make_docs([text, text, text, text], [None, 3, 3, 8])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (3, 0), (3, 0), (8, len(text))]
    out = suffix_dedup.strip_repeats(make_docs([text + " ü tail", "head ü " + text], extra=True))
    rows = {r.doc_id: r for r in out.collect()}
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert rows[0].text == text + " ü tail" and rows[1].text == "head ü " and rows[1].n_chars == 7


@pytest.mark.parametrize("n", [40, 55, 90])
def test_suffix_phrase_in_a_third(make_docs, odd_texts, n):
    """A phrase in a third of the documents with other words around it: whole result, and no anchor with a large group."""
    rng = random.Random(n)
    phrase = (prose(rng, 30) * 2)[:n]
    texts = odd_texts + [prose(rng, 12) + (" " + phrase + " " if i % 3 == 0 else " ") + prose(rng, 12) for i in range(400)]
    texts += [texts[30][20:120] + prose(rng, 5), phrase * 3]
    ids = random.Random(2).sample(range(10_000), len(texts))
    docs = make_docs(texts, ids, extra=True)
    got = suffix_dedup.suffix_digests(docs, 50, hot=20).collect()
    assert {r.doc_id: tuple(r) for r in got} == brute_suffix(zip(ids, texts), 50)
    rows = suffix_dedup.id_text(docs).coalesce(1)
    records = suffix_dedup._records(suffix_dedup.Splitters([], 4), 50, 4, 4, suffix_dedup._hot(rows, 50, 20))
    anchors = Counter()
    for r in rows.mapInArrow(records, suffix_dedup.SHAPE).where("kind = 0").collect():
        doc, start, length, place, blob = suffix_dedup.unpack(bytes(r.payload), r.n)
        begin = np.cumsum(length) - length
        anchors.update(blob[b:b + suffix_dedup.ANCHOR].tobytes() for b in begin + place)
    assert max(anchors.values()) <= 20


def test_windows_that_share_a_hash_only(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "range_hashes", lambda buf, s, e: np.zeros(len(s), np.uint64))
    a, b = b"x" * 50, b"y" * 50
    blob = np.frombuffer(a + b + a, np.uint8)
    rec, window = suffix_dedup.repeated_windows(np.array([1, 2, 3]), np.array([50, 50, 50]), blob, 50)
    assert rec.tolist() == [2] and window.tolist() == [0]


# -- language-model scoring (4)

def brute_lm(texts, order, least, backoff):
    docs = [re.findall(r"[^ \t-\r]+", t or "") for t in texts]
    c = Counter(tuple(d[i:i + n]) for d in docs for n in range(1, order + 1) for i in range(len(d) - n + 1))
    total = sum(map(len, docs))

    def s(h, w):
        if not h:
            return math.log(c[(w,)] / total)
        return math.log(c[(*h, w)] / c[h]) if c[(*h, w)] >= least else math.log(backoff) + s(h[1:], w)

    return [(len(d), sum(s(tuple(d[max(0, i - order + 1):i]), w) for i, w in enumerate(d))) for d in docs]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(make_docs, odd_texts, order):
    got = {r.doc_id: r for r in lm_score.lm_scores(make_docs(odd_texts, extra=True), order=order).collect()}
    for i, (n, s) in enumerate(brute_lm(odd_texts, order, 2, 0.4)):
        assert got[i].n_words == n and got[i].log_score == pytest.approx(s, rel=1e-9, abs=1e-9)
        assert (got[i].mean_log_score is None) == (n == 0)


@pytest.mark.parametrize("order, group_bytes", [(3, 1 << 25), (3, 400), (4, 3000)])
def test_lm_counts_all(make_docs, odd_texts, order, group_bytes):
    """No count is cut, whatever the groups; null and repeated ids too."""
    texts = odd_texts + ["a b c d", "a b c e", "b c d", "x a b c d"] * 3
    ids = [None if i % 5 == 0 else i // 3 for i in range(len(texts))]
    got = Counter((r.doc_id, r.n_words, round(r.log_score, 6)) for r in lm_score.lm_scores(
        make_docs(texts, ids, extra=True), order=order, least=1, group_bytes=group_bytes).collect())
    assert got == Counter((i, n, round(s, 6)) for i, (n, s) in zip(ids, brute_lm(texts, order, 1, 0.4)))


def test_lm_empty(make_docs):
    assert lm_score.lm_scores(make_docs([])).count() == 0


# -- SentencePiece (5)

def test_sentencepiece_is_the_library(make_docs, odd_texts):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = make_docs(odd_texts, extra=True)
    ids = {i: sp.encode(t or "") for i, t in enumerate(odd_texts)}
    encoded = sentencepiece_codec.encode_documents(docs, path)
    assert {r.doc_id: r.ids for r in encoded.collect()} == ids
    assert {r.doc_id: r.text for r in sentencepiece_codec.decode_documents(encoded, path).collect()} == {i: sp.decode(x) for i, x in ids.items()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentencepiece_codec.digests(docs, path).collect()} == {
        i: (len(x), sha(",".join(map(str, x))), sha(sp.decode(x))) for i, x in ids.items()}


def test_decoded_digest_is_of_the_decoded_ids(monkeypatch):
    c = sentencepiece_codec.codec(public_tokenizers.path("piece_bpe_32k.model"))
    text = "some words, and 日本 too"
    assert c.digest(text)[2] == hashlib.sha256(c.decode(c.encode(text)).encode()).hexdigest()
    monkeypatch.setattr(sentencepiece_codec.Codec, "decode", lambda self, ids: f"a fault in {len(ids)} ids")
    assert c.digest(text)[2] == hashlib.sha256(f"a fault in {len(c.encode(text))} ids".encode()).hexdigest()


def test_backtracking_equals_merging():
    c = sentencepiece_codec.codec(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    for _ in range(3000):
        s = "".join(rng.choices("abcdehinorst▁", k=rng.randint(1, 24))).strip("▁")
        if s and "▁" not in s:
            assert [c.pieces[i] for i in c._backtrack(s)] == c.merge(s) == [c.pieces[i] for i in c._known(s)]


# -- packing (7)

def test_packing(make_docs, odd_texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rng = random.Random(7)
    texts = odd_texts + [prose(rng, rng.randint(1, 900)) for _ in range(150)] + ["<|endoftext|> is text"]
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in enumerate(texts)}
    rows = packing.pack(make_docs(texts, extra=True), path).collect()
    at = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at.get(r.doc_id, 0) and r.doc_tokens == len(ids[r.doc_id])
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32 and len(part) == r.length
        at[r.doc_id] = r.start + r.length
    assert at == {i: len(x) for i, x in ids.items()}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    assert padding <= 0.02 * sum(map(len, ids.values())) + 1024


def test_packing_ids_are_the_library_s(make_docs, odd_texts):
    """Special tokens written out in a text too: the tokenizer as its file makes it."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = odd_texts + ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  z", "<|endoftext|><|endoftext|> two", "<|endoftext |> not one"]
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in enumerate(texts)}
    assert 50256 in ids[len(odd_texts)]
    got = packing.pieces(make_docs(texts, extra=True), path).collect()
    assert sorted(map(tuple, got)) == sorted(
        (i, a, len(x[a:a + 1024]), zlib.crc32(np.array(x[a:a + 1024], "<u4").tobytes()), len(x)) for i, x in ids.items() for a in range(0, len(x), 1024))


def test_packing_groups_do_not_grow_with_texts(make_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(11)
    docs = make_docs([prose(rng, 2000 + i) for i in range(12)] + ["one two"], [*range(10), 3, None, 3])  # ids repeat
    sizes = packing.grouped(docs, path, window=16, group=100).groupBy("grp").count().collect()
    assert max(r["count"] for r in sizes) <= 100 < sum(r["count"] for r in sizes if r.grp < 0)
    rows = packing.pack(docs, path, window=16, group=100).collect()
    key = lambda r: (r.doc_id or -1, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, rows)) == sorted(map(key, packing.pieces(docs, path, 16).collect()))
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 16


def test_closest_fill_is_best():
    rng = random.Random(9)
    for _ in range(300):
        counts = Counter(rng.randint(1, 40) for _ in range(rng.randint(0, 7)))
        room, filled = rng.randint(0, 60), 0
        sums = {0}
        for n, k in counts.items():
            sums |= {s + n * j for s in sums for j in range(k + 1)}
        chosen = packing.closest_fill(dict(counts), room, filled, room)
        used = Counter()
        for n, k in chosen:
            used[n] += k
        assert all(used[n] <= counts[n] for n in used)
        best = max(s for s in sums if s <= room)
        made = sum(n * k for n, k in used.items())
        assert made == best or made & (made - 1) == 0


def test_packing_empty(make_docs):
    assert packing.pack(make_docs([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# -- HTML (2)

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body><header>Site name</header>
<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav><div class="ad">Buy it, now.</div>
<ARTICLE><h1>A &amp; B</h1><p><b>First   part, with
 marks.<br><p>Second &lt;part&gt;; it is longer, and it goes on.<ul><li>item one<li>item two</ul>
<div class="comments"><p>I do not agree, not at all. Never!</p></div></ARTICLE><aside>Read also, please.</aside><form>Mail <input></form>
<footer>&copy; all rights, always."""


def test_html(spark):
    assert html_extract.extract(PAGE) == "A & B\nFirst part, with marks.\nSecond <part>; it is longer, and it goes on.\nitem one\nitem two"
    plain = PAGE.replace("ARTICLE", "div").replace("</div></div>", "</div></div>")
    assert html_extract.extract(plain).startswith("A & B\nFirst part")
    rows = [(0, "u", PAGE, "x"), (1, None, None, "x"), (2, "v", "", "x"), (3, "w", "<p", "x"), (4, "w", "just text &am", "x"), (0, "u", PAGE, "x")]
    got = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")).collect()
    assert len(got) == 6 and [r.text for r in got if r.page_id in (1, 2, 3)] == ["", "", ""]
    assert all(r.n_chars == len(r.text) for r in got) and [r.text for r in got if r.page_id == 4] == ["just text &am"]


def sentences(seed, n):
    return " ".join(prose(random.Random(seed * 100 + i), 9) + ", and more." for i in range(n))


@pytest.mark.parametrize("shares", [(6, 4), (7, 3), (5, 5, 5), (12, 7, 5), (4, 9)])
@pytest.mark.parametrize("tag", ["section", "div"])
def test_html_parts_side_by_side(tag, shares):
    """All parts of an article without article or main come, their headings too."""
    parts = [(f"Heading {k}", sentences(k, n)) for k, n in enumerate(shares)]
    body = "".join(f"<{tag} class=part{k}><h2>{h}</h2><p>{p}</p></{tag}>" for k, (h, p) in enumerate(parts))
    want = "\n".join(x for part in parts for x in part)
    assert html_extract.extract(f"<body><nav>One Two</nav>{body}<footer>All rights.</footer></body>") == want
    assert html_extract.extract(f"<body><div id=wrap>{body}</div></body>") == want


def test_html_reviewed_split():
    a, b = sentences(1, 6), sentences(2, 4)
    assert html_extract.extract(f"<div class=lead><p>{a}</p></div><div class=rest><p>{b}</p></div>") == a + "\n" + b


@pytest.mark.parametrize("start, end", [
    ("<body class='single no-sidebar'>", "</body>"), ("<body class='widget'><article class='post comments-open category-promo'>", "</article></body>"),
    ("<body><div id='content-with-sidebar'>", "</div></body>"), ("<body><div class=widget><main class=search>", "</main></div></body>"),
    ("<body><div class='social'><article class=legal>", "</article></div></body>"), ("<div class=notice>", "</div>")])
def test_html_names_of_the_article(start, end):
    """A word of the boilerplate list in a name around the article costs no text; the boilerplate beside it still goes."""
    a, b, ad, said = sentences(3, 5), sentences(4, 5), sentences(5, 2), sentences(6, 20)
    rest = f"<div class=ad><p>{ad}</p></div><div id=cookie-banner>{ad}</div><div class='site-footer x'>{ad}</div><div id=comments class=comments-area><p>{said}</p></div>"
    assert html_extract.extract(f"{start}<h1>T</h1><p>{a}</p><p>{b}</p>{rest}{end}").removeprefix("T\n") == a + "\n" + b


def test_html_drawings_and_formulas():
    a, b = sentences(7, 5), sentences(8, 5)
    for icon in ("<svg class=i viewBox='0 0 1 1'/>", "<svg/>", "<svg><path d=1 /><title>no</title></svg>", "<svg><!-- <p> --><foreignObject><div>no</div></foreignObject></svg>",
                 "<svg><path d=1>"):
        want = a + "\n" + b
        assert html_extract.extract(f"<article><p>{a}{icon}</p><p>{b}</p></article>") == want
        assert html_extract.extract(f"<article><p>{a}{icon}</p><p>{b}</p></article><footer><svg></svg></footer>") == want
    tex = "<annotation encoding='application/x-tex'>no</annotation>"
    assert html_extract.extract(f"<article><p>{a} <math><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow>{tex}</math>, {b}</p></article>") == f"{a} x=1 , {b}"
    assert html_extract.extract(f"<article><p>{a} <math/>{b}</p></article>") == f"{a} {b}"


def test_html_long_page():
    page = "<body><div id=main>" + "<p>Some words, and a stop." * 20_000
    assert html_extract.extract(page).count("\n") == 19_999


# -- nearest neighbours (6)

def test_ann(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[200:260] = x[100]  # a crowd of equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(2000, None), (2001, [0.0] * 16), (2050, [float("nan")] * 16), (2100, [1.0, None] * 8), (2150, [float("inf")] * 16), (2200, [1.0] * 3), (None, x[0].tolist())]
    df = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id long, embedding array<float>, score string")
    got = ann.search(df, df.where("vec_id % 50 = 0"), k=16, visit=0.5).collect()
    u = x.astype(float)
    norm = np.sqrt((u * u).sum(axis=1))
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == list(range(0, 1500, 50))
    hit = 0
    for q, found in by.items():
        found.sort(key=lambda r: r.rank)
        score = (u * u[q]).sum(axis=1) / (norm * norm[q])
        score[q] = -9
        best = np.lexsort((np.arange(1500), -score))[:5]
        assert [r.rank for r in found] == [1, 2, 3, 4, 5] and all(r.score == score[r.vec_id] for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        hit += len({r.vec_id for r in found} & set(best.tolist()))
        if q in (100, 200, 250):
            assert {r.vec_id for r in found} == set(best.tolist())
    assert hit / (5 * len(by)) >= 0.9


def test_ann_few(spark):
    shape = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], shape), spark.createDataFrame([], shape)).count() == 0
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], shape)
    got = ann.search(df, df.where("vec_id = 0")).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1), (2, 2)]


# -- classifiers (1, 8)

def labelled(spark, make_docs, bad, n=700):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.3)
        texts.append(bad(rng) if y else "\n".join(prose(rng, rng.randint(5, 30)) + "." for _ in range(rng.randint(1, 5))))
        labels.append((i, 1 - y, y))
    rows = [*labels, (None, 1, 1), (5, None, None), (99_999, 1, 1)]
    return make_docs(texts), spark.createDataFrame(rows, LABELS), {i: t for i, _, t in labels}


def accuracy(rows, y, threshold):
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    return sum((r.score >= threshold) == (y[r.doc_id] == 1) for r in held) / len(held)


def test_toxicity(spark, make_docs, odd_texts):
    def bad(rng):
        words = prose(rng, rng.randint(20, 80)).split()
        for _ in range(3):
            words.insert(rng.randrange(len(words)), rng.choice(["Grumf", "zonk###", "BLARG!!"]))
        return " ".join(words)

    docs, labels, y = labelled(spark, make_docs, bad)
    model = toxicity.fit(docs, labels)
    assert accuracy(toxicity.toxicity_scores(docs, model).collect(), y, 0.5) >= 0.95
    odd = make_docs(odd_texts + ["grumf zonk blarg"], extra=True)
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(odd, model).collect()}
    assert len(got) == len(odd_texts) + 1 and all(0 <= s <= 1 for s in got.values()) and got[0] == got[1]
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, s in got.items() if s < 0.5) == list(range(len(odd_texts)))
    nothing = toxicity.fit(docs, spark.createDataFrame([], LABELS))
    assert toxicity.drop_toxic(docs, nothing).count() == docs.count()


def test_labels_held_out_are_not_learned(spark, make_docs):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = make_docs(["some words"] * len(held), held)
    labels = spark.createDataFrame([(i, 1, 1) for i in held], LABELS)
    assert toxicity.labelled_sample(docs, labels, "toxic", 1000).count() == 0


def test_quality(spark, make_docs, odd_texts):
    def bad(rng):
        kind = rng.randrange(3)
        if kind == 0:
            return " ".join(w for w in prose(rng, 12).split() for _ in range(9))
        if kind == 1:
            return "\n".join(" | ".join(prose(rng, 10).split()) for _ in range(4))
        return "\n".join(" ".join(w + "###" for w in prose(rng, 20).split()) for _ in range(4))

    docs, labels, y = labelled(spark, make_docs, bad)
    model = quality.fit(docs, labels)
    good = {i: 1 - t for i, t in y.items()}
    assert accuracy(quality.quality_scores(docs, model).collect(), good, 0.3) >= 0.95
    got = quality.quality_scores(make_docs(odd_texts, extra=True), model).collect()
    assert len(got) == len(odd_texts) and all(0 <= r.score <= 1 for r in got)
    none = quality.fit(docs, spark.createDataFrame([], LABELS))
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert quality.quality_scores(make_docs([]), model).count() == 0


def test_marginals_by_enumeration():
    from itertools import product

    rng = np.random.default_rng(3)
    s, a = rng.normal(size=5).tolist(), rng.normal(size=4).tolist()
    weight = {}
    for ys in product((0, 1), repeat=5):
        v = sum(x for x, y in zip(s, ys) if y) + sum(a[2 * p + q] for p, q in zip(ys, ys[1:]))
        weight[ys] = math.exp(v)
    z = sum(weight.values())
    good, logz, c = quality.marginals(s, a)
    assert logz == pytest.approx(math.log(z))
    for i in range(5):
        assert good[i] == pytest.approx(sum(w for ys, w in weight.items() if ys[i]) / z)
    for k in range(4):
        assert c[k] == pytest.approx(sum(w * sum(2 * p + q == k for p, q in zip(ys, ys[1:])) for ys, w in weight.items()) / z)


# -- pipeline

def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    passage = prose(rng, 30)
    texts = [prose(rng, rng.randint(20, 120)) for _ in range(260)]
    toxic = {i for i in range(0, 260, 4)}
    texts = [t + " grumf zonk blarg" * 2 if i in toxic else t for i, t in enumerate(texts)]
    texts[1] = texts[2].upper()                       # equal after lower-casing
    texts[5] = texts[6] + " more"                     # perhaps a near copy
    texts[9], texts[10] = texts[9] + passage, texts[10] + " " + passage
    texts += [None, ""]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(260)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
        if k < 4:
            assert docs.columns == before.columns
    assert not left[0] & toxic and left[0] == set(range(262)) - toxic  # clean ones stay
    small = {i: t for i, t in enumerate(texts) if i in left[0]}
    assert left[1] == {i for i, *_ in (r for r in brute_exact(small.items(), max) if r[3])}
    after = sorted(left[1])
    comp = brute_components(after, [brute_fingerprint(texts[i]) for i in after], 4)
    assert left[2] == set(comp.values()) and left[3] == left[2] == left[4]
    stripped = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "suffix_dedup")).collect()}
    assert passage in stripped[9] and passage not in stripped[10]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
