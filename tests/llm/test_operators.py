"""Dealt operators against brute-force versions on small, awkward tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from ordermill.llm import (html_main, maxscore, minhash, packing, pii, piece_scan, quality, sharding,
                           simhash_dedup, suffix_dedup)
from ordermill.llm.components import components
from ordermill.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key int, block int, fp string, x_0 string"
SAME = "the quick brown fox jumps over the lazy dog and then runs back home again before the night falls on us all"
RAW = [
    (1, SAME + " one"), (2, "two " + SAME), (3, SAME + " one"), (4, None), (5, ""), (6, "  \n "),
    (7, "short"), (8, "a b"), (9, "é" * 70 + SAME[:60]), (10, "ü" + "é" * 70), (11, SAME + " one"),
    (12, "x" * 30_000), (13, "mail a.b@c.org now or +1 (212) 555-1234, 10.0.0.1 4111 1111 1111 1111"),
    (13, "repeated id"), (None, "no id " + SAME), (None, None), (14, SAME.replace("fox", "cat") + " one"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, 3, "f", "c") for i, t in RAW], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_repeats(docs, none):
    got = sorted(map(tuple, suffix_dedup.remove_repeats(docs).collect()), key=str)
    rows = [(np.inf if i is None else i, (t or "").encode(), i) for i, t in RAW]
    first = {}
    for i, b, _ in sorted(rows, key=lambda r: r[0]):
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    want = []
    for i, b, own in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(c for c, g in zip(b, gone) if not g)
        want.append((own, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want, key=str)
    assert suffix_dedup.remove_repeats(none).count() == 0
    kept = suffix_dedup.remove_repeats(docs, with_kept=True, extra=("lang", "key")).where("doc_id = 3").first()
    assert (bytes(kept["kept"]), kept["lang"], kept["key"]) == (b"", "en", 2)


def test_family_keeps_levels_apart():
    family = suffix_dedup.Family()
    for i in range(7):
        code = np.arange(i, i + 4, dtype=np.uint64)
        family.add(code, code, np.full(4, i))
    assert [lv[0] for lv in family.levels] == [4, 2, 1]
    code = np.array([0, 5, 99], np.uint64)
    assert family.scan(code, code, np.array([1, 3, 9])).tolist() == [True, True, False]


def _simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    import xxhash
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    codes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(c >> j & 1 for c in codes) > len(codes))


def test_simhash(docs, none):
    got = sorted(map(tuple, simhash_dedup.near_copies(docs).collect()), key=str)
    prints = [_simhash(t) for _, t in RAW]
    root = list(range(len(RAW)))
    for i in range(len(RAW)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root = [root[j] if r == root[i] else r for r in root]
    low = {r: min((RAW[i][0] for i in range(len(RAW)) if root[i] == r and RAW[i][0] is not None), default=None)
           for r in root}
    want = [(RAW[i][0], f"{prints[i]:016x}", low[root[i]]) for i in range(len(RAW))]
    assert got == sorted(want, key=str)
    assert simhash_dedup.near_copies(none).count() == 0


def test_bit_sliced_distances_and_crowded_keys(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 5000, dtype=np.uint64) & rng.integers(0, 2**63, 5000, dtype=np.uint64)
    x[:900] &= rng.integers(0, 2**63, 900, dtype=np.uint64) & rng.integers(0, 2**63, 900, dtype=np.uint64)
    x[900:1200] = np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)
    for radius in range(4):
        want = np.array([int(v).bit_count() <= radius for v in x])
        assert (simhash_dedup.within(x, radius) == want).all()
    base = rng.integers(-2**62, 2**62, 12)
    fps = sorted({int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i in range(0, 60, 7) for j in range(0, 60, 11)})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    monkeypatch.setattr(simhash_dedup, "SUB_BLOCK", 8)
    roots = dict(map(tuple, components(simhash_dedup.links(frame)).collect()))
    name = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 3:
                name = [name[j] if r == name[i] else r for r in name]
    for i, f in enumerate(fps):
        members = [fps[j] for j in range(len(fps)) if name[j] == name[i]]
        assert roots.get(f, f) == min(members)


def test_shards(docs, none):
    rows = sharding.balanced_shards(docs, shards=3).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in RAW)
    for s in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert ids == sorted(ids)
    assert sharding.balanced_shards(none).count() == 0


def test_fingerprints(docs, none):
    rows = {(r["doc_id"], r["n_chars"]): r for r in minhash.fingerprint_edits(docs).collect()}
    assert len(rows) == len(RAW)
    texts = [t or "" for i, t in sorted(RAW[:12], key=lambda r: -(r[0] or 0))]
    a, b = texts[0], texts[1]                      # ids 12 and 11
    edited = a[: len(a) - len(a) // 3] + b[: len(a) // 3]
    assert rows[(12, 30_000)]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert rows[(1, 110)]["fingerprint"] == rows[(3, 110)]["fingerprint"] != rows[(7, 5)]["fingerprint"]
    assert rows[(5, 0)]["fingerprint"] == rows[(6, 4)]["fingerprint"] == ""
    assert rows[(5, 0)]["near_next"] == rows[(6, 4)]["near_next"] == 1.0      # 5 is followed by 4, 6 by 5
    assert minhash.fingerprint_edits(none).count() == 0


def test_minhash_estimates():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 3000)]
    for cut in (300, 1500, 2700):
        other = words[:cut] + [f"v{i}" for i in range(3000 - cut)]
        s, some = minhash.sketch([" ".join(words), " ".join(other)])
        a, b = ({tuple(w[i:i + 5]) for i in range(2996)} for w in (words, other))
        got = minhash.likeness(s[:1], some[:1], s[1:], some[1:])[0]
        assert abs(got - len(a & b) / len(a | b)) < 0.1
    assert (minhash.sketch([SAME])[0] == minhash.sketch(["zz", SAME])[0][1]).all()


def test_packing(docs, none):
    path = tokenizer_file(packing.TOKENIZER)
    tokenizer = packing.Words.of(path).tokenizer
    rows = packing.pack(docs, path, window=64, keep_ids=True).collect()
    for i, t in {(i, t) for i, t in RAW}:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        mine = sorted((r for r in rows if r["doc_id"] == i and r["doc_tokens"] == len(ids)
                       and np.frombuffer(r["ids"], "<u2").tolist() == ids[r["start"]:r["start"] + r["length"]]),
                      key=lambda r: r["start"])
        assert sum(r["length"] for r in mine) % len(ids) == 0 and mine
        assert all(r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
                   for r in mine)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(sum(x for _, x in p) < 64 for p in by.values()) <= 1
    assert packing.pack(none, path).count() == 0


def test_words_as_the_tokenizer():
    w = packing.Words.of(tokenizer_file(packing.TOKENIZER))
    texts = ["it's They'RE a.b, c_. é, x́, 5%%% 'S !!! don't.' ΑΣ. Σ İI <|endoftext|>. a\x0bb\x1cc　d é!! Å.",
             "", " ", "\n\n", SAME, "Licensed (MIT)... 3.14, A-Z\r\n\tq"]
    for t, ids in zip(texts, w.ids(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == w.tokenizer.encode(t, add_special_tokens=False).ids


def test_pieces(docs, none):
    path = tokenizer_file(piece_scan.MODEL)
    vocab = piece_scan.Vocabulary.of(path)
    whole, cut = piece_scan.encode(docs, path).collect(), piece_scan.encode(docs, path, chunk=50).collect()
    for rows in (whole, cut):
        assert all(r["round_trip"] for r in rows)
        for i, t in {(i, t) for i, t in RAW}:
            parts = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["chunk"])
            text = vocab.decode(b"".join(bytes(r["ids"]) for r in parts)) if i not in (13, None) else None
            assert text is None or text == " " + (t or "")
    best, back = vocab.forward(" " + SAME, {0: 0})
    assert vocab.trace(" " + SAME, back, len(SAME) + 1) == vocab.encode(" " + SAME)
    assert piece_scan.encode(none, path).count() == 0


def test_max_plus_is_associative_and_finds_the_best():
    vocab = piece_scan.Vocabulary.of(tokenizer_file(piece_scan.MODEL))
    text = " " + "internationalization" * 9
    size, over = 13, vocab.longest
    chunks = [(text[i:i + size + over], min(size, len(text) - i)) for i in range(0, len(text), size)]
    m = [vocab.matrix(t, n) for t, n in chunks]
    left = right = m[0]
    for x in m[1:]:
        left = piece_scan.combine(left, x)
    right = m[-1]
    for x in m[-2::-1]:
        right = piece_scan.combine(x, right)
    assert left[0, 0] == right[0, 0] == vocab.forward(text, {0: 0})[0][-1]


def _spans(text):
    def luhn(d):
        return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
                   for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m[0])]


def test_private(spark, docs, none):
    texts = [t for _, t in RAW] + ["a@b.c_d@e.f g@h", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1", "é😀 x@y.zz 😀 +1 (212) 555-1234é",
                                   "4111 1111 1111 1111, 4111-1111-1111-1112 12 34 5", "+1 1.2.3.4 " + "1 " * 3000, "9" * 5000]
    frame = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = pii.detect(frame)
    for r in rows.withColumn("red", pii.redacted()).collect():
        want = _spans(texts[r["doc_id"]] or "")
        assert [tuple(x) for x in r["base"]] == want
        assert set(want) <= {tuple(x) for x in r["spans"]}
        for kind, s, e in want:
            assert (texts[r["doc_id"]][s:e] not in r["red"]) or e - s < 3
    assert pii.detect(none).count() == 0


def test_trees_learn_and_calibrate():
    cells = [((d, 0, 1, 0, 0, 0, int(d > 3), 1), fold, 100.0, 99.0 if d > 3 else 1.0) for d in range(7) for fold in (0, 1)]
    trees = pii.Trees(cells)
    assert trees.threshold is not None
    assert [trees.score((d, 0, 1, 0, 0, 0, int(d > 3), 1)) >= trees.threshold for d in range(7)] == [d > 3 for d in range(7)]
    assert pii.Trees([c[:3] + (c[2],) for c in cells]).threshold is None


def test_quality(spark, none):
    good, bad = "alpha beta gamma delta epsilon zeta", "awful"
    rows = [(i, f"{good} word{i} {bad if i % 4 == 0 else ''} more text here {i}") for i in range(400)]
    rows += [(400 + i, " ".join(f"BUY{i * j}!! NOW{j}!!" for j in range(9))) for i in range(100)]
    docs = spark.createDataFrame([(i, t, "src") for i, t in rows] + [(900, None, "s"), (901, "", "s")],
                                 "doc_id long, text string, keep string")
    rated = spark.createDataFrame([(i, 0 if i >= 400 else 1 if i % 4 == 0 else 2) for i, _ in rows if i % 3],
                                  "doc_id long, grade int")
    out = {r["doc_id"]: r for r in quality.rate(docs, rated).collect()}
    held = [i for i, _ in rows if i % 3 == 0]
    right = [out[i]["keep"] == (i < 400 and i % 4 != 0) for i in held]
    assert np.mean(right) > 0.97
    assert out[900]["expected_grade"] == out[901]["expected_grade"]
    flat = quality.rate(docs, rated.where("grade = 2")).collect()
    assert len(flat) == len(rows) + 2 and all(r["keep"] for r in flat)
    assert quality.rate(none, rated).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vecs = [(int(i), [float(x) for x in rng.normal(size=24)]) for i in range(150)]
    vecs += [(200 + i, vecs[3][1]) for i in range(40)] + [(300, None), (301, [1.0, None]), (302, [float("nan")] * 24),
                                                         (303, [1.0]), (None, [1.0] * 24)]
    frame = spark.createDataFrame(vecs, "vec_id long, embedding array<float>")
    v = maxscore.quantized(frame)
    got = maxscore.top_k(v, v.where("vec_id % 20 = 0"), 20).collect()
    plain = {r["vec_id"]: np.array(list(r["v"]) + [0] * (24 - len(r["v"]))) for r in v.collect() if r["vec_id"] is not None}
    for q in [i for i in plain if i % 20 == 0]:
        want = sorted(((-int(plain[q] @ plain[c]), c) for c in plain if c != q))[:20]
        assert [(r["score"], r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] \
            == [(-s, c) for s, c in want]
    assert maxscore.top_k(v.limit(0), v.limit(0)).count() == 0


def test_main_text(spark):
    site = [(i, f"http://a.com/{i}", f"<html><body><div class=x>Welcome to our site<ul><li>one<li>two</ul></div><div class=c>"
             f"<p>Unique {i} text&nbsp;&amp; more<p>para {i * 7}</div><div class=z>Follow us</div><!-- c -->"
             f"<script>x('<p>')</script><div id='comments'><p>nice {i}</p></div></body>") for i in range(10)]
    site += [(20, None, None), (21, "http://b.com", '<p>a<br>b <b>c</b>d<p>e &lt;x&gt; <a href="q>r">l</a>'),
             (22, "x", "<article><header><h1>T</h1></header><p>one</p><aside>no</aside><div class='share-bar'>no</div><p>two"),
             (22, "x", ""), (23, "x", "<p>" * 2000 + "deep")]
    frame = spark.createDataFrame([(*r, "q") for r in site], "page_id long, url string, html string, host string")
    got = {(r["page_id"], r["text"]) for r in html_main.main_text(frame).collect()}
    assert got == {(i, f"Unique {i} text & more para {i * 7}") for i in range(10)} | {
        (20, ""), (21, "a b cd e <x> l"), (22, "T one two"), (22, ""), (23, "deep")}
    assert html_main.main_text(frame.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(6)
    for size in (1e6, 3e6):                     # products past 2**53, and bounds past 2**63
        vecs = [(i, [float(x) for x in rng.normal(size=200) * size]) for i in range(60)]
        v = maxscore.quantized(spark.createDataFrame(vecs, "vec_id long, embedding array<double>"))
        got = maxscore.top_k(v, v.where("vec_id % 20 = 0"), 5).collect()
        plain = {r["vec_id"]: list(r["v"]) for r in v.collect()}
        for q in (0, 20, 40):
            want = sorted((-sum(a * b for a, b in zip(plain[q], plain[c])), c) for c in plain if c != q)[:5]
            mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
            assert [(r["score"], r["vec_id"]) for r in mine] == [(-s, c) for s, c in want]


def test_features_of_the_whole_word():
    start = "".join(chr(97 + i * i % 23) for i in range(1000))
    a, b = start + "toxic", start + "plain"
    feats = quality.Features()
    for word in (a, b, a[:200], a[:201], a[:400], a[:203]):
        want = {quality.bucket(n) for n in quality.word_names(word)}
        assert set(feats[word]) == want
    assert set(feats[a]) - {quality.bucket(a)} != set(feats[b]) - {quality.bucket(b)}
    assert all(len(w) <= quality.CACHE_CHARS for w in feats)


def test_main_text_by_importance(spark):
    def page(i):
        return (f"<html><body><nav><a>Home</a></nav><article class='post'><header><h1>Title {i}"
                f"</h1></header><p class=lead>Subscribe to us<p>body {i * 31}<p>All rights kept<h2 class=k>Read on</h2>"
                f"<p><span class=ad>buy</span></article></body></html>")
    rows = [(i, f"http://a.com/{i}", page(i)) for i in range(12)]
    rows += [(100 + i, f"http://b.com/{i}", f"<main>Teaser of the day</main><div class='content'><p>real {i} text"
              f"<p>more {i * 3}</div><div id=story>story {i}</div>") for i in range(12)]
    rows += [(200, "http://c.com", "<article>see also</article><div>the long and only real text of this page</div>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_main.main_text(frame).collect()}
    assert got == {**{i: f"Title {i} body {i * 31}" for i in range(12)},
                   **{100 + i: f"real {i} text more {i * 3} story {i}" for i in range(12)},
                   200: "see also the long and only real text of this page"}


def test_main_text_with_compound_names(spark):
    def page(i):
        return (f"<html><body><nav><a>Home</a></nav><article class='post comments-open'><header class='entry-header'><h1>Title {i}"
                f"</h1></header><p class=lead>Subscribe to us<p>body {i * 31}<p>All rights kept<h2 class=k>Read on</h2>"
                f"<p><span class=ad>buy</span></article></body></html>")
    rows = [(i, f"http://a.com/{i}", page(i)) for i in range(12)]
    rows += [(100 + i, f"http://b.com/{i}", f"<main>Teaser of the day</main><div class='content with-sidebar'><p>real {i} text"
              f"<p>more {i * 3}</div><div id=page-header-wrap>story {i}</div>") for i in range(12)]
    rows += [(200, "http://c.com", "<article>see also</article><div>the long and only real text of this page</div>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_main.main_text(frame).collect()}
    assert got == {**{i: f"Title {i} body {i * 31}" for i in range(12)},
                   **{100 + i: f"real {i} text more {i * 3} story {i}" for i in range(12)},
                   200: "see also the long and only real text of this page"}


def test_seed_asks_by_all_its_terms():
    rare = list(range(100, 140))                # as rare as each other, so sixteen of them are not all
    docs = [rare, rare[:17] + [7], rare[17:] + [8], [9]]
    ids = [np.array(d + [packing.END_ID], "<u2").tobytes() for d in docs]
    index = packing.Index(ids)
    assert index.neighbours(ids[0], np.array([False, True, True, True])).tolist() == [2, 1]
    assert index.neighbours(ids[3], np.array([True, True, True, False])).tolist() == []
