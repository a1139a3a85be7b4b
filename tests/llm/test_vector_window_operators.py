"""Vector codes, whitening and contamination against brute force on awkward tables."""

import hashlib
import random
import re

import numpy as np
import pytest

from ordermill.llm import active_lloyd, contamination, vectors, whitening

VEC = "vec_id long, embedding array<double>, label int, x string, own int, part int, n int, code string, error long"
NAN, INF = float("nan"), float("inf")


def _table(spark, seed=1, n=400, dims=8, spread=0.4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, spread, (n, dims)), 2)
    x[n // 3: n // 2] = x[0]                                  # a hot vector
    rows = [(int(i), v.tolist(), int(i) % 3 if i % 7 else None) for i, v in enumerate(x)]
    rows += [(5, x[5].tolist(), 2), (5, x[9].tolist(), 2), (None, x[1].tolist(), None), (900, None, 1),
             (901, [1.0, None] + [0.0] * (dims - 2), 1), (902, [NAN] * dims, 1), (903, [INF] + [0.0] * (dims - 1), 1),
             (904, [-0.0] * dims, 1), (905, [0.25], 1), (906, [], 1)]
    return spark.createDataFrame([(*r, "c", 1, 2, 3, "d", 4) for r in rows], VEC), rows


def _kept(rows, scale):
    dims = max(len(v) for _, v, _ in rows if v)
    out = []
    for i, v, label in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            out.append((i, np.floor(np.array(v + [0.0] * (dims - len(v))) * scale).astype(int), label))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))


def _lloyd(kept, parts, entries, rounds):
    x = np.array([v for _, v, _ in kept])
    width = -(-x.shape[1] // parts)
    x = np.pad(x, ((0, 0), (0, width * parts - x.shape[1])))
    codes, error, books = [], np.zeros(len(x), int), []
    for p in range(parts):
        y = x[:, p * width: (p + 1) * width]
        book = y[:entries].copy()
        for k in range(rounds + 1):
            d = ((y[:, None] - book[None]) ** 2).sum(axis=2)
            own = d.argmin(axis=1)
            if k < rounds:
                for e in range(len(book)):
                    if (own == e).any():
                        book[e] = y[own == e].sum(axis=0) // (own == e).sum()
        codes.append(own)
        error += d.min(axis=1)
        books.append(book)
    return ["".join(f"{c[i]:02x}" for c in codes) for i in range(len(x))], error, np.array(books)


@pytest.mark.parametrize("entries,rounds", [(256, 4), (16, 6), (1, 2)])
def test_vector_codes(spark, entries, rounds):
    frame, rows = _table(spark)
    coded, books = active_lloyd.compress(frame, entries=entries, rounds=rounds)
    kept = _kept(rows, 1024)
    codes, error, want = _lloyd(kept, 4, entries, rounds)
    assert (books == want).all()
    sums = {}
    for (_, _, label), e in zip(kept, error):
        sums[label] = sums.get(label, 0) + int(e)
    want_rows = [(i, label, c, int(e), sums[label]) for (i, _, label), c, e in zip(kept, codes, error)]
    got = [(r["vec_id"], r["label"], r["code"], r["error"], r["label_error"]) for r in coded.collect()]
    assert sorted(got, key=str) == sorted(want_rows, key=str)


def test_active_entries_are_those_of_full_rescans():
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, (500, 3)).astype(float)          # many equal distances
    book = x[:40].copy()
    own, dist = active_lloyd.assign(x, book)
    for _ in range(8):
        new = book.copy()
        change = rng.choice(40, rng.integers(0, 12), replace=False)
        new[change] = rng.integers(-3, 4, (len(change), 3))
        own, dist = active_lloyd.assign(x, new, own, dist, (new != book).any(axis=1))
        book = new
        want = active_lloyd.assign(x, book)
        assert (own == want[0]).all() and (dist == want[1]).all()


def test_vectors_without_rows_or_too_large(spark):
    none = spark.createDataFrame([], VEC)
    coded, books = active_lloyd.compress(none)
    assert coded.count() == 0 and active_lloyd.book_sha256(books) == hashlib.sha256(b"").hexdigest()
    assert whitening.whiten(none).count() == 0
    only_empty = spark.createDataFrame([(1, [], 1, "c", 1, 2, 3, "d", 4)], VEC)
    assert active_lloyd.compress(only_empty)[0].first()["code"] == "00000000" and whitening.whiten(only_empty).count() == 0
    large = spark.createDataFrame([(i, [3e4 * i, -3e4, 1.0, 2e5 - i], 1, "c", 1, 2, 3, "d", 4) for i in range(9)], VEC)
    coded, _ = active_lloyd.compress(large, entries=4, parts=2)    # beyond 53 bits: long arithmetic
    codes, error, _ = _lloyd(_kept([(i, [3e4 * i, -3e4, 1.0, 2e5 - i], 1) for i in range(9)], 1024), 2, 4, 4)
    assert sorted((r["code"], r["error"]) for r in coded.collect()) == sorted(zip(codes, error.tolist()))
    huge = spark.createDataFrame([(1, [1e300], 1, "c", 1, 2, 3, "d", 4)], VEC)
    with pytest.raises(ValueError):
        vectors.integer_vectors(huge, 256, "vec_id", "embedding")


@pytest.mark.parametrize("spread", [0.4, 3e4])
def test_whitening(spark, spread):
    frame, rows = _table(spark, seed=2, spread=spread)
    kept = _kept(rows, 256)
    fit = np.array(sorted({tuple(v.tolist()) for _, v, _ in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    values, vecs = np.linalg.eigh(y.T @ y / n)
    values, vecs = values[::-1][:4], vecs[:, ::-1][:, :4]
    got = {}
    for r in whitening.whiten(frame).collect():
        got.setdefault((r["vec_id"], int(r["deviation"])), {}).setdefault(r["component"], []).append(r)
    assert sum(len(c[1]) for c in got.values()) == len(kept)
    for i, v, _ in kept:
        deviation = int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)))
        mine = got[i, deviation]
        assert sorted(mine) == [1, 2, 3, 4]
        for c, want in enumerate((v - sums / n) @ vecs / np.sqrt(values), 1):
            r = mine[c][0]
            assert r["n"] == n and abs(abs(r["whitened"]) - abs(want)) < 1e-9
            assert abs(r["explained"] - values[c - 1] / np.trace(y.T @ y / n)) < 1e-9 and r["identity_error"] < 1e-9


def test_factor_and_rotations():
    rng = np.random.default_rng(7)
    for rank, scales in ((7, 1.0), (3, 1.0), (7, np.logspace(0, -6, 7))):
        m = rng.normal(size=(7, rank)) * (scales[:rank] if np.ndim(scales) else scales)
        a = m @ m.T
        g = whitening.cholesky(a)
        assert g.shape == (7, rank) and np.allclose(g @ g.T, a)
        values, units = whitening.eigen(a)
        want = np.linalg.svd(m, compute_uv=False) ** 2
        assert np.allclose(values, want, rtol=1e-9) and np.allclose(units.T @ units, np.eye(rank))
        assert np.allclose(units * values @ units.T, a)
    assert whitening.eigen(np.zeros((4, 4)))[0].size == 0


DOC = "doc_id long, text string, key string, code long, words string, n_hit int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _brute(docs, items, window):
    wins = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            wins.setdefault(tuple(w[k: k + size]), set()).add(item)
    out = []
    for i, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(k) for k in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k: k + size]) in wins:
                    hit |= set(range(k, k + size))
                    found |= wins[tuple(w[k: k + size])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), names, bool(hit)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination(spark, seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "b", "Ab", "c", "d", "e9", "é", "中文", "zz"])
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    items = [(i, text(rnd.randint(0, 14))) for i in range(25)] + [(3, text(11)), (None, text(4)), (77, None), (78, "!?"),
                                                                 (79, "solo"), (80, "Solo word")]
    docs = [(i, text(rnd.randint(0, 60)) + " " + str(rnd.choice(items)[1])) for i in range(60)]
    docs += [(None, None), (7, ""), (7, items[0][1]), (None, items[3][1]), (8, "x" * 70_000 + " solo"),
             (9, "solo\0word SOLO" + "é" * 9), (10, "\x7fa\x7f")] + [(100 + i, items[2][1] + " tail") for i in range(40)]
    frame = spark.createDataFrame([(*d, "k", 1, "w", 2) for d in docs], DOC).repartition(5)
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, item string")
    for window in (10, 4):
        got = [tuple(r) for r in contamination.contaminated(frame, bench, window=window).collect()]
        assert sorted(got, key=str) == sorted(_brute(docs, items, window), key=str)


def test_contamination_of_empty_tables_and_full_filters(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert sorted(map(tuple, contamination.contaminated(docs, items.limit(0)).collect())) == [
        (1, 3, 0, 0, [], False), (2, 0, 0, 0, [], False)]
    assert contamination.contaminated(docs.limit(0), items).count() == 0
    monkeypatch.setattr(contamination, "FILTER_BITS", 15)
    monkeypatch.setattr(contamination, "BITS_A_CODE", 1 << 20)
    monkeypatch.setattr(contamination, "PIECE", 3)
    assert sorted(map(tuple, contamination.contaminated(docs, items).collect()))[0] == (1, 3, 2, 1, ["1"], True)


def test_filters_let_every_code_pass(spark):
    rng = np.random.default_rng(3)
    codes = rng.integers(-2**63, 2**63 - 1, 3000)
    keep = contamination.CodeFilter(spark.createDataFrame([(int(c),) for c in codes], "code long"))
    assert len(keep.passing(codes.astype(np.uint64))) == 3000
    assert len(keep.passing(rng.integers(0, 2**63, 20_000, dtype=np.uint64))) < 1500


def test_ids_are_those_of_the_plain_tokenizer():
    from tokenizers import Tokenizer

    from ordermill.llm import packing
    from ordermill.llm.queries import tokenizer_file
    path = tokenizer_file(packing.TOKENIZER)
    plain, mine, rnd = Tokenizer.from_file(path), packing.Words.of(path), random.Random(3)
    alphabet = [*"abAZ09 .,'s!?<>|%&\n\t-_é´ñİıΣσßǅ汉가😀٣Å", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "İ.", "'re",
                "́", "̸", "ᄀ", "ᅡ", "̇", " ", " ", "\x0b", "\x1c"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(10_000)]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(i, "<u2").tolist() for i in mine.ids(texts)] == want
    assert want[0] is not None and any(49407 in w for w in want)


def test_long_runs_and_leftmost_matches(spark):
    import time

    from ordermill.llm import pii
    base = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}"}
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("ab1.@_ -") for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    texts += ["".join(rnd.choice("19. ") for _ in range(40)) for _ in range(200)] + ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9"]
    rows = pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        for kind, pattern in base.items():
            want = [m.span() for m in re.finditer(pattern, r["text"])
                    if kind == "email" or all(int(p) <= 255 for p in m[0].split("."))]
            assert [(x["s"], x["e"]) for x in r[kind]] == want, (kind, r["text"])
    for run in ("x", "9", "((", "a1+"):
        frame = spark.createDataFrame([(1, run * 200_000 + " a@b.co")], "doc_id long, text string")
        start = time.time()
        assert len(pii.candidates(frame).select("email").first()[0]) == 1
        assert time.time() - start < 30                      # a quadratic scan takes many minutes


def test_pages_lose_no_text_to_unclosed_tags(spark):
    from ordermill.llm import html_main
    cases = {
        "<article><p>one<datalist id=d><option value=a><option value=b></datalist><p>two</article>": "one two",
        "<head><title>no</title><p>one": "one", "<head><meta charset=x><style>p{}</style><article>one</article>": "one",
        "<article>one <audio src=x> two <audio src=y>no</audio> three</article>": "one two three",
        "<article>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold</article>": "let x=2 hold",
        "<p>one<svg><g><svg/><text>no</text></svg>two<object><object>no</object>no</object>three": "onetwothree",
        "<p>one<select><option>no</select>two<canvas>three": "onetwothree", "<p>one<script>no</p>two": "one",
        "<p>one<video controls/>two<noscript>no</noscript>": "onetwo", "<textarea>no</textarea>a<iframe src=x></iframe>b": "ab"}
    rows = [(i, f"http://{i}.com/", h) for i, h in enumerate(cases)]
    got = html_main.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {rows[r["page_id"]][2]: r["text"] for r in got} == cases
    # a sentence that a quarter of the articles of a host hold is theirs; one on most of them is not
    site = [(i, f"http://a.com/{i}", f"<article><p>body {i * 31}<p>{'quoted words' if i % 4 == 0 else f'other {i}'}"
             f"<p>All rights kept</article><div>{'see also' if i % 4 == 0 else f'end {i}'}</div>") for i in range(60)]
    got = html_main.main_text(spark.createDataFrame(site, "page_id long, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert all(("quoted words" in texts[i]) == (i % 4 == 0) and "All rights" not in texts[i] for i in texts)
    assert not any("see also" in t for t in texts.values())
