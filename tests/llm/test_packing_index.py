"""The corpus-wide index of packing: counts, scores and shards against plain Python."""

import math
import random
from collections import Counter

import numpy as np

from ordermill.llm import packing
from ordermill.llm.queries import tokenizer_file


def binary(terms):
    return np.array([*terms, packing.END_ID], "<u2").tobytes()


def bm25(query, docs, counts, n, mean):
    """Score of every document by the plain formula; sizes include the end mark."""
    out = []
    for d in docs:
        tf, norm = Counter(d), packing.K1 * (1 - packing.B + packing.B * (len(d) + 1) / mean)
        out.append(sum(math.log(1 + (n - counts[t] + 0.5) / (counts[t] + 0.5)) * tf[t] * (packing.K1 + 1) / (tf[t] + norm)
                       for t in set(query) if tf[t]))
    return out


def test_counts_are_those_of_the_corpus(spark):
    path = tokenizer_file(packing.TOKENIZER)
    texts = ["", None, "one two two", "one, three", "four " * 50, "two " * 64]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    pieces = docs.select("doc_id", packing.F.coalesce("text", packing.F.lit("")).alias("text")).mapInArrow(
        packing._tokenize(path, packing.END_ID, 16, False), packing.PIECE)
    n, stats = packing._statistics(pieces)
    words, rest = packing.Words.of(path), []
    for t in texts:
        ids = np.frombuffer(words.ids([t or ""])[0], "<u2").tolist() + [packing.END_ID]
        rest += [ids[len(ids) - len(ids) % 16:]] if len(ids) % 16 else []
    df = Counter(t for r in rest for t in set(r[:-1]))
    assert n == len(rest) and abs(stats.mean - sum(map(len, rest)) / n) < 1e-9
    want = [math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in range(packing.TERMS)]
    assert np.allclose(stats.idf, want, rtol=1e-5)


def test_scores_with_counts_of_a_larger_corpus():
    rnd = random.Random(5)
    corpus = [[rnd.choice((rnd.randrange(3, 9), rnd.randrange(3, 400))) for _ in range(rnd.randrange(60))] for _ in range(300)]
    shard = corpus[:120]
    counts = Counter(t for d in corpus for t in set(d))
    mean = sum(len(d) + 1 for d in corpus) / len(corpus)
    index = packing.Index([binary(d) for d in shard], packing.Statistics.of([binary(d) for d in corpus]))
    free = np.array([rnd.random() < 0.7 for _ in shard])
    for query in (shard[0], shard[7], corpus[200], []):
        want = bm25(query, shard, counts, len(corpus), mean)
        got = index.neighbours(binary(query), free).tolist()
        assert set(got) == {i for i, w in enumerate(want) if w > 0 and free[i]}
        assert all(want[a] >= want[b] - 1e-4 for a, b in zip(got, got[1:]))


def test_like_documents_meet():
    rnd = random.Random(6)
    topics = [[rnd.randrange(100, 40000) for _ in range(25)] for _ in range(60)]
    docs = [rnd.choices(topics[i % 60], k=40) + rnd.choices(range(3, 60), k=60) for i in range(2400)]
    ids = [binary(d) for d in docs]
    stats, clocks = packing.Statistics.of(ids), packing._clocks()
    drawn = packing.draws(ids, stats, clocks)
    assert (packing.draws(ids[::-1], stats, clocks)[::-1] == drawn).all()
    assert all(set(row.tolist()) <= set(d) for row, d in zip(drawn, docs))
    assert packing.draws([binary([])], stats, clocks).tolist() == [[-1] * packing.DRAWS]
    place = np.empty(len(docs), int)
    place[np.lexsort(drawn.T[::-1])] = np.arange(len(docs)) // 300
    index, met = packing.Index(ids, stats), []
    for seed in range(0, 2400, 40):
        free = np.arange(len(docs)) != seed
        met.append(np.mean(place[index.neighbours(ids[seed], free)[:10]] == place[seed]))
    assert np.mean(met) > 0.3           # dealt by hash: one in eight


def test_shards_fill_windows_by_score():
    rnd = random.Random(7)
    docs = [[rnd.randrange(3, 40) for _ in range(rnd.randrange(1, 20))] for _ in range(80)]
    ids = [binary(d) for d in docs]
    stats = packing.Statistics.of(ids)
    out, after = packing._fill([(i, 0, len(d) + 1, x) for i, (d, x) in enumerate(zip(docs, ids))], stats, 32, True, 5)
    placed = {}
    for doc, start, n, crc, size, seq, offset, piece in out:
        assert piece == ids[doc][2 * start: 2 * (start + n)] and size == len(docs[doc]) + 1
        placed.setdefault(seq, []).append((offset, n, doc, start))
    assert sorted(placed) == list(range(5, after))
    assert all(sum(n for _, n, _, _ in p) == 32 for s, p in placed.items() if s + 1 < after)
    # the documents after the first whole seed of a sequence come in falling score, all better than those left
    counts, mean = Counter(t for d in docs for t in set(d)), sum(len(d) + 1 for d in docs) / len(docs)
    used = set()
    for seq in sorted(placed):
        order = [d for _, _, d, _ in sorted(placed[seq])]
        new = [d for d in order if d not in used]
        used.add(order[0])
        if new and new[0] == order[0] and len(order) > 2:
            score = bm25(docs[order[0]], docs, counts, len(docs), mean)
            got = [score[d] for d in order[1:]]
            assert all(a >= b - 1e-4 for a, b in zip(got, got[1:]))
            rest = [score[d] for d in range(len(docs)) if d not in used and d not in order]
            assert not rest or min(got) >= max(rest) - 1e-4 or min(got) == 0
        used |= set(order)
