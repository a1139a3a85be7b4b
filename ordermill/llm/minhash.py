"""One-permutation MinHash fingerprints with optimal densification.

Every shingle (five words) is hashed once; its top bits choose one of 512
bins, which keeps the smallest hash it got.  An empty bin copies the value of
the first filled bin on its own fixed probe sequence, the same for every
document.  The fingerprint packs the low four bits of each bin; two
fingerprints agree by chance in one bin of sixteen, which the likeness takes
out again.

Edited text needs the following document, so rows are range-partitioned by
id and streamed in order; the first and the last row of each partition are
written along and joined, one pair per partition border.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import id_text, mix64, staged

BINS, LOW_BITS, WORDS = 512, 4, 5
BIN_BITS = BINS.bit_length() - 1
GROUP = 64                      # documents sketched at a time (6 bits of a sort key)
PROBES = 4096
CACHE_WORDS = 400_000
U64 = np.uint64
_probe = mix64(np.arange(PROBES * BINS, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(1)) % U64(BINS)
_probe = _probe.astype(np.int64).reshape(PROBES, BINS)
POWERS = [U64(pow(0xA0761D6478BD642F, i, 2**64)) for i in range(WORDS)]


class WordCodes(dict):
    """64-bit code of each word, remembered up to a bound."""

    def __missing__(self, word):
        import xxhash
        code = xxhash.xxh64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = code
        return code


def _shingles(texts, codes):
    """(hash of each shingle, document row of each shingle)."""
    words = [t.split() for t in texts]
    size = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((codes[w] for ws in words for w in ws), U64, int(size.sum()))
    start = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(size)), size)
    h = np.zeros(len(flat), U64)
    for i in range(min(WORDS, len(flat))):
        h[: len(flat) - i] = h[: len(flat) - i] * POWERS[1] + flat[i:]
    whole = np.arange(len(flat)) - start[doc] <= size[doc] - WORDS
    short = np.flatnonzero((size > 0) & (size < WORDS))      # one shingle of all the words
    extra = []
    for d in short:
        acc = U64(len(words[d]))
        for c in flat[start[d]: start[d] + size[d]]:
            acc = acc * POWERS[1] + c
        extra.append(acc)
    return (mix64(np.r_[h[whole], np.array(extra, U64)]), np.r_[doc[whole], short], size > 0)


def sketch(texts: list[str], codes=None) -> tuple[np.ndarray, np.ndarray]:
    """(low bits per bin, has words) for up to GROUP texts."""
    with np.errstate(over="ignore"):
        h, doc, some = _shingles(texts, WordCodes() if codes is None else codes)
    key = (doc.astype(U64) << U64(58)) | (h >> U64(6))       # document, bin, rest of the hash
    key.sort()
    slot = (key >> U64(58 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, np.int64)
    values = np.zeros(len(texts) * BINS, np.uint8)
    full = np.zeros(len(texts) * BINS, bool)
    values[slot[first]] = (mix64(key[first] & U64((1 << (58 - BIN_BITS)) - 1)) & U64((1 << LOW_BITS) - 1)).astype(np.uint8)
    full[slot[first]] = True
    empty = np.flatnonzero(~full & np.repeat(some, BINS))
    for t in range(PROBES):
        if not len(empty):
            break
        source = (empty - empty % BINS) + _probe[t, empty % BINS]
        found = full[source]
        values[empty[found]] = values[source[found]]
        empty = empty[~found]
    for e in empty.tolist():                                 # never met a filled bin: the next one, around
        row = full[e - e % BINS: e - e % BINS + BINS]
        values[e] = values[e - e % BINS + (e % BINS + int(np.argmax(np.roll(row, -(e % BINS))))) % BINS]
    return values.reshape(len(texts), BINS), some


def packed(values: np.ndarray) -> list[str]:
    return [(r[0::2] << 4 | r[1::2]).tobytes().hex() for r in values]


def likeness(a, some_a, b, some_b) -> np.ndarray:
    """Jaccard estimate from low bits, freed of chance agreement; no words: 1 with no words, else 0."""
    chance = 2.0 ** -LOW_BITS
    j = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)
    return np.where(some_a & some_b, j, (some_a == some_b).astype(float))


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")
EDGE = OUT + ", part int, edge int, text string"


def _rows(ids, texts, nexts, codes):
    """Result columns of documents whose following text is known."""
    out = [[] for _ in range(7)]
    for lo in range(0, len(ids), GROUP):
        t, n = texts[lo: lo + GROUP], nexts[lo: lo + GROUP]
        edited = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(t, n)]
        own, own_some = sketch(t, codes)
        new, new_some = sketch(edited, codes)
        if t[1:] == n[:-1]:                                  # in order: only the last one's next is new
            tail, tail_some = sketch(n[-1:], codes)
            nxt, nxt_some = np.r_[own[1:], tail], np.r_[own_some[1:], tail_some]
        else:
            nxt, nxt_some = sketch(n, codes)
        for col, vals in zip(out, (
                ids[lo: lo + GROUP], [len(x) for x in t],
                [hashlib.sha256(x.encode()).hexdigest() for x in edited],
                [p if s else "" for p, s in zip(packed(own), own_some)],
                [p if s else "" for p, s in zip(packed(new), new_some)],
                likeness(own, own_some, new, new_some).tolist(),
                likeness(own, own_some, nxt, nxt_some).tolist())):
            col.extend(vals)
    return out


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _stream(batches):
    codes, part, last, any_row = WordCodes(), TaskContext.get().partitionId(), None, False

    def batch(cols, edges):
        n = len(cols[0])
        arrays = [pa.array(c + [None] * len(edges), t) for c, t in zip(cols, _TYPES)]
        arrays[0] = pa.array(cols[0] + [e[1] for e in edges], pa.int64())
        return pa.record_batch(arrays + [pa.array([part] * (n + len(edges)), pa.int32()),
                                         pa.array([0] * n + [e[0] for e in edges], pa.int32()),
                                         pa.array([None] * n + [e[2] for e in edges], pa.string())],
                               names=_NAMES + ["part", "edge", "text"])

    for b in batches:
        for lo in range(0, b.num_rows, 4 * GROUP):
            piece = b.slice(lo, 4 * GROUP)
            ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
            edges = [] if any_row else [(1, ids[0], texts[0])]
            any_row = True
            if last is not None:
                ids, texts = [last[0], *ids], [last[1], *texts]
            last = (ids[-1], texts[-1])
            yield batch(_rows(ids[:-1], texts[:-1], texts[1:], codes) if len(ids) > 1 else [[] for _ in range(7)], edges)
    if last is not None:
        yield batch([[] for _ in range(7)], [(2, *last)])


def _borders(batches):
    codes = WordCodes()
    for b in batches:
        cols = _rows(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("next").to_pylist(), codes)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)


def fingerprint_edits(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null text is empty text; a text without words has the empty fingerprint.
    Order is by falling id, null ids last, equal ids by a code of their text;
    a single row follows itself.  An empty table gives an empty result."""
    spark = docs.sparkSession
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text")]
    rows = id_text(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(rows.mapInArrow(_stream, EDGE), "minhash")
    heads = rows.where("edge = 1").select(F.col("part").alias("head"), F.col("text").alias("next"))
    tails = rows.where("edge = 2").select("part", "doc_id", "text")
    parts = sorted(r["part"] for r in rows.where("edge = 1").select("part").collect())   # one int per partition
    follow = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, head int")
    borders = (tails.join(F.broadcast(follow), "part").join(heads, "head")
               .select("doc_id", "text", "next").mapInArrow(_borders, OUT))
    return rows.where("edge = 0").select(*_NAMES).unionByName(borders)
