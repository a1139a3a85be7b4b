"""Benchmark passages in documents, by a prefix-filtered set join.

A window is a run of words of a benchmark item (a short item is one window);
it occurs in a document only if all its shingles (three words; a shorter
window is one shingle) do.  So its rarest shingle is a necessary prefix: for
full containment one token of the rarity order is enough.

1. Items give their distinct windows, each with its shingles.  The codes of
   these shingles set bits of one bitmap of bounded size.
2. A pass over the documents counts every shingle whose bit is set; the counts
   over all documents are the rarity order, ties by code.  A window that holds
   a shingle no document has is out; any other keeps its rarest shingle and the
   place of it in the window.
3. A second pass finds the places of those prefix shingles in the documents
   (again by a bitmap) and carries the words around each.  Copies of a text
   collapse here: places are kept once per distinct text.
4. Places join windows on the prefix shingle, under the bounds of place (the
   window must begin in the document) and length (and end in it), and the
   words themselves are compared.  Codes and bitmaps only propose.

A bitmap never takes more than ``FILTER_BITS``, whatever the sizes of the
tables; what passes it wrongly is lost in the join.  Nothing else is
broadcast by hint, and no group is gathered but the matches of one text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm.common import BYTE_CODES, binary_column, id_text, mix64, staged

WINDOW, SHINGLE = 10, 3
FILTER_BITS = 27                 # a bitmap has at most 2 ** 27 bits (16 MB)
BITS_A_CODE = 64
PIECE = 1 << 21                  # bytes of text that a task holds as arrays at a time
MULT = 0x9E3779B97F4A7C15 | 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = True
IS_WORD[128:] = True


# -- words of texts (numpy, in tasks) ---------------------------------------------

def _word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit code of each word of lower-cased bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)       # place in its word
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(int(size.max()) - 1, MULT, np.uint64)], dtype=np.uint64)
        terms = BYTE_CODES[data[np.repeat(starts, size) + at]] * powers[at]
        return mix64(np.add.reduceat(terms, np.cumsum(size) - size) + size.astype(np.uint64))


def words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(lower-cased bytes, word starts, word ends, text of each word) of texts
    that lie one after another in ``data``."""
    low = LOWER[data]
    mark = np.zeros(len(low) + 1, np.int8)
    mark[:-1] = IS_WORD[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[starts], edge[ends] = True, True
    before = np.r_[np.int8(0), mark[:-1]]
    first = np.flatnonzero((mark == 1) & ((before == 0) | edge))
    last = np.flatnonzero((before == 1) & ((mark == 0) | edge))
    return low, first, last, np.searchsorted(starts, first, side="right") - 1


def _chunks(col):
    """Slices (lo, hi) of a column's texts of about PIECE bytes each, never less than a text."""
    data, starts, ends = binary_column(col)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + PIECE, side="right")))
        yield lo, hi, data[starts[lo]: ends[hi - 1]], starts[lo:hi] - starts[lo], ends[lo:hi] - starts[lo]
        lo = hi


def _rolled(codes: np.ndarray, n: int) -> np.ndarray:
    """Code of every run of n words."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(MULT) + codes[i: i + len(h)]
        return mix64(h)


def _shingles(codes, owner, n):
    """(code, index of the first word) of the n-word shingles inside one text."""
    h = _rolled(codes, n)
    at = np.flatnonzero(owner[: len(h)] == owner[n - 1:]) if len(h) else np.zeros(0, np.int64)
    return h[at], at


# -- benchmark windows ------------------------------------------------------------------

def _windows(window, shingle):
    def run(batches):
        for b in batches:
            ids = b.column("item").to_pylist()
            out = ([], [], [], [])
            for lo, _, data, starts, ends in _chunks(b.column("text")):
                low, first, last, owner = words(data, starts, ends)
                codes = _word_codes(low, first, last)
                text = [low[s:e].tobytes() for s, e in zip(first, last)]
                rolls = {n: _rolled(codes, n).astype(np.int64).tolist() for n in range(1, shingle + 1)}
                for t in range(len(starts)):
                    i, j = np.searchsorted(owner, [t, t + 1]).tolist()
                    size = min(window, j - i)
                    n = min(shingle, size)
                    for k in range(i, j - size + 1) if size else ():
                        out[0].append(ids[lo + t])
                        out[1].append(b" ".join(text[k: k + size]).decode())
                        out[2].append(size)
                        out[3].append(rolls[n][k: k + size - n + 1])
            yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
                                   pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.int64()))],
                                  names=["item", "words", "size", "codes"])
    return run


class CodeFilter:
    """Bitmap of the codes of a one-column table, built in Spark from blocks of
    32,768 bits; 64 bits a code up to the largest size, so few others pass."""

    def __init__(self, codes: DataFrame):
        n = codes.count()
        self.bits = min(FILTER_BITS, max(15, (BITS_A_CODE * n).bit_length()))
        at = F.shiftrightunsigned("code", 64 - self.bits)
        blocks = (codes.select(F.bitmap_bucket_number(at + 1).alias("block"), F.bitmap_bit_position(at + 1).alias("bit"))
                  .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())   # 16 MB at most
        bitmap = np.zeros(1 << self.bits - 3, np.uint8)
        for block, bits in blocks:
            bitmap[(block - 1) * 4096: block * 4096] = np.frombuffer(bits, np.uint8)
        self.shared = codes.sparkSession.sparkContext.broadcast(bitmap)

    def passing(self, codes: np.ndarray) -> np.ndarray:
        at = codes >> np.uint64(64 - self.bits)
        bitmap = self.shared.value
        return np.flatnonzero(bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1)

    def __getstate__(self):
        return {"bits": self.bits, "shared": self.shared}


# -- passes over the documents -----------------------------------------------------------

def _count(passing, lengths):
    def run(batches):
        for b in batches:
            for *_, data, starts, ends in _chunks(b.column("text")):
                low, first, last, owner = words(data, starts, ends)
                codes = _word_codes(low, first, last)
                for n in lengths:
                    h, _ = _shingles(codes, owner, n)
                    code, count = np.unique(h[passing.passing(h)], return_counts=True)
                    yield pa.record_batch([pa.array(code.astype(np.int64)), pa.array(count)], names=["code", "n"])
    return run


PLACES = "doc_id long, n_words long, key binary, code long, at int, before int, after int, around string"


def _place(passing, lengths, window, longest):
    """A row per document (code null), and a row per prefix shingle in it."""
    def run(batches):
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for lo, hi, data, starts, ends in _chunks(b.column("text")):
                low, first, last, owner = words(data, starts, ends)
                codes = _word_codes(low, first, last)
                bound = np.searchsorted(owner, np.arange(hi - lo + 1))               # words of text t: bound[t:t+2]
                found = []
                for n in lengths:
                    h, at = _shingles(codes, owner, n)
                    keep = passing.passing(h)
                    found.append((h[keep], at[keep], np.full(len(keep), n)))
                code, at, n = (np.concatenate(c) for c in zip(*found))
                text = owner[at] if len(at) else np.zeros(0, np.int64)
                keys = {t: hashlib.sha256(data[starts[t]: ends[t]].tobytes()).digest() for t in set(text.tolist())}
                # words longer than any of a window end the surroundings
                huge = np.r_[-1, np.flatnonzero(last - first > longest), len(first)]
                left = np.maximum(np.maximum(bound[text], at - (window - n)), huge[np.searchsorted(huge, at) - 1] + 1)
                stop = huge[np.minimum(np.searchsorted(huge, at), len(huge) - 1)]
                right = np.minimum(np.minimum(bound[text + 1], at + window), stop)
                fits = np.flatnonzero(right >= at + n)
                around = [" ".join([low[first[w]: last[w]].tobytes().decode() for w in range(x, y)])
                          for x, y in zip(left[fits].tolist(), right[fits].tolist())]
                docs, places = hi - lo, len(fits)
                text, at = text[fits], at[fits]
                yield pa.record_batch([
                    pa.array(ids[lo:hi] + [None] * places, pa.int64()),
                    pa.array(np.diff(bound).tolist() + [None] * places, pa.int64()),
                    pa.array([keys.get(t) for t in range(docs)] + [keys[t] for t in text.tolist()], pa.binary()),
                    pa.array([None] * docs + code[fits].astype(np.int64).tolist(), pa.int64()),
                    pa.array([None] * docs + (at - bound[text]).tolist(), pa.int32()),
                    pa.array([None] * docs + (at - left[fits]).tolist(), pa.int32()),
                    pa.array([None] * docs + (right[fits] - at).tolist(), pa.int32()),
                    pa.array([None] * docs + around, pa.string())],
                    names=["doc_id", "n_words", "key", "code", "at", "before", "after", "around"])
    return run


def find_windows(docs: DataFrame, items: DataFrame, window=WINDOW, shingle=SHINGLE, id_col="doc_id",
                 text_col="text", item_col="item_id", item_text="text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, occurrences, members).

    documents: doc_id, n_words, key (the text's SHA-256 where it may hold a
    window, else null), one row per row of ``docs``; occurrences: key, window
    (its words), start, size, once per distinct text; members: window, item."""
    docs = id_text(docs, id_col, text_col).select("doc_id", F.encode("text", "UTF-8").alias("text"))
    parts = items.select(F.col(item_col).cast("string").alias("item"),
                         F.encode(F.coalesce(F.col(item_text), F.lit("")), "UTF-8").alias("text"))
    parts = staged(parts.mapInArrow(_windows(window, shingle), "item string, words string, size int, codes array<long>"),
                   "windows")
    distinct = parts.groupBy("words").agg(F.first("size").alias("size"), F.first("codes").alias("codes"))
    tokens = distinct.select("words", "size", F.posexplode("codes").alias("offset", "code"))
    lengths, longest = parts.agg(
        F.collect_set(F.least("size", F.lit(shingle))),      # at most ``shingle`` numbers
        F.max(F.array_max(F.transform(F.split("words", " "), F.octet_length)))).first()
    lengths, longest = sorted(lengths), longest or 0
    if not lengths:
        lengths = [shingle]
    counts = docs.mapInArrow(_count(CodeFilter(tokens.select("code").distinct()), lengths), "code long, n long")
    rarity = counts.groupBy("code").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct("n", "code", "offset")).alias("rarest")
    # a window counts only with all its shingles met
    prefixes = staged(
        tokens.join(rarity, "code", "left").groupBy("words", "size")
        .agg(rarest, F.count("n").alias("met"), F.count(F.lit(1)).alias("all"))
        .where("met = all").select("words", "size", "rarest.code", "rarest.offset"), "prefixes")
    passing = CodeFilter(prefixes.select("code").distinct())
    places = staged(docs.mapInArrow(_place(passing, lengths, window, longest), PLACES), "places")
    documents = places.where("code is null").select("doc_id", "n_words", "key")
    met = places.where("code is not null").select("key", "code", "at", "before", "after", "around").distinct()
    inside = (F.col("offset") <= F.col("before")) & (F.col("size") - F.col("offset") <= F.col("after"))
    same = F.array_join(F.slice(F.split("around", " "), F.col("before") - F.col("offset") + 1, F.col("size")), " ")
    occurrences = (met.join(prefixes, "code").where(inside).where(same == F.col("words"))
                   .select("key", F.col("words").alias("window"), (F.col("at") - F.col("offset")).alias("start"), "size"))
    return documents, occurrences, parts.select(F.col("words").alias("window"), "item").distinct()


def contaminated(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated.

    Null and empty texts have no words; an item without words has no window.
    A null item id hits words but names no item; rows that share an item id are
    one item.  Each row of ``docs`` gives a row, null and repeated ids too; an
    empty table of either kind gives no rows, or rows without hits."""
    documents, occurrences, members = find_windows(docs, items, **names)
    occurrences = staged(occurrences, "occurrences")
    order = Window.partitionBy("key").orderBy("start", "size")
    reached = F.max(F.col("start") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("size") - F.greatest(F.col("start"), F.coalesce(reached, F.lit(0))))
    hits = (occurrences.select("key", "start", "size", fresh.alias("fresh"))
            .groupBy("key").agg(F.sum("fresh").alias("n_hit")))
    named = (occurrences.select("key", "window").distinct().join(members, "window").where("item is not null")
             .select("key", "item").distinct().groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items")))
    found = staged(hits.join(named, "key", "left").select(F.col("key").alias("text_key"), "n_hit", "items"), "found")
    none = F.array().cast("array<string>")
    clean = documents.where("key is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    rest = documents.where("key is not null").join(found, F.col("key") == F.col("text_key"), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))
    return clean.unionByName(rest).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        (F.col("n_hit") > 0).alias("contaminated"))
