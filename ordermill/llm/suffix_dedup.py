"""Repeated-passage removal with a logarithmic family of suffix arrays.

A byte of a document goes if a 50-byte string covering it also starts in a
document with a smaller id.  All strings are judged on the input.

How the work is spread:

1. Documents are dealt by id into blocks of about ``BLOCK_BYTES``.  Every
   50-byte window names one anchor, the smallest 20-byte gram inside it, so
   equal windows name equal anchors and each anchor owns a run of windows.
2. Each block sends the 4-byte codes of its distinct anchors (one per block,
   however often a line repeats there) to ``key shards``; a shard answers one
   bit per anchor: does another block have it?  Only runs with such anchors
   can hold a repeated window.
3. Blocks send the bytes of those runs (equal runs of a block once, with the
   smallest id) to the key shard of their anchor.  The shard takes them in id
   order in batches.  A batch gets its suffix array (window starts ordered by
   their 50-byte prefix, as a 64-bit code that a second code confirms), is
   merge-scanned against the levels already there, then becomes level 0;
   levels of equal size merge, so a shard holds O(log batches) levels.
4. Answers (a bit per window) go back to the block, which cuts its documents.

The three passes over the text read one shuffle by block.  Memory of a task
is one block or one key shard.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import binary_column, id_text, mix64, rolling, total_bytes

MATCH = 50                      # bytes of a repeated string
GRAM = 20                       # bytes of an anchor
SPAN = MATCH - GRAM + 1         # grams inside one window (at most 32: a run is a 32-bit mask)
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 12 << 20          # corpus bytes per key shard
BATCH_WINDOWS = 1 << 18
SLICE = 1 << 20
MULT_A, MULT_B, MULT_G = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD
LAST_ID = np.iinfo(np.int64).max
U64 = np.uint64


class Block:
    """Documents of one block in id order, and the runs of their windows."""

    def __init__(self, table):
        ids = table.column("doc_id").fill_null(LAST_ID).to_numpy()
        self.null_id = np.asarray(table.column("doc_id").is_null())
        order = np.argsort(ids, kind="stable")
        self.order = pa.array(order)
        self.ids, self.null_id = ids[order], self.null_id[order]
        self.data, self.start, self.end = binary_column(table.column("data").take(self.order))

    def runs(self, contexts=False):
        """(first window, last window, anchor code, document row[, context code]) of each run."""
        n = len(self.data)
        valid_upto = self.end - MATCH + 1
        parts = []
        for lo in range(0, max(0, n - MATCH + 1), SLICE):
            hi = min(lo + SLICE, n - MATCH + 1)
            piece = self.data[lo: hi + MATCH - 1]
            code = mix64(rolling(piece, GRAM, MULT_G))
            low = (code & U64(0xFFFFFFFF00000000)) | np.arange(len(code), dtype=U64)
            width = 1
            while width * 2 <= SPAN:
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            if width < SPAN:
                rest = SPAN - width
                low = np.minimum(low[:-rest], low[rest:])
            at = (low & U64(0xFFFFFFFF)).astype(np.int64)          # anchor of window lo + i
            first_doc = np.searchsorted(self.end, lo, side="right")
            last_doc = np.searchsorted(self.start, hi, side="left")
            ok = np.zeros(hi - lo + 1, np.int32)
            a = np.maximum(self.start[first_doc:last_doc], lo)
            b = np.minimum(valid_upto[first_doc:last_doc], hi)
            keep = b > a
            np.add.at(ok, a[keep] - lo, 1)
            np.add.at(ok, b[keep] - lo, -1)
            ok = np.flatnonzero(np.cumsum(ok[:-1]) > 0)
            if not len(ok):
                continue
            anchor = at[ok]
            cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(ok) != 1)) + 1
            s1 = ok[np.r_[0, cut]]
            s2 = ok[np.r_[cut - 1, len(ok) - 1]]
            row = [s1 + lo, s2 + lo, code[anchor[np.r_[0, cut]]]]
            if contexts:
                w = rolling(piece, MATCH, MULT_A)
                row.append(mix64(w[s1] * U64(3) + mix64(w[s2] + (s2 - s1).astype(U64))))
            parts.append(row)
        if not parts:
            z = np.zeros(0, np.int64)
            return (z, z, z.astype(U64), z, z.astype(U64))
        out = [np.concatenate(x) for x in zip(*parts)]
        doc_of = np.searchsorted(self.end, out[0], side="right")
        return (*out[:3], doc_of, *out[3:])


def _distinct(code, doc):
    """Sorted distinct anchors, whether a block-mate document shares them, and each run's place."""
    uniq, place = np.unique(code, return_inverse=True)
    first = np.full(len(uniq), LAST_ID)
    last = np.full(len(uniq), -1)
    np.minimum.at(first, place, doc)
    np.maximum.at(last, place, doc)
    return uniq, first != last, place


def _representatives(context):
    """Row of the first run (so the smallest id) with the same bytes, for each run."""
    _, first, place = np.unique(context, return_index=True, return_inverse=True)
    return first[place]


def _anchors(shards):
    def run(key, table):
        code, doc = Block(table).runs()[2:4]
        uniq, _, _ = _distinct(code, doc)
        shard = (uniq % U64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        tail = (uniq[order] >> U64(32)).astype(np.uint32)
        names, at = np.unique(shard[order], return_index=True)
        ends = np.r_[at[1:], len(order)]
        return pa.table({"shard": pa.array(names, pa.int32()),
                         "block": pa.array([key[0].as_py()] * len(names), pa.int32()),
                         "codes": pa.array([tail[a:b].tobytes() for a, b in zip(at, ends)], pa.binary())})
    return run


def _shared(key, table):
    raw, start, end = binary_column(table.column("codes"))
    code = raw.view(np.uint32)
    order = np.argsort(code, kind="stable")
    s = code[order]
    same = np.zeros(len(s), bool)
    same[1:] = s[1:] == s[:-1]
    same[:-1] |= same[1:]
    hit = np.empty(len(s), bool)
    hit[order] = same
    return pa.table({"block": table.column("block").cast(pa.int32()),
                     "shard": pa.array([key[0].as_py()] * len(start), pa.int32()),
                     "hits": pa.array([np.packbits(hit[a // 4: b // 4]).tobytes() for a, b in zip(start, end)],
                                      pa.binary())})


def _contexts(shards):
    def run(key, docs, answers):
        empty = pa.table({k: pa.array([], t) for k, t in
                          (("shard", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()),
                           ("windows", pa.binary()), ("rows", pa.binary()), ("bytes", pa.binary()))})
        if not docs.num_rows:
            return empty
        block = Block(docs)
        s1, s2, code, doc, context = block.runs(contexts=True)
        uniq, shared, place = _distinct(code, doc)
        shard = (uniq % U64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        names, at = np.unique(shard[order], return_index=True)
        span = {int(n): order[a:b] for n, a, b in zip(names, at, np.r_[at[1:], len(order)])}
        for name, bits in zip(answers.column("shard").to_pylist(), answers.column("hits").to_pylist()):
            rows = span[name]
            shared[rows] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=len(rows)).astype(bool)
        send = np.flatnonzero(shared[place])
        send = send[_representatives(context[send]) == np.arange(len(send))] if len(send) else send
        if not len(send):
            return empty
        to = shard[place[send]]
        send = send[np.argsort(to, kind="stable")]
        to = shard[place[send]]
        names, at = np.unique(to, return_index=True)
        data, out = block.data.tobytes(), []
        for name, a, b in zip(names, at, np.r_[at[1:], len(send)]):
            r = send[a:b]
            out.append((int(name), key[0].as_py(), block.ids[doc[r]].tobytes(),
                        (s2[r] - s1[r] + 1).astype(np.uint8).tobytes(), r.astype(np.uint32).tobytes(),
                        b"".join([data[i: j + MATCH] for i, j in zip(s1[r].tolist(), s2[r].tolist())])))
        cols = list(zip(*out))
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(
            (("shard", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()),
             ("windows", pa.binary()), ("rows", pa.binary()), ("bytes", pa.binary())), cols)})
    return run


class Family:
    """Levels of suffix arrays: level i covers 2**i batches; no two stay equal in size."""

    def __init__(self):
        self.levels = []            # (batches, codes ascending, second codes, smallest id)

    def scan(self, code, check, doc):
        """True where a level holds the same string under a smaller id."""
        hit = np.zeros(len(code), bool)
        for _, codes, checks, ids in self.levels:
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hit |= (codes[at] == code) & (checks[at] == check) & (ids[at] < doc)
        return hit

    def add(self, code, check, doc):
        level = (1, code, check, doc)
        while self.levels and self.levels[-1][0] == level[0]:
            old = self.levels.pop()
            code, check, doc = (np.concatenate([o, n]) for o, n in zip(old[1:], level[1:]))
            order = np.argsort(code, kind="stable")     # two sorted runs; older entries first
            code, check, doc = code[order], check[order], doc[order]
            new = np.ones(len(code), bool)
            new[1:] = (code[1:] != code[:-1]) | (check[1:] != check[:-1])
            level = (2 * level[0], code[new], check[new], doc[new])
        self.levels.append(level)


def _scan(key, table):
    """One key shard: batches in id order through the family; answers for each block."""
    raw, start, _ = binary_column(table.column("bytes"))
    ids = np.frombuffer(binary_column(table.column("ids"))[0].tobytes(), np.int64)
    windows, w0, w1 = binary_column(table.column("windows"))
    windows = windows.astype(np.int64)
    rows = np.frombuffer(binary_column(table.column("rows"))[0].tobytes(), np.uint32)
    source = np.repeat(np.arange(table.num_rows), w1 - w0)
    offset = np.r_[0, np.cumsum(windows + MATCH - 1)][:-1]
    mask = np.zeros(len(ids), np.uint32)
    order = np.argsort(ids, kind="stable")
    upto = np.cumsum(windows[order])
    family, done = Family(), 0
    while done < len(order):
        base = upto[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(upto, base + BATCH_WINDOWS, side="right")))
        e = order[done:stop]
        done = stop
        n, size = windows[e], windows[e] + MATCH - 1
        first = np.cumsum(size) - size
        text = raw[np.repeat(offset[e] - first, size) + np.arange(size.sum())]
        win = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(win, n)              # window number inside its run
        at = np.repeat(first, n) + place
        code, check = rolling(text, MATCH, MULT_A)[at], rolling(text, MATCH, MULT_B)[at]
        doc = np.repeat(ids[e], n)
        array = np.argsort(code, kind="stable")                     # ids ascend inside equal codes
        c, k, d = code[array], check[array], doc[array]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (k[1:] != k[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(c)), 0))
        hit_sorted = d[head] < d
        heads = np.flatnonzero(new)
        seen = np.zeros(len(c), bool)
        old = family.scan(c[heads], k[heads], d[heads])
        seen[heads] = old
        hit_sorted |= seen[head]
        hit = np.empty(len(c), bool)
        hit[array] = hit_sorted
        mask[e] = np.bitwise_or.reduceat(hit.astype(np.uint32) << place.astype(np.uint32), win)
        family.add(c[heads], k[heads], d[heads])
    out = np.flatnonzero(mask)
    names, at = np.unique(source[out], return_index=True)
    ends = np.r_[at[1:], len(out)]
    blocks = table.column("block").to_pylist()
    return pa.table({"block": pa.array([blocks[i] for i in names], pa.int32()),
                     "rows": pa.array([rows[out[a:b]].tobytes() for a, b in zip(at, ends)], pa.binary()),
                     "masks": pa.array([mask[out[a:b]].tobytes() for a, b in zip(at, ends)], pa.binary())})


def _cut(with_kept, extra):
    def run(key, docs, answers):
        block = Block(docs)
        n = len(block.data)
        s1, s2, _, doc, context = block.runs(contexts=True)
        mask = np.zeros(len(s1), np.uint32)
        for r, m in zip(answers.column("rows").to_pylist(), answers.column("masks").to_pylist()):
            mask[np.frombuffer(r, np.uint32)] = np.frombuffer(m, np.uint32)
        if len(s1):
            rep = _representatives(context)
            mask = np.where(block.ids[doc] > block.ids[doc[rep]], np.uint32(0xFFFFFFFF), mask[rep])
        count = s2 - s1 + 1
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        hit = ((np.repeat(mask, count) >> place.astype(np.uint32)) & np.uint32(1)).astype(bool)
        begins = (np.repeat(s1, count) + place)[hit]
        edge = np.zeros(n + MATCH + 1, np.int32)
        edge[begins] += 1                     # begins are distinct
        edge[begins + MATCH] -= 1
        gone = np.cumsum(edge[:n]) > 0
        total = np.r_[0, np.cumsum(gone)]
        fresh = gone.copy()
        fresh[1:] &= ~gone[:-1]
        inside = block.start[block.end > block.start]
        fresh[inside] = gone[inside]
        spans = np.r_[0, np.cumsum(fresh)]
        kept_at = np.arange(n + 1) - total
        kept = block.data[~gone].tobytes()
        pieces = [kept[a:b] for a, b in zip(kept_at[block.start].tolist(), kept_at[block.end].tolist())]
        out = {"doc_id": pa.array(block.ids, pa.int64(), mask=block.null_id),
               "n_bytes": pa.array(block.end - block.start, pa.int64()),
               "n_removed": pa.array(total[block.end] - total[block.start], pa.int64()),
               "n_spans": pa.array(spans[block.end] - spans[block.start], pa.int64()),
               "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string())}
        if with_kept:
            out["kept"] = pa.array(pieces, pa.binary())
        out.update((c, docs.column(c).take(block.order)) for c in extra)
        return pa.table(out)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   with_kept: bool = False, extra: tuple = ()) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    (and ``kept``, the bytes left, on request), and the ``extra`` columns.

    Null text counts as empty; a null id as larger than every id.  Rows with
    the same id never remove each other's bytes.  An empty table gives an
    empty result."""
    carried = [f"x_{i}" for i in range(len(extra))]
    d = id_text(docs, id_col, text_col, dict(zip(carried, extra)))
    size = total_bytes(d)
    blocks, shards = size // BLOCK_BYTES + 1, size // SHARD_BYTES + 1
    d = d.select(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).cast("int").alias("block"),
                 "doc_id", F.encode("text", "UTF-8").alias("data"), *carried)
    by_block = d.groupBy("block")
    anchors = by_block.applyInArrow(_anchors(shards), "shard int, block int, codes binary")
    shared = anchors.groupBy("shard").applyInArrow(_shared, "block int, shard int, hits binary")
    sent = by_block.cogroup(shared.groupBy("block")).applyInArrow(
        _contexts(shards),
        "shard int, block int, ids binary, windows binary, rows binary, bytes binary")
    answers = sent.groupBy("shard").applyInArrow(_scan, "block int, rows binary, masks binary")
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
              + ", kept binary" * with_kept + "".join(f", {c} {t}" for c, t in d.select(*carried).dtypes))
    out = by_block.cogroup(answers.groupBy("block")).applyInArrow(_cut(with_kept, carried), schema)
    return out.withColumnsRenamed(dict(zip(carried, extra)))
