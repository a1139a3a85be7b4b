"""SimHash near-duplicates: all fingerprints within a few bits, bit-sliced.

Fingerprints are 64-bit sign sums over the XXH64 codes of word shingles.
Distinct fingerprints (copies have collapsed) are cut into five bit blocks;
two fingerprints within three bits agree on at least two of the five, so
they meet under one of the ten block pairs.  Under a key they are compared
bit-sliced: plane j holds bit j of many XORed pairs side by side, a
carry-save counter (ones, twos, over) adds the planes to all pairs at once,
and a block of pairs is abandoned as soon as every pair in it is over the
radius.  Each task returns a spanning forest of the links it saw, never all
pairs; star contraction joins the forests.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import id_text, staged
from ordermill.llm.components import components

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
CUTS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]     # (shift, width) of the five blocks
SUB_BLOCK = 4096        # fingerprints of one key compared in one task at once; more go to pairs of sub-blocks
FLUSH_ROWS = 1 << 19
SEGMENT = 60_000        # codes per 16-bit lane sum
PAIR_BLOCK = 1 << 14    # pairs per bit-sliced block
U64 = np.uint64


# -- fingerprints -----------------------------------------------------------

def shingle_codes(text: str, size: int) -> list[int]:
    import xxhash
    words = text.encode().lower().split()       # ASCII case and ASCII white space only
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    code, join = xxhash.xxh64_intdigest, b" ".join
    return [code(join(t), SEED) for t in zip(*(words[i:] for i in range(size)))]


def majority(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each document: bit set where over half of its codes set it."""
    out = np.zeros(len(counts), U64)
    has = np.flatnonzero(counts)
    if not len(has):
        return out
    pieces = -(-counts[has] // SEGMENT)
    owner = np.repeat(has, pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.r_[0, np.cumsum(counts)][owner] + nth * SEGMENT
    lanes = U64(0x0001000100010001)
    first = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]
    for j in range(16):
        sums = np.add.reduceat((codes >> U64(j)) & lanes, start)
        for lane in range(4):
            n = np.add.reduceat((sums >> U64(16 * lane)) & U64(0xFFFF), first).astype(np.int64)
            out[has] |= (2 * n > counts[has]).astype(U64) << U64(16 * lane + j)
    return out


def _fingerprints(size):
    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            carried = [n for n in batch.schema.names if n != "text"]
            for lo in range(0, batch.num_rows, 256):
                codes = [shingle_codes(t, size) for t in texts.slice(lo, 256).to_pylist()]
                counts = np.array([len(c) for c in codes], np.int64)
                flat = np.fromiter(itertools.chain.from_iterable(codes), U64, int(counts.sum()))
                yield pa.record_batch([*(batch.column(n).slice(lo, 256) for n in carried),
                                       pa.array(majority(flat, counts).view(np.int64))], names=[*carried, "fp"])
    return run


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE,
                 row_col: str | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), with ``row_col`` (a long) before fp as ``row``.
    Fewer words than a shingle make one shingle of them all; no words at all (or null) make zero."""
    return id_text(docs, id_col, text_col, {"row": row_col} if row_col else None).mapInArrow(
        _fingerprints(shingle), "doc_id long, " + "row long, " * bool(row_col) + "fp long")


# -- bit-sliced comparison --------------------------------------------------

def within(x: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For XORed pairs ``x``: are at most ``radius`` (< 4) bits set?"""
    hit = np.zeros(len(x), bool)
    for lo in range(0, len(x), PAIR_BLOCK):
        part = x[lo: lo + PAIR_BLOCK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
        planes = np.packbits(np.ascontiguousarray(bits.T), axis=1)         # one row per bit
        ones = np.zeros(planes.shape[1], np.uint8)
        twos, over = ones.copy(), ones.copy()
        for j, plane in enumerate(planes):
            carry = ones & plane
            ones ^= plane
            over |= twos & carry
            twos ^= carry
            if j % 8 == 7 and over.all() and (over[:-1] == 255).all() and _full(over[-1], len(part)):
                break
        else:
            # counts 0..3 are exact where nothing went over; compare them with the radius
            far = over.copy()
            if radius < 3:
                far |= twos & ones
            if radius < 2:
                far |= twos
            if radius < 1:
                far |= ones
            hit[lo: lo + len(part)] = ~np.unpackbits(far, count=len(part)).astype(bool)
    return hit


def _full(last, n):
    used = n % 8 or 8
    return last >> (8 - used) == (1 << used) - 1


def _forest(a, b):
    """Spanning forest of edges: each node but the roots once, linked to its root."""
    nodes, flat = np.unique(np.r_[a, b], return_inverse=True)
    u, v = flat[: len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        ru, rv = root[u], root[v]
        live = ru != rv
        if not live.any():
            break
        lo, hi = np.minimum(ru[live], rv[live]), np.maximum(ru[live], rv[live])
        np.minimum.at(root, hi, lo)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _links(key, side, fp, radius):
    """Links among rows of equal key (rows sorted by key).  In a pair of
    sub-blocks only rows of different sides meet."""
    a, b = [], []
    size = np.diff(np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)])
    start = np.cumsum(size) - size
    live = np.repeat(size, size)                        # group size of each row
    place = np.arange(len(key)) - np.repeat(start, size)
    step, rows = 1, np.flatnonzero((live > 1) & (place + 1 < live))
    while len(rows):
        for lo in range(0, len(rows), FLUSH_ROWS):
            r = rows[lo: lo + FLUSH_ROWS]
            hit = within(fp[r] ^ fp[r + step], radius) & ((side[r] < 0) | (side[r] != side[r + step]))
            a.append(fp[r[hit]])
            b.append(fp[r[hit] + step])
        if sum(map(len, a)) > 4 * FLUSH_ROWS:
            x, y = _forest(np.concatenate(a), np.concatenate(b))
            a, b = [x], [y]
        step += 1
        rows = rows[place[rows] + step < live[rows]]
    if not a:
        return np.zeros(0, U64), np.zeros(0, U64)
    return _forest(np.concatenate(a), np.concatenate(b))


def _compare(radius):
    def run(batches):
        held = None

        def out(rows):
            x, y = _links(rows[0], rows[1], rows[2].view(U64), radius)
            return pa.record_batch([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

        for batch in batches:
            new = [batch.column(n).to_numpy() for n in ("key", "side", "fp")]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]) >= FLUSH_ROWS:
                cut = np.searchsorted(held[0], held[0][-1])        # the last key may go on
                if cut:
                    yield out([x[:cut] for x in held])
                    held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield out(held)
    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a spanning set of the links among distinct ``fp`` values."""
    assert 0 <= radius <= 3
    part = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in CUTS]
    keys = [(F.lit(t << 26).bitwiseOR(F.shiftleft(part[i], 13)).bitwiseOR(part[j]))
            for t, (i, j) in enumerate(itertools.combinations(range(5), 2))]
    rows = prints.select("fp", F.explode(F.array(*keys)).alias("block"))
    # a key with more fingerprints than one comparison holds: sub-blocks, and each pair of them
    crowded = (rows.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > SUB_BLOCK)
               .select("block", F.ceil(F.col("n") / SUB_BLOCK).cast("int").alias("subs")))
    rows = rows.join(crowded, "block", "left")
    sub = F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int")
    pair = F.expr("transform(sequence(0, subs - 1), t -> "
                  "named_struct('i', least(sub, t), 'j', greatest(sub, t), 'side', if(t = sub, -1, sub)))")
    whole = rows.where("subs is null").select(F.xxhash64("block").alias("key"), F.lit(-1).alias("side"), "fp")
    split = (rows.where("subs is not null").withColumn("sub", sub).withColumn("p", F.explode(pair))
             .select(F.xxhash64("block", "p.i", "p.j").alias("key"), F.col("p.side").alias("side"), "fp"))
    return (whole.unionByName(split).repartition("key").sortWithinPartitions("key", "fp")
            .mapInArrow(_compare(radius), "a long, b long"))


def _named(prints: DataFrame, radius: int) -> DataFrame:
    """fp, root (a fingerprint of its component, the same for all of them), component_id of staged ``prints``."""
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    root = components(links(distinct.select("fp"), radius))
    rooted = (distinct.join(root, distinct.fp == root.node, "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_copies(docs: DataFrame, id_col="doc_id", text_col="text", shingle=SHINGLE,
                radius=RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable
    over links of at most ``radius`` bits, itself included).

    Null text is empty text; all texts without words share fingerprint zero
    and link like others.  Rows with a null id take part, but name no
    component (null if a component has no other ids).  Repeated rows stay."""
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "simhash")
    return prints.join(_named(prints, radius), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, row_col: str, id_col="doc_id", text_col="text", shingle=SHINGLE,
                    radius=RADIUS) -> DataFrame:
    """(doc_id, row): of each component of ``near_copies`` its row with the smallest id, then the
    smallest ``row_col`` (a long that tells rows of one id apart), and its smallest row without an id."""
    prints = staged(fingerprints(docs, id_col, text_col, shingle, row_col), "simhash-rows")
    least = F.min(F.struct("doc_id", "row")).alias("least")
    return (prints.join(_named(prints, radius).select("fp", "root"), "fp")
            .groupBy("root", F.col("doc_id").isNull()).agg(least).select("least.doc_id", "least.row"))
