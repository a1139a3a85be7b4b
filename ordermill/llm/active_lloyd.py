"""Vector codes by Lloyd's rounds that rescan only what an update can change.

A vector is cut into equal parts; every part position has a codebook.  A row
carries, for each part, the entry it is assigned to and its exact squared
distance.  After an update only some entries have moved.  A part whose own
entry stayed keeps its stored distance and compares it with the moved entries
alone: the entries that stayed were no nearer before and are not now.  A part
whose entry moved is compared with all.  Among equal distances the lower
index wins in both ways, so the codes are those of full rescans.

A round is one pass: tasks read the rows with their state, write them with
their new state, and add per partition one row for each entry used, with the
sum and count of its parts.  Only these sums (entries x dimension numbers)
and the codebooks reach the driver.  Distances are integers, exact in doubles
where they fit 53 bits and in 64-bit integers otherwise.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ordermill.llm.common import staged
from ordermill.llm.vectors import LONGS, integer_vectors, matrix, slices

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
EXACT = 1 << 52
FEW_LABELS = 100_000             # label totals up to this many rows are broadcast


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T)) + (entries * entries).sum(axis=1)[None, :]


def _nearest(x: np.ndarray, entries: np.ndarray, index: np.ndarray):
    """(index, distance) of the nearest of ``entries``, whose indexes rise: ties to the lower."""
    d = _distances(x, entries)
    at = d.argmin(axis=1)
    return index[at], d[np.arange(len(x)), at]


def assign(x: np.ndarray, book: np.ndarray, own=None, dist=None, moved=None):
    """Nearest entry and distance of every row of ``x``, given (or not) those to
    the codebook before and the mask of the entries that moved since."""
    every = np.arange(len(book))
    if own is None:
        return _nearest(x, book, every)
    own, dist = own.copy(), dist.copy()
    gone = moved[own]
    if gone.any():
        own[gone], dist[gone] = _nearest(x[gone], book, every)
    active = np.flatnonzero(moved)
    stay = np.flatnonzero(~gone)
    if len(active) and len(stay):
        at, d = _nearest(x[stay], book[active], active)
        better = (d < dist[stay]) | ((d == dist[stay]) & (at < own[stay]))
        own[stay[better]], dist[stay[better]] = at[better], d[better]
    return own, dist


def _state_schema(label) -> StructType:
    longs = ArrayType(LongType())
    return StructType([StructField("vec_id", LongType()), StructField("label", label),
                       StructField("x", longs), StructField("own", longs), StructField("dist", longs),
                       StructField("part", IntegerType()), StructField("entry", IntegerType()),
                       StructField("n", LongType()), StructField("total", longs)])


def _fixed(values: np.ndarray):
    """A matrix as an Arrow list column."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width),
                                    pa.array(np.ascontiguousarray(values, np.int64).reshape(-1)))


def _round(books, moved, exact, final):
    """Tasks of one pass: rows with their new state, and sums per entry unless it is the ``final`` one."""
    parts, size, width = books.shape
    books = books.astype(np.float64) if exact else books

    def run(batches):
        total = np.zeros((parts, size, width), np.int64)
        count = np.zeros((parts, size), np.int64)
        kind = None
        for b in slices(batches):
            x = matrix(b.column("x"), parts * width)
            kind = b.column("label").type
            if moved is not None:
                olds, dists = matrix(b.column("own"), parts), matrix(b.column("dist"), parts)
            own, dist = np.zeros((len(x), parts), np.int64), np.zeros((len(x), parts), np.int64)
            for p in range(parts):
                piece = x[:, p * width: (p + 1) * width]
                near = piece.astype(np.float64) if exact else piece
                state = () if moved is None else (olds[:, p], dists[:, p].astype(near.dtype), moved[p])
                own[:, p], dist[:, p] = assign(near, books[p], *state)
                if not final:
                    order = np.argsort(own[:, p], kind="stable")
                    used, first = np.unique(own[order, p], return_index=True)
                    total[p, used] += np.add.reduceat(piece[order], first, axis=0)
                    count[p] += np.bincount(own[:, p], minlength=size)
            n = len(x)
            if final:
                text = own.astype(np.uint8).tobytes().hex()
                code = [text[i: i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                yield pa.record_batch([b.column("vec_id"), b.column("label"), pa.array(code, pa.string()),
                                       pa.array(dist.sum(axis=1))], names=["vec_id", "label", "code", "error"])
            else:
                yield pa.record_batch(
                    [b.column("vec_id"), b.column("label"), _fixed(x), _fixed(own), _fixed(dist),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                     pa.nulls(n, pa.list_(pa.int64()))],
                    names=["vec_id", "label", "x", "own", "dist", "part", "entry", "n", "total"])
        p, e = np.nonzero(count)
        if len(p):
            lists = pa.nulls(len(p), pa.list_(pa.int64()))
            yield pa.record_batch(
                [pa.nulls(len(p), pa.int64()), pa.nulls(len(p), kind), lists, lists, lists,
                 pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), _fixed(total[p, e])],
                names=["vec_id", "label", "x", "own", "dist", "part", "entry", "n", "total"])
    return run


def train(rows: DataFrame, dims: int, bound: int, parts=PARTS, entries=ENTRIES, rounds=ROUNDS):
    """(codebooks [part, entry, component], final pass over the rows): ``rows`` hold vec_id, x, label."""
    width = -(-dims // parts)
    span = max(width, 1) * (2 * bound) ** 2
    if parts * span >= LONGS:
        raise ValueError("squared distances of these vectors do not fit a long")
    exact = span < EXACT
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    books = np.zeros((parts, len(first), width), np.int64)
    for e, (x,) in enumerate(first):
        books[:, e] = np.pad(np.array(x, np.int64), (0, parts * width - len(x))).reshape(parts, width)
    label = rows.schema["label"].dataType
    result = StructType([StructField("vec_id", LongType()), StructField("label", label),
                         StructField("code", StringType()), StructField("error", LongType())])
    moved = None
    if not first or not width:                               # no rows, or no components: every code is entry 0
        zeros = F.when(F.lit(bool(first)), F.lit("00" * parts))
        return books, rows.select("vec_id", "label", zeros.alias("code"), F.lit(0).cast("long").alias("error"))
    for _ in range(rounds):
        state = staged(rows.mapInArrow(_round(books, moved, exact, False), _state_schema(label)), "lloyd")
        sums = state.where("part is not null")
        counts = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"))
        totals = (sums.select("part", "entry", F.posexplode("total").alias("at", "s"))
                  .groupBy("part", "entry", "at").agg(F.sum("s").alias("s")))
        n = {(p, e): c for p, e, c in counts.collect()}
        new = books.copy()
        for p, e, at, s in totals.collect():
            new[p, e, at] = s // n[p, e]
        moved, books = (new != books).any(axis=2), new
        rows = state.where("part is null")
    return books, rows.mapInArrow(_round(books, moved, exact, True), result)


def book_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col="vec_id", vec_col="embedding", label_col="label", scale=SCALE,
             parts=PARTS, entries=ENTRIES, rounds=ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error; the codebooks).

    Vectors that are null or hold null, NaN or infinite components are left
    out.  Shorter vectors, and a dimension that the parts do not divide, count
    as padded with zeros.  The codebooks start from the smallest ids, null ids
    last, equal ids by their vectors; repeated rows are rows each.  Null labels
    count as one label.  An empty table gives no rows and empty codebooks.
    Vectors whose squared distances do not fit a long are an error."""
    if entries > 256:
        raise ValueError("a code holds two hex digits a part")
    rows, dims, bound = integer_vectors(vectors, scale, id_col, vec_col, {"label": label_col})
    books, coded = train(rows, dims, bound, parts, entries, rounds)
    coded = staged(coded, "codes")
    totals = staged(coded.groupBy(F.col("label").alias("group")).agg(F.sum("error").alias("label_error")), "labels")
    if totals.count() <= FEW_LABELS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("group"))).drop("group"), books
