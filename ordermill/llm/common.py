"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.session import checkpoint_dir


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: dict | None = None) -> DataFrame:
    """Only the id (long) and the text (null: empty) under fixed names, and
    ``extra`` columns (new name: column), so columns of any name never clash
    with an operator's own."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     *[F.col(c).alias(new) for new, c in (extra or {}).items()])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    lineage ends at files every executor sees."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/ordermill-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def total_bytes(df: DataFrame, text_col: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(text_col)).alias("b")).first()["b"] or 0


# -- numpy helpers for tasks ------------------------------------------------

def binary_column(col):
    """(bytes as uint8, starts, ends) of an Arrow binary/string column without nulls."""
    import pyarrow as pa
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.binary())
    if len(arr) == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), z, z
    wide = pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type)
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset: arr.offset + len(arr) + 1]
    o = o.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]: o[-1]], o[:-1] - o[0], o[1:] - o[0]


_RNG = np.random.default_rng(20240611)
BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def rolling(data: np.ndarray, n: int, mult: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every n-byte substring, by doubling."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    h, size, acc, acc_len, rest = BYTE_CODES[data], 1, None, 0, n
    while True:
        if rest & 1:
            if acc is None:
                acc, acc_len = h, size
            else:
                m = min(len(h), len(acc) - size)
                acc = h[:m] * np.uint64(pow(mult, acc_len, 2**64)) + acc[size: size + m]
                acc_len += size
        rest >>= 1
        if not rest:
            return acc[: len(data) - n + 1]
        h = h[:-size] * np.uint64(pow(mult, size, 2**64)) + h[size:]
        size *= 2


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit hash over all its bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h
