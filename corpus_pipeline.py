"""The corpus pipeline: rate, drop near copies, cut repeated passages, redact, pack.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns the columns of ``documents``; the last returns pieces of
packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import packing, pii, quality, simhash_dedup, suffix_dedup
from ordermill.llm.common import staged
from ordermill.llm.queries import table, tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Fixed value: the bytes of one UTF-8 character, or a byte that is none.
CHARACTER = (r"([\x00-\x7F]+|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}"
             r"|\xED[\x80-\x9F][\x80-\xBF]|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}"
             r"|\xF4[\x80-\x8F][\x80-\xBF]{2})|[\x80-\xFF]")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier keeps, unchanged."""
    ratings = quality.grades(table(spark, sf_dir, "labels"))
    return quality.rate(docs, ratings, extra=tuple(COLUMNS[1:])).where("keep").select(*COLUMNS)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row, with the smallest id and then the smallest
    hash of the row; rows that share an id but not their text are apart.  Rows without
    an id cannot be named: of each group one of them stays besides."""
    docs = docs.select(*COLUMNS).withColumn("row", F.xxhash64(*COLUMNS))
    kept = simhash_dedup.representatives(docs, "row").select(
        F.col("doc_id").alias("kept_id"), F.col("row").alias("kept_row"))
    named = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (docs["row"] == kept["kept_row"])
    return docs.join(kept, named, "left_semi").dropDuplicates(["doc_id", "row"]).select(*COLUMNS)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes an earlier one has; a character that
    lost some of its bytes goes whole, and no other."""
    cut = suffix_dedup.remove_repeats(docs, with_kept=True, extra=("lang", "source"))
    kept = F.col("kept").cast("string")
    whole = F.regexp_replace(F.decode("kept", "ISO-8859-1"), CHARACTER, "$1")     # a letter per byte
    text = F.when(F.is_valid_utf8(kept), kept).otherwise(F.encode(whole, "ISO-8859-1").cast("string"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by the kind of span."""
    found = pii.detect(docs, extra=("lang", "source"))
    return (found.withColumn("text", pii.redacted()).withColumn("n_chars", F.length("text").cast("long"))
            .select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences."""
    return packing.pack(docs, tokenizer_file(packing.TOKENIZER))


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("repeats", repeats_stage),
    ("private", private_stage),
    ("packing", packing_stage),
]

# Neither the classifier's fit, nor XXH64 sums, nor BM25 packing can be said in SQL;
# tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
