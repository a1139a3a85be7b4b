"""Registered queries of the training-data operators (production parameters,
whole tables) and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (active_lloyd, contamination, html_main, maxscore, minhash, packing, pii, piece_scan,
                           quality, sharding, simhash_dedup, suffix_dedup, whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_html(spark, sf_dir):
    return html_main.main_text(table(spark, sf_dir, "pages"))


def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(packing.TOKENIZER))


def op4_shards(spark, sf_dir):
    return sharding.balanced_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_repeats(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_pieces(spark, sf_dir):
    return piece_scan.encode(table(spark, sf_dir, "documents"), tokenizer_file(piece_scan.MODEL)).drop("ids")


def op7_quality(spark, sf_dir):
    return quality.rate(table(spark, sf_dir, "documents"), quality.grades(table(spark, sf_dir, "labels")))


def op2_minhash(spark, sf_dir):
    return minhash.fingerprint_edits(table(spark, sf_dir, "documents"))


def op8_maxscore(spark, sf_dir):
    vectors = maxscore.quantized(table(spark, sf_dir, "embeddings"))
    return maxscore.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op9_pii(spark, sf_dir):
    return pii.detect(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op10_simhash(spark, sf_dir):
    return simhash_dedup.near_copies(table(spark, sf_dir, "documents"))


def op11_codes(spark, sf_dir):
    coded, books = active_lloyd.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error",
                        F.lit(active_lloyd.book_sha256(books)).alias("codebooks_sha256"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_contamination(spark, sf_dir):
    found = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


QUERIES = {f.__name__: f for f in (
    op1_html, op2_minhash, op3_packing, op4_shards, op5_repeats, op6_pieces, op7_quality, op8_maxscore, op9_pii,
    op10_simhash, op11_codes, op12_whitening, op13_contamination)}



def _lloyd_sql(rounds: int = 4) -> str:
    """Full rescans in every round."""
    steps = ["""r AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
        list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             "x AS MATERIALIZED (SELECT rid, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS v FROM r, range(4) t(p))",
             "b0 AS (SELECT p, rid - 1 AS e, v AS c FROM x WHERE rid <= 256)"]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT rid, x.p, any_value(v) AS v,
        min((list_inner_product(v::DOUBLE[], v::DOUBLE[]) - 2 * list_inner_product(v::DOUBLE[], c::DOUBLE[])
            + list_inner_product(c::DOUBLE[], c::DOUBLE[]))::BIGINT * 256 + e) AS m
      FROM x JOIN b{k} USING (p) GROUP BY rid, x.p)""")
        if k < rounds:
            steps += [f"""s{k} AS (SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT p, m % 256 AS e, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{k}) GROUP BY p, e, i)""",
                      f"""n{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{k} GROUP BY p, e)""",
                      f"b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(n{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN n{k} USING (p, e))"]
    return "WITH " + ",\n".join(steps) + f""",
h AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
      FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM b{rounds})),
f AS (SELECT rid, string_agg(printf('%02x', (m % 256)::INTEGER), '' ORDER BY p) AS code, sum(m // 256)::BIGINT AS error
      FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM r JOIN f USING (rid), h"""


ORACLE_SQL = {
    "op11_codes": _lloyd_sql(),
    "op13_contamination": """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
v AS (SELECT DISTINCT item_id, size, array_to_string(w[p + 1 : p + size], ' ') AS win
      FROM (SELECT *, unnest(range(len(w) - size + 1)) AS p FROM s)),
z AS (SELECT DISTINCT size FROM s),
o AS (SELECT doc_id, size, p, array_to_string(w[p + 1 : p + size], ' ') AS win
      FROM (SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS p FROM d JOIN z ON len(w) >= size)),
m AS (SELECT DISTINCT doc_id, p, size, win FROM o SEMI JOIN v USING (size, win)),
h AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS i FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m JOIN v USING (size, win)) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op4_shards": """
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, length(h) // 2 + 1 AS size,
        xor(list_reduce(list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT),
            lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
      FROM d, steps),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS total FROM c),
s AS (SELECT *, least(7, (8 * (2 * upto - size)) // (2 * total)) AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM s""",
    "op5_repeats": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS p FROM d WHERE length(h) >= 100)),
f AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s),
hit AS (SELECT DISTINCT doc_id, p FROM w JOIN f USING (s) WHERE low < doc_id),
b AS (SELECT doc_id, unnest(range(length(h) // 2)) AS i, unnest(regexp_extract_all(h, '..')) AS x FROM d WHERE h <> ''),
g AS (SELECT b.doc_id, i, x, hit.p IS NOT NULL AS head,
        max(hit.p) OVER (PARTITION BY b.doc_id ORDER BY i) AS near
      FROM b LEFT JOIN hit ON b.doc_id = hit.doc_id AND b.i = hit.p),
k AS (SELECT doc_id, i, x, coalesce(i - near < 50, false) AS gone FROM g),
m AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS fresh FROM k),
r AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (fresh) AS n_spans,
        sha256(unhex(coalesce(string_agg(x, '' ORDER BY i) FILTER (NOT gone), ''))) AS kept_sha256
      FROM m GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    coalesce(kept_sha256, sha256(''::BLOB)) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)""",
    "op8_maxscore": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20""",
}
