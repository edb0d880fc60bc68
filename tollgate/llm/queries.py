"""The operators over the driver tables, a query each, and their expected results where SQL has them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import (
    contextual_pii,
    importance_resampling,
    jaccard_join,
    license_scan,
    line_dedup,
    minhash_dedup,
    mixing,
    packing,
    source_divergence,
    token_files,
    topk_products,
    toxicity,
    weak_quality,
)
from tollgate.llm.common import documents, scratch, ship


def _tokenizer(name: str) -> str:
    return public_tokenizers.path(name)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, mixed = mixing.mix(documents(spark, sf_dir))
    return mixing.taken(known, mixed).select("doc_id", "size", "source_size", "target", "taken")


#: The mix takes a document's part of the first ``target`` words of its source's stream.
OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS number
  FROM d GROUP BY source
), w AS (
  SELECT *, 2 * source_size AS cap, CASE number % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s
), r AS (
  SELECT *, cap::DOUBLE / weight AS full_at,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, number
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM w
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * coalesce(
    (SELECT rate FROM r WHERE rate <= full_at ORDER BY full_at, number LIMIT 1), 'inf'::DOUBLE)) AS target FROM r
), p AS (
  SELECT d.doc_id, size, source_size, target, floor(target)::BIGINT AS most,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY substr(md5('0:' || coalesce(d.doc_id || ':', '') || size), 1, 15),
      d.doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(start + size, most) - start)
   + greatest(0, least(source_size + start + size, most) - source_size - start))::BIGINT AS taken
FROM p
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    model = toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tokens")
    token_files.write_tokens(documents(spark, sf_dir), folder, _tokenizer("byte_bpe_50k.json"), 0, 50_257)
    read = token_files.read_tokens(spark, folder)
    n_tokens = (F.length("ids") / 4).cast("long").alias("n_tokens")
    return read.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op4_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), 2)
    length = (F.length("ids") / 4).cast("long").alias("length")
    return packed.select(
        "doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


def op6_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contextual_pii.digest(contextual_pii.find_personal_data(documents(spark, sf_dir)))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


#: A line stays if no line before it is equal or one edit away.
OP7_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), d AS (
  SELECT line, length(line) AS n, min({'doc_id': doc_id, 'pos': pos}) AS first FROM l WHERE length(line) >= 20 GROUP BY line
), near AS (
  SELECT DISTINCT b.line FROM d a JOIN d b ON a.first < b.first AND abs(a.n - b.n) <= 1
    AND (left(a.line, (a.n // 2 - 1)::INTEGER) = left(b.line, (a.n // 2 - 1)::INTEGER)
      OR right(a.line, (a.n // 2 - 1)::INTEGER) = right(b.line, (a.n // 2 - 1)::INTEGER))
  WHERE levenshtein(a.line, b.line) <= 1
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text FROM l
  WHERE length(l.line) < 20
    OR l.line NOT IN (SELECT line FROM near) AND (l.doc_id, l.pos, l.line) IN (SELECT (first.doc_id, first.pos, line) FROM d)
  GROUP BY l.doc_id
)
SELECT documents.doc_id, CASE WHEN documents.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM documents LEFT JOIN kept USING (doc_id)
"""


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = topk_products.quantized(embeddings, "vec_id", "embedding", 1024.0)
    return topk_products.top_products(vectors, vectors.where("vec_id % 100 = 0"), 10)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op10_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = weak_quality.score(documents(spark, sf_dir).select("doc_id", "text"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(documents(spark, sf_dir))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), o AS (
  SELECT row, lang, source, unnest(terms) AS term FROM d
), k AS (
  SELECT lang, term, count(*)::BIGINT AS n FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), c AS (
  SELECT o.lang, o.source, o.term, count(*)::BIGINT AS n FROM o SEMI JOIN k ON o.lang = k.lang AND o.term = k.term GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), s AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total,
    coalesce(any_value(l.v), 0)::HUGEINT AS v, coalesce(any_value(l.total), 0)::HUGEINT AS lang_total
  FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source
    LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang) l ON l.lang = g.lang
  GROUP BY g.lang, g.source
), p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.total + 2 * s.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (s.lang_total + 2 * s.v) AS q
  FROM s JOIN k ON s.lang = k.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), best AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q
), r AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM best
)
SELECT lang, source, part, item, value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 10
"""


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    drawn = importance_resampling.resample(documents(spark, sf_dir), target)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: The CRC of each different word comes from a table, byte by byte.
OP12_SQL = r"""
WITH tab AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8),
    lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i::BIGINT) AS c FROM range(256) r(i))
), w AS (
  SELECT doc_id, 'd' AS kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT NULL, 'b', regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), o AS (
  SELECT row, doc_id, kind, unnest(words) AS word FROM (SELECT row_number() OVER () AS row, * FROM w)
), hexed AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM o)
), v AS (
  SELECT word, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket
  FROM hexed, tab
), n AS (
  SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM o JOIN v USING (word) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS g
  FROM n
), f AS (
  SELECT row, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
  FROM o JOIN v USING (word) JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY row
), x AS (
  SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM (SELECT row_number() OVER () AS row, * FROM w) LEFT JOIN f USING (row) WHERE kind = 'd'
), y AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM x
), z AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS eligible FROM y
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank FROM z
"""


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(documents(spark, sf_dir))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_token_files": op3_token_files,
    "op4_mixture_packing": op4_mixture_packing,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_contextual_pii": op6_contextual_pii,
    "op7_line_dedup": op7_line_dedup,
    "op8_top_products": op8_top_products,
    "op9_license_scan": op9_license_scan,
    "op10_weak_quality": op10_weak_quality,
    "op11_source_divergence": op11_source_divergence,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_minhash_dedup": op13_minhash_dedup,
}

ORACLES: dict[str, str] = {
    "op1_source_mixing": OP1_SQL,
    "op7_line_dedup": OP7_SQL,
    "op8_top_products": OP8_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_importance_resampling": OP12_SQL,
}
