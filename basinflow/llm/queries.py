"""The ``opN_*`` queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, jaccard, packing, piece_scan, pii, quality, sharding, suffix_dedup, toxicity, warc
from .common import shared_dir, table


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *tokenizer_files())


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_scan.encoding_digest(piece_scan.encode_documents(table(spark, sf_dir, "documents"), path), path)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/archive"
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.archive_digest(spark, path)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of op1 alone, which SQL can express."""
    return op1_quality(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def sharding_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of the largest shard of op2, and of all."""
    shards = op2_sharding(spark, sf_dir).groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    return shards.agg(F.max("bytes").alias("largest"), F.sum("bytes").alias("total"), F.sum("n").alias("n"))


def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of op3's base spans."""
    return op3_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_sharding, op3_pii, op4_packing, op5_repeats, op6_toxicity, op7_nearest, op8_pieces, op9_warc, op10_jaccard, quality_counts, sharding_balance, pii_counts)}


NEAREST = """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM pairs)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 20"""

BASE32_SQL = " || ".join(
    f"substr('{warc.BASE32}', ((('0x' || substr(h, {1 + 5 * i}, 5))::INT >> {s}) & 31) + 1, 1)" for i in range(8) for s in (15, 10, 5, 0)
)
WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(body) AS payload_bytes, {BASE32_SQL} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> first THEN first END AS refers_to FROM p"""

JACCARD = """WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM words UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.component_id FROM words d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)"""


#: All windows of 400 bytes, as 800 hex digits; whole tables of a few MB take it.
REPEATS = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT r, p, md5(substr(h, 2 * p + 1, 800)) AS k FROM (SELECT r, h, unnest(range(n - 399)) AS p FROM d)),
dup AS (SELECT r, p FROM w JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)),
marked AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 0 ELSE 1 END AS new FROM dup),
runs AS (SELECT r, min(p) AS s, max(p) + 400 AS e FROM (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS g FROM marked) GROUP BY r, g),
gaps AS (SELECT r, lag(e, 1, 0) OVER (PARTITION BY r ORDER BY s) AS a, s AS b FROM runs UNION ALL SELECT d.r, coalesce(max(e), 0), any_value(n) FROM d LEFT JOIN runs USING (r) GROUP BY d.r),
kept AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS t FROM gaps JOIN d USING (r) GROUP BY r),
sums AS (SELECT r, sum(e - s)::BIGINT AS removed, count(*) AS n FROM runs GROUP BY r)
SELECT doc_id, d.n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(sums.n, 0) AS n_spans, sha256(unhex(t)) AS kept_sha256 FROM d JOIN kept USING (r) LEFT JOIN sums USING (r)"""


QUALITY = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
windows AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
twice AS (SELECT r, i FROM windows JOIN (SELECT r, k FROM windows GROUP BY r, k HAVING count(*) > 1) USING (r, k)),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, range(5) AS s(j) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
 coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words FROM w LEFT JOIN covered USING (r) LEFT JOIN lines USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c"""

#: Groups of equal texts in the order of their digests; the smallest capacity is searched bit by bit, filling one shard a step.
BALANCE = """WITH RECURSIVE g AS (SELECT ('0x' || substr(sha256(coalesce(text, '')), 1, 15))::BIGINT AS k, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS s FROM documents GROUP BY 1),
p AS (SELECT sum(s) OVER (ORDER BY k)::BIGINT AS e FROM g), t AS (SELECT max(e) AS total FROM p),
f AS (SELECT 1::BIGINT AS lo, total AS hi, 0 AS used, 0::BIGINT AS pos, false AS ready FROM t UNION ALL
 SELECT CASE WHEN used = 8 AND pos < total THEN (lo + hi) // 2 + 1 ELSE lo END, CASE WHEN pos = total THEN (lo + hi) // 2 ELSE hi END,
  CASE WHEN used = 8 OR pos = total THEN 0 ELSE used + 1 END,
  CASE WHEN used = 8 OR pos = total THEN 0 ELSE coalesce((SELECT max(e) FROM p WHERE e <= f.pos + (f.lo + f.hi) // 2), 0) END, lo = hi
 FROM f, t WHERE lo < hi)
SELECT (SELECT min(hi) FROM f WHERE lo = hi) AS largest, total::BIGINT AS total, (SELECT count(*) FROM documents) AS n FROM t"""

DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
LUHN = f"list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN reverse({DIGITS})[i]::INT ELSE (reverse({DIGITS})[i]::INT * 2) // 10 + (reverse({DIGITS})[i]::INT * 2) % 10 END)) % 10 = 0"
PII = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, len(regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+')) AS n_email,
 len(list_filter(regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), lambda m: list_max(list_transform(string_split(m, '.'), lambda x: x::DOUBLE)) <= 255)) AS n_ip,
 len(list_filter(regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), lambda m: length({DIGITS}) BETWEEN 12 AND 19 AND {LUHN})) AS n_card,
 len(list_filter(regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: length({DIGITS}) BETWEEN 9 AND 15)) AS n_phone FROM d"""


def oracle_sql() -> dict[str, str]:
    return {"quality_counts": QUALITY, "sharding_balance": BALANCE, "pii_counts": PII, "op5_repeats": REPEATS, "op7_nearest": NEAREST, "op9_warc": WARC, "op10_jaccard": JACCARD}
