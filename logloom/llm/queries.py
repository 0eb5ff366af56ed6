"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from logloom.llm import (
    embed_dedup, fingerprint, hard_negatives, line_dedup, merkle, minhash, mixing, piece_fst, quality, sharding, substring_dedup, token_files,
    warc,
)
from logloom.scratch import Scratch


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tokenizer(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), Scratch(spark))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return piece_fst.encode_texts(_table(spark, folder, "documents"), model_path=_tokenizer("piece_bpe_32k.model"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, folder, "documents"), Scratch(spark))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_files.write_token_files(
        _table(spark, folder, "documents"), Scratch(spark), tokenizer_path=_tokenizer("byte_bpe_50k.json"), end_id=2
    )
    return token_files.read_token_files(manifest)


def op6_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dedup.near_vectors(_table(spark, folder, "embeddings"), Scratch(spark))


def op7_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, folder, "documents"), Scratch(spark))


def op8_passages(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, folder, "documents"), Scratch(spark))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, folder, "documents"), Scratch(spark), labels=_table(spark, folder, "labels"))
    return mixed.drop("digest", "times")


def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.repeated_lines(_table(spark, folder, "documents"), Scratch(spark))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc.capture_index(_table(spark, folder, "pages"), Scratch(spark))
    names = "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position"
    return captures.select(F.col("id").alias("page_id"), *names)


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    now = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.merkle_manifest(docs, Scratch(spark), now={"text": now})


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, Scratch(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash": op1_minhash,
        "op2_quality": op2_quality,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_sharding": op4_sharding,
        "op5_token_files": op5_token_files,
        "op6_embeddings": op6_embeddings,
        "op7_fingerprint": op7_fingerprint,
        "op8_passages": op8_passages,
        "op9_mixing": op9_mixing,
        "op10_lines": op10_lines,
        "op11_warc": op11_warc,
        "op12_merkle": op12_merkle,
        "op13_hard_negatives": op13_hard_negatives,
    }


# Documents linked by exact sets of shingles; ids reached through links of links.
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM shared JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
    WHERE 100 * shared.n >= 75 * (sx.n + sy.n - shared.n)),
reached AS (
    SELECT x, y FROM links
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles,
       least(d.doc_id, coalesce(l.y, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(l.y, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lowest l ON l.x = d.doc_id
"""


# Targets stopped at three times a source's size; whole rounds, then documents by key up to the rest.
MIXED = r"""
WITH quality AS (SELECT doc_id, max(quality) AS label FROM labels GROUP BY doc_id),
sized AS (
    SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS size,
           CAST('0x' || substr(md5(concat_ws('|', 'mix', CAST(d.doc_id AS VARCHAR), md5(d.text))), 1, 12) AS BIGINT) AS drawn,
           CASE q.label WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS weight
    FROM documents d LEFT JOIN quality q USING (doc_id)),
keyed AS (SELECT *, -ln((drawn + 0.5::DOUBLE) / 281474976710656.0::DOUBLE) / weight AS key FROM sized),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight
    FROM keyed GROUP BY source),
limits AS (
    SELECT *, 3.0::DOUBLE * source_size AS stop,
           sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0) AS left_words,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
    FROM sources
    WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (
    SELECT arg_max(left_words, left_weight) AS words, max(left_weight) AS share
    FROM limits WHERE left_words * weight < stop * left_weight),
targets AS (
    SELECT l.source, l.source_size,
           CASE WHEN left_words * weight >= stop * left_weight THEN stop ELSE words * weight / share END AS target
    FROM limits l CROSS JOIN shared),
plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds FROM targets),
reach AS (
    SELECT k.doc_id, k.size, p.source_size, p.target, p.rounds, p.target - p.rounds * p.source_size AS rest,
           sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.drawn, k.doc_id, k.size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS reach
    FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (rounds + CASE WHEN 2 * reach - size <= 2 * rest AND reach - size <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM reach
"""


# Vectors linked by cosine; ids reached through links of links.
NEAR_VECTORS = r"""
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reached AS (
    SELECT x, y FROM links
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS y FROM reached GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(l.y, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(l.y, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON c.x = e.vec_id LEFT JOIN lowest l ON l.x = e.vec_id
"""


# The first page of every payload; the key turns the host's labels round.
ARCHIVED = r"""
WITH read AS (
    SELECT page_id, coalesce(html, '') AS payload, lower(trim(url)) AS url FROM pages),
parts AS (
    SELECT *, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
           regexp_extract(url, '^[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)(\?[^#]*)?', ['host', 'path', 'query']) AS u
    FROM read),
keyed AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload) AS first,
           array_to_string(list_reverse(string_split(regexp_replace(regexp_replace(u.host, '^www\.', ''), ':(80|443)$', ''), '.')), ',')
               || ')' || CASE WHEN u.path = '' THEN '/' ELSE u.path END || CASE WHEN u.query = '?' THEN '' ELSE u.query END AS url_key
    FROM parts)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to,
       url_key, row_number() OVER (ORDER BY url_key, page_id) - 1 AS position
FROM keyed
"""


# Hash trees of three by levels, per source and above the sources; every leaf climbs both. crc32 bit by bit for its last bit.
MERKLE = r"""
WITH RECURSIVE hashed AS (
    SELECT *, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda a, x:
            list_reduce(range(8), lambda b, i: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END, xor(a, x)),
            4294967295) & 1 = 1 AS changed,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
        replace(text, chr(10), '') AS cut
    FROM documents),
leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || CASE WHEN changed THEN coalesce(strlen(cut) || ':' || cut, '-')
                               ELSE coalesce(strlen(text) || ':' || text, '-') END) AS folded
    FROM hashed),
sources AS (
    SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves GROUP BY source),
placed AS (
    SELECT l.*, s.tree, s.n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, folded) - 1 AS pos,
           row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf, folded) AS rid
    FROM leaves l JOIN sources s ON l.source IS NOT DISTINCT FROM s.source),
lower_nodes AS (
    SELECT tree, 0 AS level, pos, n, leaf AS hash FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
    FROM lower_nodes WHERE n > 1 GROUP BY tree, level, n, pos // 3),
subroots AS (SELECT tree, hash FROM lower_nodes WHERE n = 1),
upper_nodes AS (
    SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, hash FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
    FROM upper_nodes WHERE n > 1 GROUP BY level, n, pos // 3),
climb AS (
    SELECT rid, tree, 0 AS level, pos, n, folded, '' AS proof FROM placed
    UNION ALL
    SELECT c.rid, c.tree, c.level + 1, c.pos // 3, (c.n + 2) // 3,
           sha256(string_agg(CASE WHEN s.pos = c.pos THEN c.folded ELSE s.hash END, '' ORDER BY s.pos)),
           c.proof || coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos <> c.pos), '')
    FROM climb c JOIN lower_nodes s ON s.tree = c.tree AND s.level = c.level AND s.pos // 3 = c.pos // 3
    WHERE c.n > 1 GROUP BY c.rid, c.tree, c.level, c.pos, c.n, c.proof),
higher AS (
    SELECT rid, 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, folded, proof FROM climb WHERE n = 1
    UNION ALL
    SELECT c.rid, c.level + 1, c.pos // 3, (c.n + 2) // 3,
           sha256(string_agg(CASE WHEN s.pos = c.pos THEN c.folded ELSE s.hash END, '' ORDER BY s.pos)),
           c.proof || coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos <> c.pos), '')
    FROM higher c JOIN upper_nodes s ON s.level = c.level AND s.pos // 3 = c.pos // 3
    WHERE c.n > 1 GROUP BY c.rid, c.level, c.pos, c.n, c.proof),
root AS (SELECT hash FROM upper_nodes WHERE n = 1)
SELECT p.doc_id, p.leaf, s.hash AS subroot, r.hash AS root, sha256(h.proof) AS proof_sha256, h.folded AS folded_root,
       h.folded = r.hash AS verified
FROM placed p JOIN subroots s USING (tree) JOIN higher h ON h.rid = p.rid AND h.n = 1 CROSS JOIN root r
"""


# Scores of the anchors with all rows; positives by rank, then the negatives within reach of each by rank.
HARD_NEGATIVES = r"""
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER near::INTEGER AS rank, s.vec_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
WINDOW near AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER near <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash": NEAR_DUPLICATES,
        "op6_embeddings": NEAR_VECTORS,
        "op9_mixing": MIXED,
        "op11_warc": ARCHIVED,
        "op12_merkle": MERKLE,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
