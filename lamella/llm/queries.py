"""The queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, debruijn, jaccard, langid, merkle, mixing, packing, rules, simhash, sitebayes, suffixes, topk
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select(F.col("id").alias("doc_id"), langid.held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "rejected")


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.dedup_bytes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n_units").alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.judge(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), *rules.COUNTS, "base_failed", "kept", "char_distance", "word_distance")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


def op7_tool_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no tool turns, so a user's turn is read as a call, the assistant's next turn as its result."""
    return chat.link(chat.dialogue(table(spark, sf_dir, "conversations")), chat.TOOLS)


OP7_SQL = """
WITH t AS (
    SELECT conv_id, turn, role, text, turn // 2 % 2 = 0 AS asks,
        CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
        CASE role WHEN 'user' THEN concat_ws('-', 'call', conv_id, turn) WHEN 'assistant' THEN concat_ws('-', 'call', conv_id, turn - 1) END AS call_id,
        concat_ws('-', 'call', conv_id, turn - 2) AS ref
    FROM conversations
), calls AS (
    SELECT conv_id, call_id, min(turn) AS called, min_by(ref, text) FILTER (NOT asks) AS ref FROM t WHERE kind = 'call' GROUP BY ALL
), placed AS (
    SELECT c.conv_id, c.call_id, c.called, CASE WHEN r.call_id IS NULL THEN 0 ELSE 1 END AS depth, c.ref IS NOT NULL AND r.call_id IS NULL AS unknown
    FROM calls c LEFT JOIN calls r ON c.conv_id = r.conv_id AND c.ref = r.call_id
), u AS (
    SELECT t.*, called, depth, unknown, '"prompt":' || to_json(text)::VARCHAR AS prompt, '"query":' || to_json(text)::VARCHAR AS query
    FROM t LEFT JOIN placed USING (conv_id, call_id)
)
SELECT conv_id, CASE WHEN kind = 'result' THEN coalesce(called, turn) ELSE turn END AS anchor,
    CASE WHEN kind = 'result' THEN 1 ELSE 0 END AS step, depth::INT AS depth, turn, role, kind, call_id,
    CASE kind WHEN 'call' THEN CASE
            WHEN text IS NULL THEN CASE WHEN asks THEN 'missing:query' ELSE 'missing:prompt' END
            WHEN asks AND length(text) % 5 = 0 THEN 'type:limit' WHEN unknown THEN 'unknown_ref' ELSE 'ok' END
        WHEN 'result' THEN CASE WHEN called IS NULL THEN 'orphan' ELSE 'linked' END ELSE 'ok' END AS status,
    '{' || concat_ws(',',
        CASE WHEN kind = 'call' AND asks THEN '"arguments":{' || coalesce('"limit":' || CASE WHEN length(text) % 5 = 0 THEN '"' || length(text) || '"' ELSE length(text)::VARCHAR END || ',' || query, '') || '}'
            WHEN kind = 'call' THEN '"arguments":{' || concat_ws(',', '"after":{"$ref":"' || ref || '"}', prompt) || '}' END,
        '"call_id":' || to_json(call_id)::VARCHAR,
        CASE WHEN kind <> 'call' THEN '"content":' || to_json(text)::VARCHAR END,
        '"kind":' || to_json(kind)::VARCHAR, '"role":' || to_json(role)::VARCHAR,
        CASE WHEN kind = 'call' THEN CASE WHEN asks THEN '"tool":"search"' ELSE '"tool":"reply"' END END) || '}' AS line
FROM u
"""


def op8_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = debruijn.dedup_words(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times")


def op10_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitebayes.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "quality_score", "toxic_score", "kept")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document by the CRC of its id is altered after the manifest was made: its text is lower-cased."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    altered = merkle.leaf(*[merkle.lowered(F.col(c)) if c == "text" else F.col(c) for c in merkle.COLUMNS])
    found = merkle.manifest(table(spark, sf_dir, "documents"), altered=F.when(chosen, altered))
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root")
    out = found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), folded)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


OP11_SQL = """
WITH RECURSIVE d AS (
    SELECT doc_id, lang, list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text], lambda v: coalesce(strlen(v) || ':' || v, '-')) AS f,
        -- CRC-32, bit by bit
        list_reduce(
            list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT),
            lambda crc, byte: list_reduce(range(8)::BIGINT[], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)),
            4294967295::BIGINT
        ) AS crc
    FROM documents
), leaves AS (
    SELECT doc_id, lang, sha256(array_to_string(f, '')) AS leaf, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
        CASE WHEN xor(crc, 4294967295) % 3 = 0
            THEN sha256(array_to_string(f[:4], '') || coalesce(split_part(f[5], ':', 1) || ':' || translate(f[5][strpos(f[5], ':') + 1:], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
            ELSE leaf END AS shown
    FROM d
), lower_level AS (
    SELECT 0 AS level, lang, idx, n, leaf AS hash FROM leaves
    UNION ALL
    SELECT level + 1, lang, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM lower_level WHERE n > 1 GROUP BY level, lang, idx // 8, n
), subroots AS (
    SELECT lang, hash AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM lower_level WHERE n = 1
), upper_level AS (
    SELECT 0 AS level, idx, n, subroot AS hash FROM subroots
    UNION ALL
    SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM upper_level WHERE n > 1 GROUP BY level, idx // 8, n
), lower_step AS (
    SELECT level, lang, idx, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM lower_level WHERE n > 1 WINDOW w AS (PARTITION BY level, lang, idx // 8 ORDER BY idx)
), upper_step AS (
    SELECT level, idx, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM upper_level WHERE n > 1 WINDOW w AS (PARTITION BY level, idx // 8 ORDER BY idx)
), steps AS (
    SELECT a.lang, a.idx, s.level, s.l, s.r FROM leaves a JOIN lower_step s ON a.lang IS NOT DISTINCT FROM s.lang AND s.idx = a.idx // (8 ** s.level)::BIGINT
    UNION ALL
    SELECT a.lang, a.idx, u.height + s.level, s.l, s.r
    FROM leaves a JOIN subroots u ON a.lang IS NOT DISTINCT FROM u.lang JOIN upper_step s ON s.idx = u.idx // (8 ** s.level)::BIGINT
), paths AS (
    SELECT lang, idx, list({'l': l, 'r': r} ORDER BY level) AS path FROM steps GROUP BY lang, idx
), folded AS (
    SELECT a.doc_id, a.leaf, u.subroot, top.hash AS root, sha256(coalesce(array_to_string(list_transform(p.path, lambda s: s.l || s.r), ''), '')) AS proof_sha256,
        CASE WHEN p.path IS NULL THEN a.shown
            ELSE list_reduce(list_transform(p.path, lambda s: {'l': s.l, 'h': NULL::VARCHAR, 'r': s.r}), lambda acc, s: {'l': '', 'h': sha256(s.l || acc.h || s.r), 'r': ''}, {'l': '', 'h': a.shown, 'r': ''}).h END AS folded_root
    FROM leaves a LEFT JOIN paths p ON a.lang IS NOT DISTINCT FROM p.lang AND a.idx = p.idx
    JOIN subroots u ON a.lang IS NOT DISTINCT FROM u.lang JOIN upper_level top ON top.n = 1
)
SELECT *, folded_root = root AS verified FROM folded
"""


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_sets(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


QUERIES = {
    f.__name__: f
    for f in (op1_simhash, op2_best_fit, op3_subword_language, op4_suffix_array, op5_divergence_rules, op6_exact_top_k, op7_tool_linking, op8_de_bruijn, op9_weighted_mix, op10_site_bayes, op11_merkle_manifest, op12_ngram_join)
}
ORACLES = {"op6_exact_top_k": OP6_SQL, "op7_tool_linking": OP7_SQL, "op11_merkle_manifest": OP11_SQL}
