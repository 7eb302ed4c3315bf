"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, hard_negatives, language_id, line_crf, merkle_manifest, mixing, multiset_hash, packing, quality_rules, simhash, style_tree, warc_zip
from .common import shared_dir, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (with doc_id; their source stands for a host) and pages (with page_id)."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint"), "text", "lang", "source")
    none = F.lit(None).cast("string")
    rows = docs.select(
        "doc_id", F.lit(None).cast("bigint").alias("page_id"), "text", none.alias("declared"), F.col("source").alias("host"), none.alias("suffix"), none.alias("path_lang")
    ).unionByName(language_id.of_pages(table(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("bigint")))
    found = language_id.identify(rows, language_id.train(docs))
    return found.select("doc_id", "page_id", "lang", "probability", "text_lang", "declared", "host", "suffix")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc_zip.write(table(spark, sf_dir, "pages"), folder)
    return warc_zip.read(manifest, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), default_tokenizer())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(spark, sf_dir, "pages"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = multiset_hash.edited(table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        multiset_hash.as_hex(F.col("fp")).alias("fingerprint"), multiset_hash.as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        multiset_hash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), multiset_hash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    read = chat.read_back(chat.windows(rows))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = F.struct(
        "window", F.size("turns").alias("n"), lines.alias("lines"), F.array_join("targets", "").alias("loss"),
        F.char_length("formatted").alias("chars"),
    )
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(parts)).alias("w"))
    joined = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    total = lambda name: F.aggregate("w", F.lit(0).cast("bigint"), lambda a, x: a + x[name])
    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(joined("lines").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(joined("loss")).cast("bigint").alias("loss_chars"), F.sha2(joined("loss").cast("binary"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = line_crf.train(docs, table(spark, sf_dir, "labels"))
    return line_crf.score(docs, model).select("doc_id", line_crf.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, path).select(
        "row.doc_id", byte_bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(vectors.select("vec_id", "embedding", moved.alias("label")))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle_manifest.of_documents(table(spark, sf_dir, "documents"))
    found = rows.withColumn("folded_root", merkle_manifest.folded(F.col("tampered"), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle_manifest.siblings_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_warc": op2_warc,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_mixing": op5_mixing,
    "op6_html_extraction": op6_html_extraction,
    "op7_fingerprints": op7_fingerprints,
    "op9_chat_formatting": op9_chat_formatting,
    "op8_packing": op8_packing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: SQL for words, and for texts of documents (null: none).
_W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOPS = ", ".join(f"'{x}'" for x in sorted(set(quality_rules.STOP_WORDS)))

ORACLES: dict[str, str] = {
    "op2_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages), h AS (SELECT page_id, octet_length(b) AS n, upper(sha1(b)) AS x, max(page_id) OVER (PARTITION BY b) AS last FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(x, i // 4 * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))) % 32 + 1, 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM h""",
    "op3_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_W} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS r FROM twice, range(5) t(k) GROUP BY doc_id),
m AS (SELECT doc_id, len(w)::BIGINT AS n, length(array_to_string(w, ''))::BIGINT AS wc, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS sy, (len(lines) - len(list_distinct(lines)))::BIGINT AS dl, coalesce(r, 0) AS r,
  len(lines) AS nl, len(list_filter(w, lambda x: x IN ({_STOPS}))) AS st, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS lat, length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) AS beyond, len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS bu, len(list_distinct(w)) AS dw
  FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n < 10 OR 100 * r > 20 * n AS base_failed FROM m)
SELECT doc_id, n AS n_words, wc AS word_chars, sy AS n_symbols, dl AS n_dup_lines, r AS n_repeat_words, base_failed,
  NOT base_failed AND wc / n BETWEEN 1 AND 40 AND sy / n <= 0.3 AND (n < 100 OR beyond > lat OR st / n >= 0.01) AND (n < 100 OR dl / nl <= 0.6) AND (n < 20 OR up / wc <= 0.7) AND (n < 50 OR bu / nl <= 0.9) AND dw / least(n, 10000) >= 0.05 AS kept
FROM b""",
    "op9_chat_formatting": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) t(k)),
t AS (SELECT *, strlen('<|im_start|>' || role || '<|im_end|>') + 2 + strlen(regexp_replace(text, '<(!*)\|', '<!\1|', 'g')) AS tok, length('<|im_start|>' || role || '<|im_end|>') + 2 + length(regexp_replace(text, '<(!*)\|', '<!\1|', 'g')) AS chars,
  row_number() OVER o AS n FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT *, n = 1 AND role = 'system' AS lead, sum(tok) OVER (PARTITION BY conv_id ORDER BY n) AS upto, coalesce(max(tok) FILTER (WHERE n = 1 AND role = 'system') OVER (PARTITION BY conv_id), 0) AS sys FROM t),
p AS (SELECT *, upto - sys AS e, CASE WHEN lead THEN 0 ELSE upto - sys - tok END AS b, greatest(1024 - 128 - sys, 1) AS span FROM s),
k AS (SELECT *, b // span AS k FROM p),
l AS (SELECT *, max(e) OVER x - min(b) OVER x > span AND e > (k + 1) * span AND NOT lead AS last FROM k WINDOW x AS (PARTITION BY conv_id, k)),
w AS (SELECT *, min(n) OVER x AS win, max(n) OVER x AS til, max(e) OVER x AS stop, max(e) OVER x - min(b) OVER x AS held FROM l WINDOW x AS (PARTITION BY conv_id, k, last)),
f AS (SELECT w.*, v.held AS ahead FROM w LEFT JOIN w v ON v.conv_id = w.conv_id AND v.n = w.til + 1)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256, coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (sum(chars) + coalesce(sum(chars) FILTER (WHERE NOT lead AND ahead IS NOT NULL AND stop - b <= least(128, 1024 - sys - ahead)), 0) + coalesce(max(chars) FILTER (WHERE lead), 0) * (count(DISTINCT win) - 1))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id""",
    "op5_mixing": rf"""
WITH d AS (SELECT doc_id, source, len({_W})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS queue FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, list_extract([5.0, 2.0, 1.0]::DOUBLE[], (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS weight FROM d GROUP BY source),
f AS (SELECT *, 2.0::DOUBLE * source_size AS most, 2.0::DOUBLE * source_size / weight AS full_at FROM s),
r AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(most) OVER o - most)) / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level FROM f WINDOW o AS (ORDER BY full_at, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
g AS (SELECT source, source_size, least(most, coalesce(max(level) FILTER (WHERE full_at > level) OVER () * weight, most)) AS target FROM r),
q AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY queue ROWS UNBOUNDED PRECEDING) - size AS before FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (greatest(0, least(size, floor(target) - before)) + greatest(0, least(size, floor(target) - source_size - before)))::BIGINT AS taken,
  CASE WHEN target > 0 THEN (before + size) / target END AS virtual_finish FROM q""",
    "op12_hard_negatives": """
WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.id % 100 = 0 AND b.id <> a.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score QUALIFY rank <= 10""",
    # the tree of sources is the one whose name starts with T; crc32 runs bit by bit over the digits
    "op13_merkle_manifest": r"""
WITH RECURSIVE f AS (SELECT doc_id, source, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR] AS v, text, CASE WHEN list_reduce(list_concat([4294967295::BIGINT], flatten([[(ascii(c) >> b) & 1 FOR b IN range(8)] FOR c IN string_split(doc_id::VARCHAR, '')])),
    lambda s, b: xor(s >> 1, CASE WHEN xor(s, b) & 1 = 1 THEN 3988292384 ELSE 0 END)) & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents),
h AS (SELECT doc_id, source, array_to_string([CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END FOR x IN v], '') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS t, coalesce(strlen(other) || ':' || other, '-') AS o FROM f),
l AS (SELECT doc_id, coalesce('S' || source, 'N') AS g, sha256(head || t) AS leaf, sha256(head || o) AS tampered FROM h),
d AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM l),
up AS (SELECT 0 AS level, g, idx, n, leaf AS node FROM d
  UNION ALL SELECT level + 1, g, idx // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY level, g, idx // 3, n),
sub AS (SELECT g AS tree, node, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, idx, n, node FROM sub
  UNION ALL SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 3, n),
a AS (SELECT level, g, idx, n, node FROM up UNION ALL SELECT level, 'T', idx, n, node FROM top),
side AS (SELECT level, g, idx, coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft, coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM a WHERE n > 1 WINDOW w AS (PARTITION BY level, g, idx // 3 ORDER BY idx)),
walk AS (SELECT doc_id, leaf, g, g AS at, 0 AS level, idx, n, '' AS proof, tampered AS h FROM d
  UNION ALL SELECT w.doc_id, w.leaf, w.g, CASE WHEN s.level IS NULL THEN 'T' ELSE w.at END, CASE WHEN s.level IS NULL THEN 0 ELSE w.level + 1 END, CASE WHEN s.level IS NULL THEN sub.idx ELSE w.idx // 3 END,
    CASE WHEN s.level IS NULL THEN sub.n ELSE (w.n + 2) // 3 END, w.proof || coalesce(s.lft || s.rgt, ''), CASE WHEN s.level IS NULL THEN w.h ELSE sha256(s.lft || w.h || s.rgt) END
  FROM walk w JOIN sub ON sub.tree = w.g LEFT JOIN side s ON s.g = w.at AND s.level = w.level AND s.idx = w.idx WHERE w.at <> 'T' OR w.n > 1)
SELECT doc_id, leaf, sub.node AS subroot, r.node AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = r.node AS verified
FROM walk JOIN sub ON sub.tree = walk.g, (SELECT node FROM top WHERE n = 1) r WHERE walk.at = 'T' AND walk.n = 1""",
}
