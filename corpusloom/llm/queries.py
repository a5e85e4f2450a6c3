"""The queries of the thirteen operators and of the pipeline, by name, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, byte_bpe, conversations, fingerprint, html_extract, jaccard_join, language_model, mixing, packing, quality, sharding, warc, yinyang


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_jaccard_join": jaccard_join.op1_jaccard_join,
        "op2_warc_normalise": warc.op2_warc_normalise,
        "op3_maxent_score": language_model.op3_maxent_score,
        "op4_ann_multiprobe": ann.op4_ann_multiprobe,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_pack_complement": packing.op6_pack_complement,
        "op7_html_difference": html_extract.op7_html_difference,
        "op8_minhash_fingerprint": fingerprint.op8_minhash_fingerprint,
        "op9_quality_gam": quality.op9_quality_gam,
        "op10_shard_minimax": sharding.op10_shard_minimax,
        "op11_yinyang_clusters": yinyang.op11_yinyang_clusters,
        "op12_byte_bpe": byte_bpe.op12_byte_bpe,
        "op13_repair_conversations": conversations.op13_repair_conversations,
        "pipeline": _pipeline,
    }


#: Words and 5-word shingles of whole texts, links by inverted shingle lists, components by reachability.
JACCARD_SQL = r"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
 s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
 e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
 l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
 r AS (SELECT a AS doc_id, b AS other FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other),
 c AS (SELECT doc_id, min(other) AS low FROM r GROUP BY doc_id),
 k AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(sh)) AS low FROM s WHERE len(sh) > 0)
SELECT s.doc_id, len(sh) AS n_shingles, least(s.doc_id, coalesce(c.low, s.doc_id)) AS component_id, coalesce(k.low, s.doc_id) AS class_id FROM s LEFT JOIN c ON c.doc_id = s.doc_id LEFT JOIN k ON k.doc_id = s.doc_id"""

WARC_SQL = """WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, url, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
 f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, url, payload_bytes, payload_digest, CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""


def oracle_sql() -> dict[str, str]:
    """For the operators whose rows SQL can express; the others are tested against plain versions."""
    return {"op1_jaccard_join": JACCARD_SQL, "op2_warc_normalise": WARC_SQL, "op5_mix_sources": mixing.SQL, "op11_yinyang_clusters": yinyang.SQL, "op13_repair_conversations": conversations.SQL}
