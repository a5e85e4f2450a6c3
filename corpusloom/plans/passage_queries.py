"""Queries for passages: hits with places, spans, snippets, pages, blocks and listing markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as rules
from ..operators import passages
from .registry import query, table

PATTERNS = {"mean": r"\bthe\b", "number": "[0-9]{3}", "time": r"(?i)\b(?:time|year|day)s?\b"}
_HITS = "n AS (" + " UNION ALL ".join(
    f"""SELECT doc_id, '{k}' AS name, unnest(regexp_extract_all(text, '{p}')) AS hit, unnest(list_slice(string_split_regex(text, '{p}'), 1, -2)) AS gap, generate_subscripts(regexp_extract_all(text, '{p}'), 1) AS k FROM documents WHERE regexp_matches(text, '{p}')"""
    for k, p in PATTERNS.items()
) + """), hits AS (SELECT doc_id, name, hit, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, name ORDER BY k) - length(hit) AS BIGINT) AS start FROM n)"""
#: As Spark sees them.
BOUNDED = {k: rules.ascii_bounds(p) for k, p in PATTERNS.items()}


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


@query(f'WITH {_HITS} SELECT doc_id, name, hit, start, start + length(hit) AS "end" FROM hits')
def keyword_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hit of every keyword pattern with its place in the text."""
    return passages.hits(_docs(spark, sf_dir), "doc_id", "text", BOUNDED)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents), k AS (SELECT * FROM l WHERE length(t) >= 50),
 m AS (SELECT doc_id, line, 'mean' AS name, unnest(regexp_extract_all(t, '\\bthe\\b')) AS hit FROM k UNION ALL SELECT doc_id, line, 'number', unnest(regexp_extract_all(t, '[0-9]{3}')) FROM k)
SELECT doc_id, line, name, count(*) AS hits FROM m GROUP BY ALL""")
def candidate_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 50 characters or more with a row for each pattern that hits, and how often."""
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t")).where(F.length("t") >= 50)
    counts = F.array(*[F.struct(F.lit(k).alias("name"), F.regexp_count("t", F.lit(BOUNDED[k])).cast("long").alias("hits")) for k in ("mean", "number")])
    return lines.select("doc_id", F.col("line").cast("long").alias("line"), F.inline(counts)).where("hits > 0")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents) SELECT doc_id, count(*) AS spans, count(*) FILTER (WHERE length(t) >= 50) AS long_spans, count(*) FILTER (WHERE length(t) >= 50 AND regexp_matches(t, '\\bthe\\b')) AS candidates FROM l GROUP BY doc_id""")
def span_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _docs(spark, sf_dir).select("doc_id", F.explode(F.split("text", "\n")).alias("t"))
    long = F.length("t") >= 50
    return lines.groupBy("doc_id").agg(F.count("*").alias("spans"), F.count_if(long).alias("long_spans"), F.count_if(long & F.regexp_like("t", F.lit(BOUNDED["mean"]))).alias("candidates"))


@query("""WITH p AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?][ \\n]')) AS s, generate_subscripts(string_split_regex(text, '[.!?][ \\n]'), 1) AS k FROM documents),
 w AS (SELECT *, CAST(sum(length(s) + 2) OVER (PARTITION BY doc_id ORDER BY k) - length(s) - 2 AS BIGINT) AS start FROM p) SELECT doc_id, start, start + length(s) AS "end" FROM w WHERE regexp_matches(s, '[0-9]{3}')""")
def hit_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword hits widened to the bounds of their sentences."""
    return passages.sentences_with(_docs(spark, sf_dir), "doc_id", "text", BOUNDED["number"])


@query("SELECT doc_id, left(text, 500) AS snippet, left(replace(replace(text, chr(13), ' '), chr(10), ' '), 160) AS preview FROM documents")
def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snippet of 500 characters and a preview of 160 on one line (the feature's own lengths)."""
    return _docs(spark, sf_dir).select("doc_id", F.left("text", F.lit(500)).alias("snippet"), F.left(F.translate("text", "\r\n", "  "), F.lit(160)).alias("preview"))


@query("""SELECT conv_id, md5(string_agg(trim(regexp_replace('![p' || turn || '](img.png) ' || coalesce(text, ''), '!\\[[^\\]]*\\]\\([^)]*\\)', '', 'g'), ' '), chr(10) || chr(10) ORDER BY turn, text)) AS digest, count(*) AS pages FROM conversations GROUP BY conv_id""")
def stitched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without image markup, joined in order (a conversation's turns stand for pages)."""
    image = F.concat(F.lit("![p"), F.col("turn").cast("string"), F.lit("](img.png) "), F.coalesce("text", F.lit("")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.trim(F.regexp_replace(image, r"!\[[^\]]*\]\([^)]*\)", "")).alias("page"))
    pages = F.array_sort(F.collect_list(F.struct("turn", "text", "page")))
    return rows.groupBy("conv_id").agg(F.md5(F.array_join(F.transform(pages, lambda p: p["page"]), "\n\n")).alias("digest"), F.count("*").alias("pages"))


@query("SELECT doc_id, len(string_split(text, chr(10))) AS blocks, TRUE AS same FROM documents WHERE text IS NOT NULL")
def block_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut into numbered blocks and put together again from their rows."""
    rows = _docs(spark, sf_dir).where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("hash"))
    blocks = rows.select("doc_id", "hash", F.posexplode(F.split("text", "\n")).alias("k", "t"))
    back = blocks.groupBy("doc_id", "hash").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda b: b["t"]), "\n").alias("text"), F.count("*").alias("blocks"))
    return back.select("doc_id", "blocks", (F.xxhash64("text") == F.col("hash")).alias("same"))


@query("""WITH r AS (SELECT *, o_orderkey || '|' || o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN '|' || o_orderpriority ELSE '' END AS payload FROM orders) SELECT o_orderkey AS pk, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS priority FROM r""")
def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scraped from listing markup whose payload is joined by pipes and padded to three fields."""
    payload = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(F.collect_list(payload), lambda p: F.concat(F.lit('<li data-row="'), p, F.lit('">x</li>'))), "").alias("html"))
    found = rows.select(F.explode(F.regexp_extract_all("html", F.lit(r'<li data-row="([^"]*)">'), F.lit(1))).alias("p"))
    part = lambda i: F.coalesce(F.get(F.split("p", r"\|"), F.lit(i)), F.lit(""))
    return found.select(part(0).cast("long").alias("pk"), part(1).alias("status"), part(2).alias("priority"))


@query(r"""SELECT item_id, trim(regexp_replace(text, '[ \t\r\n\f]+', ' ', 'g'), ' ') AS collapsed, len(list_filter(string_split_regex(text, '\n[ \t]*\n'), lambda p: trim(p) <> '')) AS paragraphs,
 CAST(contains(lower(text), 'the') AS INTEGER) + CAST(contains(lower(text), 'and') AS INTEGER) AS terms FROM benchmark WHERE text IS NOT NULL""")
def text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White space collapsed, paragraphs, and how many of some terms a text holds."""
    text = F.col("text")
    return table(spark, sf_dir, "benchmark").where("text is not null").select("item_id", rules.collapse_space(text).alias("collapsed"), F.size(rules.paragraphs(text)).cast("long").alias("paragraphs"), rules.term_hits(text, ["The", "and"]).alias("terms"))


@query(r"""WITH r AS (SELECT item_id, text AS before, CASE item_id % 3 WHEN 0 THEN text WHEN 1 THEN text || ' 7' ELSE regexp_replace(text, '\b[A-Z][a-z]+\b', 'x', 'g') END AS after FROM benchmark WHERE text IS NOT NULL),
 n AS (SELECT *, list_distinct(regexp_extract_all(before, '\b[A-Z][a-z]+\b')) AS names, regexp_extract_all(after, '\b[A-Z][a-z]+\b') AS kept FROM r)
SELECT item_id, regexp_extract_all(before, '[0-9]+(?:[.,][0-9]+)*') = regexp_extract_all(after, '[0-9]+(?:[.,][0-9]+)*') AND (len(names) = 0 OR len(list_intersect(names, kept)) / greatest(len(names), 1) >= 0.6) AS accepted FROM n""")
def repair_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of texts (none, one with a new number, one without capitalised words) by whether they may stand."""
    k, text = F.col("item_id") % 3, F.col("text")
    after = F.when(k == 0, text).when(k == 1, F.concat(text, F.lit(" 7"))).otherwise(F.regexp_replace(text, r"\b[A-Z][a-z]+\b", "x"))
    return table(spark, sf_dir, "benchmark").where("text is not null").select("item_id", rules.repair_accepted(text, after).alias("accepted"))
