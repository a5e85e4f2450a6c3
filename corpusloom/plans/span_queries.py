"""Queries for spans and parts of texts: stitching, sections, Markdown, packing, malformed documents and combined similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as rules
from ..operators import chunking, lookup, passages
from .registry import query, table

PATTERNS = {"number": "[0-9]{3}", "time": rules.ascii_bounds(r"(?i)\b(?:time|year|day)s?\b")}
HEADINGS = ("1. Principal risks  and uncertainties", "2.1 notes to the financial statements", "Strategic Report", "Chair's letter", "Our Directors report", "Risk  review and business review")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text").where("text is not null")


@query(r"""WITH p AS (SELECT conv_id, turn, list_filter(list_transform(string_split(text, ' '), lambda x: trim(x, ' ')), lambda x: x <> '') AS ps FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, turn, translate(list_reduce(ps, lambda d, x: d || CASE WHEN d = '' OR (regexp_matches(d, '\p{Nd}$') AND regexp_matches(x, '^\p{Nd}')) OR (regexp_matches(d, '\p{L}$') AND regexp_matches(x, '^\p{L}') AND (
   length(string_split(d, chr(1))[-1]) <= 3 OR length(x) <= 3 OR (lower(string_split(d, chr(1))[-1]) = string_split(d, chr(1))[-1] AND lower(x) = x AND length(x) <= 4))) THEN '' ELSE chr(1) END || x, ''), chr(1), ' ') AS text FROM p""")
def stitched_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of turns put together where two look like one cut word."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").where("text is not null")
    return rows.select("conv_id", "turn", rules.stitched(F.split("text", " ")).alias("text"))


_FOUND = " ".join(f"WHEN regexp_matches(lower(h), '{p.replace(chr(39), chr(39) * 2)}') THEN regexp_extract(lower(h), '{p.replace(chr(39), chr(39) * 2)}')" for p in rules.SECTION_PATTERNS)
_HEADINGS_SQL = "[" + ", ".join("'" + h.replace("'", "''") + "'" for h in HEADINGS) + "]"


@query(rf"""WITH t AS (SELECT o_orderkey AS report, {_HEADINGS_SQL}[1 + o_orderkey % 6] AS h FROM orders), s AS (SELECT *, replace(CASE {_FOUND} END, ' ', '_') AS section, trim(regexp_replace(regexp_replace(h, '^[0-9]+\.([0-9]+\.?)?\s+', ''), '\s+', ' ', 'g')) AS bare FROM t)
SELECT report, section, CASE WHEN section IS NOT NULL THEN array_to_string(list_transform(string_split(bare, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS title FROM s""")
def section_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section that each heading names, as a key and as a title."""
    heading = F.element_at(F.array(*[F.lit(h) for h in HEADINGS]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("report"), heading.alias("h"))
    return rows.select("report", rules.section_of(F.col("h")).alias("section"), rules.section_title(F.col("h")).alias("title"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents WHERE text IS NOT NULL),
 p AS (SELECT doc_id, k, CASE WHEN k % 4 = 0 THEN CASE WHEN k % 8 = 0 THEN chr(10) || '# ' ELSE chr(10) || '## ' END || t || chr(10) WHEN trim(regexp_replace(t, '\s+', ' ', 'g')) <> '' THEN trim(regexp_replace(t, '\s+', ' ', 'g')) || chr(10) END AS part FROM l)
SELECT doc_id, coalesce(string_agg(part, chr(10) ORDER BY k), '') AS markdown FROM p GROUP BY doc_id""")
def spans_as_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as spans: every fourth is a heading, of 18 or 12 points in turn."""
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "text"))
    spans = lines.withColumns({"heading": F.col("k") % 4 == 0, "size": F.when(F.col("k") % 8 == 0, 18).when(F.col("k") % 4 == 0, 12)})
    return passages.markdown(spans, "doc_id", "k")


def _packed_sql(units: str) -> str:
    return f"""WITH RECURSIVE u AS ({units}), r AS (SELECT doc_id, k, s, 0 AS part, length(s) + 1 AS n FROM u WHERE k = 1 UNION ALL
 SELECT u.doc_id, u.k, u.s, CASE WHEN r.n + length(u.s) > 400 THEN r.part + 1 ELSE r.part END, CASE WHEN r.n + length(u.s) > 400 THEN length(u.s) + 1 ELSE r.n + length(u.s) + 1 END FROM r JOIN u ON u.doc_id = r.doc_id AND u.k = r.k + 1)
SELECT doc_id, CAST(part AS INTEGER) AS part, string_agg(s, ' ' ORDER BY k) AS text FROM r GROUP BY doc_id, part"""


_SENTENCES_SQL = r"""SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS k FROM (SELECT doc_id, trim(unnest(x), chr(32) || chr(9) || chr(10) || chr(13)) AS s, generate_subscripts(x, 1) AS j
  FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS x FROM documents WHERE trim(text, chr(32) || chr(9) || chr(10) || chr(13)) <> '')) WHERE s <> ''"""


@query(_packed_sql(_SENTENCES_SQL))
def packed_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences packed to at most 400 characters."""
    return chunking.split_chars(_docs(spark, sf_dir), 400, by="sentence").where("text <> ''")


@query()
def packed_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs (each line is one) packed to at most 400 characters, longer ones by their sentences."""
    return chunking.split_chars(_docs(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n"))), 400).where("text <> ''")


@query(r"""WITH d AS (SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents WHERE text IS NOT NULL), pieces AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?] ')) AS s, generate_subscripts(string_split_regex(text, '[.!?] '), 1) AS k FROM d),
 marks AS (SELECT * FROM (SELECT doc_id, k, sum(length(s) + 2) OVER (PARTITION BY doc_id ORDER BY k) AS after, max(k) OVER (PARTITION BY doc_id) AS n FROM pieces) WHERE k < n),
 raw AS (SELECT doc_id, name, unnest(regexp_extract_all(text, p)) AS hit, unnest(list_slice(string_split_regex(text, p), 1, -2)) AS gap, generate_subscripts(regexp_extract_all(text, p), 1) AS k FROM d, (VALUES ('number', '[0-9]{3}'), ('time', '(?i)\b(?:time|year|day)s?\b')) v(name, p) WHERE regexp_matches(text, p)),
 hits AS (SELECT doc_id, name, length(hit) AS size, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, name ORDER BY k) AS stop FROM raw),
 seeds AS (SELECT hits.doc_id, name, stop - size AS start, stop, greatest(stop - size - 1200, 0) AS low, least(stop + 1200, length(text)) AS high, length(text) AS n FROM hits JOIN d USING (doc_id)),
 snapped AS (SELECT s.doc_id, s.name, s.start, s.stop, CASE WHEN low = 0 THEN 0 ELSE coalesce(max(after) FILTER (WHERE after <= low), 0) END AS lo, CASE WHEN high >= s.n THEN s.n ELSE coalesce(min(after) FILTER (WHERE after - 2 >= high), s.n) END AS hi FROM seeds s LEFT JOIN marks m ON m.doc_id = s.doc_id GROUP BY s.doc_id, s.name, s.start, s.stop, s.low, s.high, s.n),
 isle AS (SELECT *, CASE WHEN lo < max(hi) OVER (PARTITION BY doc_id ORDER BY start, stop, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM snapped),
 numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start, stop, name ROWS UNBOUNDED PRECEDING) AS i FROM isle),
 merged AS (SELECT doc_id, i, CAST(min(lo) AS BIGINT) AS start, CAST(max(hi) AS BIGINT) AS stop, list_sort(list(DISTINCT name)) AS names FROM numbered GROUP BY doc_id, i)
SELECT doc_id, start, stop, array_to_string(names, ',') AS keywords, trim(substr(text, start + 1, stop - start), ' ') AS chunk_text FROM merged JOIN d USING (doc_id)""")
def malformed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lost their line ends, cut by character windows around keywords."""
    docs = _docs(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))
    found = chunking.document_chunks(docs, PATTERNS, most=120)
    return found.select("doc_id", "start", F.col("end").alias("stop"), F.array_join("keywords", ",").alias("keywords"), "chunk_text")


def _passages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = table(spark, sf_dir, "benchmark", "item_id", "text").select(F.lit("all").alias("pool"), F.col("item_id").alias("a"), "text")
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return items, lines.select(F.lit("all").alias("pool"), F.struct("doc_id", "line").cast("string").alias("b"), "text")


@query()
def similar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item with the most similar line of all documents."""
    return lookup.best_similar(*_passages(spark, sf_dir), 0.6, ["pool"]).drop("pool")


@query()
def line_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far benchmark items and lines of documents match, each way."""
    return lookup.two_way_overlap(*_passages(spark, sf_dir), 0.6, ["pool"])
